"""Raw reads are derived as they are read, and clipped once."""

from pyspark.sql import functions as F

from sitecall import fixtures as fx
from sitecall.operators import reads as rd
from sitecall.plans.registry import load_all


def test_reads_are_not_written_first(spark, sf):
    for name in fx.AS_READ:
        df = fx.load(spark, sf, name)
        assert all("lineitem" in f for f in df.inputFiles()), name
        # a query that only takes the ids does not spell the strings
        plan = df.select("read_id")._jdf.queryExecution().optimizedPlan().toString()
        assert "element_at" not in plan, name


def test_filter_on_clipped_reads_does_not_clip_again(spark):
    rows = [("s0", "ACGTACGTAGATCGGAAGAGCTT", "I" * 23), ("s0", "ACGTACGTACGTACGTACGTACGTAGAT", "5" * 28), ("s0", None, None), ("s0", "", "")]
    df = spark.createDataFrame(rows, "sample string, seq string, qual string")
    routed = rd.length_route(rd.adapter_clip(df, fx.ADAPTER, umi_len=4), 10)
    clean = routed.where(F.col("route") == "clean")
    filters = [line for line in clean._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("instr" in f for f in filters)
    # a null read is not shorter than any length
    assert {(r.umi, r.seq, r.qual) for r in clean.collect()} == {("ACGT", "ACGTACGTACGTACGTACGT", "5" * 20), (None, None, None)}
    assert {(r.umi, r.seq) for r in routed.where("route = 'too_short'").collect()} == {("ACGT", "ACGT"), ("", "")}


def test_names_of_probes_and_alignments_are_not_written_first(spark, sf, monkeypatch):
    read = []
    monkeypatch.setattr(fx, "load", lambda s, d, name, load=fx.load: read.append(name) or load(s, d, name))
    names = load_all()["probe_rate"].run(spark, sf)
    assert set(read) <= set(fx.AS_READ)
    assert "umi" not in names._jdf.queryExecution().optimizedPlan().toString()
