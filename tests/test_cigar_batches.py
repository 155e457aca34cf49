"""CIGARs parsed once a batch (F3, F4 of FINDINGS_r04)."""

import pytest
from pyspark.sql import functions as F

from sitecall.functions import cigar as cg
from sitecall.operators import reads as rd
from sitecall.sources import files


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_five_prime_of_a_cigar_equals_that_of_its_operations(spark):
    cigars = ["3S10M2S", "1H2S5M3D5M1H", "8M", "2H40M6S", "16M500N32M", "4=1X20=23M", "5S18M1I12M2D12M", "3S4H", "5I2S", "0M3S", "2S0M3S", "*", None, "8M", "3S10M2S"]
    rows = [(c, 100 + i, bool(i % 2)) for i, c in enumerate(cigars)] + [(c, 7, not i % 2) for i, c in enumerate(cigars)]
    df = spark.createDataFrame(rows, "cigar string, pos long, reverse boolean").repartition(2)
    got = df.select(cg.five_prime_of("cigar", "pos", "reverse").alias("a"), cg.unclipped_five_prime(cg.cigar_ops("cigar"), "pos", "reverse").alias("b"))
    assert got.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0 and got.where("a is null").count() == 0
    with pytest.raises(Exception, match="not a CIGAR"):
        spark.createDataFrame([("5M3Q",)], "cigar string").select(cg.cigar_reach("cigar")).collect()


def test_duplicates_parse_a_cigar_without_lambdas(spark):
    rows = [("s", "g", "run1", f"r{i}", "c", 10, "+", 0, "2S8M", 30 + i, "AC") for i in range(3)]
    aln = spark.createDataFrame(rows, "sample string, reftype string, run string, read_id string, chrom string, pos long, strand string, flag long, cigar string, mapq long, umi string")
    kept, _ = rd.dedup_alignments(aln)
    plan = _optimized(kept)
    assert "aggregate(" not in plan and plan.index("ArrowEvalPython") < plan.index("Join")  # of the kept records only, above the join
    assert [(r.read_id, r.five_prime) for r in kept.collect()] == [("r2", 8)]


def test_tag_columns_do_not_build_the_map_of_all_tags(spark, tmp_path):
    head = "r1\t0\tc\t7\t60\t4M\t*\t0\t0\tACGT\tIIII\t"
    (tmp_path / "a.sam").write_text(head + "XMM:i:1\tXM:Z:i:5\tXM:i:4\tNS:i:3\tRX:Z:A:C\n")
    a = files.scan_alignments(spark, str(tmp_path))
    few = a.select("xm", "ns", "nc", "umi")
    assert "map_from_entries" not in _optimized(few) and [tuple(r) for r in few.collect()] == [(None, 3, None, "A:C")]
    assert a.select("tags").first()[0]["XM"] == ("Z", "i:5")
    for bad in ("XM", "XM:i", ""):
        (tmp_path / "a.sam").write_text(head + f"NS:i:3\t{bad}\n")
        with pytest.raises(Exception, match="malformed tag"):
            files.scan_alignments(spark, str(tmp_path)).select("ns").collect()
