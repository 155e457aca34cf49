"""Tables of gapped alignments and the genome: strings cut from tables of letters are what their rule spells (F1-F4 of FINDINGS_r04)."""

import pytest
from pyspark.sql import functions as F

from sitecall import fixtures as fx

ROWS = [
    (0, 0, 0, 0, "O"), (1, 2, 3, 1, "F"), (96, 97, 98, 2, "O"), (9_700_000_001, 4_000_000_019, 5_000_000_037, 3, "O"), (-5, 8, 9, 1, "O"), (12, -7, 4, 5, "F"), (150, 151, -13, 4, "F"),
    (None, 3, 4, 1, "O"), (4, None, 4, 1, "O"), (5, 3, None, 1, "F"), (6, 3, 4, None, "O"), (7, 3, 4, -1, "O"),
] + [(k * 37 % 2111, k * 5303 % 90_001, k * 7 % 101, k % 7 + 1, "OF"[k % 2]) for k in range(3000)]


@pytest.mark.parametrize("name", sorted(fx.STRETCHES))
def test_stretches_equal_the_rule(spark, tmp_path, monkeypatch, name):
    rows = spark.createDataFrame(ROWS, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_linestatus string").withColumn("l_quantity", F.lit(3.0))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows.select(F.col("l_partkey").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    got = fx.derive(spark, str(tmp_path), name)
    monkeypatch.setattr(fx, "STRETCHES", {})
    want = fx.derive(spark, str(tmp_path), name)
    assert "element_at" not in want._jdf.queryExecution().optimizedPlan().toString()
    assert got.dtypes == want.dtypes and got.count() == len(ROWS)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("name", ("sam_records", "tx_sam_records"))
def test_alignments_are_not_written_first(spark, sf, name):
    df = fx.load(spark, sf, name)
    assert all("lineitem" in f for f in df.inputFiles())
    # a query without sequences does not spell them
    assert "EACH" not in fx.spark_sql_text(name) and "transform(" not in df.select("read_id", "cigar")._jdf.queryExecution().optimizedPlan().toString()


def test_plain_fastq_is_written_without_a_shuffle(spark, sf):
    """all text of the reads went through a shuffle before it was written."""
    from sitecall import fixture_files as ff

    assert "Exchange" not in ff.plain_fastq_rows(spark, sf)._jdf.queryExecution().executedPlan().toString()
