"""Spelt strings of the fixtures: Spark's lookup gives what the plain expressions give, in short statements."""

import json

import pytest
from pyspark.sql import functions as F

from sitecall import fixtures as fx

SPELT = ("site_counts", "transcript_counts", "reads", "probe_reads")
ROWS = [
    (o, p, s, n, 7.0, 0.02, flag)
    for o, p, s, n, flag in [
        (0, 0, 0, 0, "O"), (1, 2, 3, 1, "F"), (96, 97, 98, 2, "O"), (9_700_000_001, 4_000_000_019, 5_000_000_037, 3, "O"), (-5, 8, 9, 1, "O"),
        (12, -7, 4, 5, "F"), (150, 151, -13, 4, "F"), (None, 3, 4, 1, "O"), (4, None, 4, 1, "O"), (5, 3, None, 1, "F"), (6, 3, 4, None, "O"),
    ]
] + [(k * 37 % 211, k * 53 % 331, k * 7 % 101, k % 7 + 1, float(k % 50 + 1), 0.01, "OF"[k % 2]) for k in range(400)]
SCHEMA = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_linestatus string"


@pytest.mark.parametrize("name", SPELT)
def test_lookup_equals_the_rule(spark, tmp_path, name):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(str(tmp_path / "lineitem.parquet")).createOrReplaceTempView("lineitem_spelt")
    plain = fx._spelt(name, fx.TEMPLATES[name][0]).replace("{lineitem}", "lineitem_spelt")
    plain = plain.replace(" // ", " div ").replace("varchar(8)", "string").replace("varchar(20)", "string")
    rows = lambda df: sorted(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toPandas().iloc[:, 0])
    got, want = rows(fx.derive(spark, str(tmp_path), name)), rows(spark.sql(plain))
    assert got == want and any(None in json.loads(r).values() for r in got)


@pytest.mark.parametrize("name", SPELT)
def test_statement_stays_short(name):
    # hundreds of substrings in one method are left to the interpreter: minutes a million rows
    assert fx.spark_sql_text(name).count("substr(") < 15


def test_plain_fastq_lies_in_more_files_than_mates(spark, sf, tmp_path):
    from sitecall import fixture_files as ff

    # one task wrote all reads of a mate, however many
    fx.table(spark, sf, "lineitem").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = spark.read.text(ff.plain_fastq_files(spark, str(tmp_path))).inputFiles()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    mates = {f.rsplit("/", 1)[0] for f in files}
    assert len(mates) == 12 and len(files) > 2 * len(mates)
