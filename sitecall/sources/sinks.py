"""Sinks (K1-K6).  Outputs are directories of part files written by many tasks;
ordered outputs are range-partitioned and sorted, so part files concatenate in
order without funnelling the data through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# K1 -------------------------------------------------------------------------
def sink_tsv(df: DataFrame, path: str, gzip: bool | None = None, order_by: Sequence[str] | None = None) -> None:
    """TSV with a header line per part file; gzip when asked or when the path ends in ``.gz``."""
    gz = path.endswith(".gz") if gzip is None else gzip
    out = df.orderBy(*order_by) if order_by else df
    w = out.write.mode("overwrite").option("header", True).option("sep", "\t")
    if gz:
        w = w.option("compression", "gzip")
    w.csv(path)


# K2 -------------------------------------------------------------------------
def sci(c, digits: int = 8) -> Column:
    """Scientific notation with ``digits`` decimals and a minimal exponent (``1.5e-5``, ``2e3`` style exponent)."""
    x = F.col(c) if isinstance(c, str) else c
    s = F.format_string(f"%.{digits}e", x)
    s = F.regexp_replace(s, "e\\+?(-?)0*([0-9])", "e$1$2")
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(s)


def format_floats_sci(df: DataFrame, digits: int = 8) -> DataFrame:
    """Every double column rendered with :func:`sci`."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(sci(f.name, digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def sink_tsv_sci(df: DataFrame, path: str, digits: int = 8) -> None:
    sink_tsv(format_floats_sci(df, digits), path, gzip=False)


# K3 -------------------------------------------------------------------------
def sink_parquet_groups(df: DataFrame, path: str, by: str = "group") -> None:
    """One Parquet directory per group; no repartition by group (a hot group would
    land in one task), file size capped by ``maxRecordsPerFile``."""
    df.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).partitionBy(by).parquet(path)


# K4 -------------------------------------------------------------------------
def report_lines(df: DataFrame, header_lines: Sequence[str], float_digits: int | None = 6) -> DataFrame:
    """(section, idx, line): ``#`` header lines, the column header, then TSV body lines."""
    spark = df.sparkSession
    head = spark.createDataFrame(
        [(0, i, h) for i, h in enumerate(header_lines)] + [(1, 0, "\t".join(df.columns))],
        "section int, idx bigint, line string",
    )
    vals = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if float_digits is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.format_string(f"%.{float_digits}f", c)
        vals.append(F.coalesce(c.cast("string"), F.lit("")))
    body = df.select(F.lit(2).alias("section"), F.monotonically_increasing_id().alias("idx"), F.concat_ws("\t", *vals).alias("line"))
    return head.unionByName(body)


def sink_report_tsv(df: DataFrame, path: str, header_lines: Sequence[str], order_by: Sequence[str] = (),
                    float_digits: int | None = 6) -> None:
    """Report file: metadata lines, header, body (in ``order_by`` order), as ordered text parts."""
    body = df.orderBy(*order_by) if order_by else df
    lines = report_lines(body, header_lines, float_digits)
    lines.orderBy("section", "idx").select("line").write.mode("overwrite").text(path)


# K5 -------------------------------------------------------------------------
def sink_model(points: DataFrame, params: DataFrame, path: str) -> None:
    """Background points and fitted parameters as Parquet tables (``points/``, ``params/``)."""
    points.write.mode("overwrite").parquet(f"{path}/points")
    params.write.mode("overwrite").parquet(f"{path}/params")


# K6 -------------------------------------------------------------------------
def sink_parquet(df: DataFrame, path: str) -> None:
    """Parquet output; an empty frame still writes its schema (unlike a zero-column text file)."""
    df.write.mode("overwrite").parquet(path)
