"""Site-level projections and predicates (P1, P2, P13-P21) and the wide/long edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.functions.motif import has_n, motif3

SITE_KEYS = ("chrom", "pos", "strand")
LONG_COLUMNS = ("sample", "chrom", "pos", "strand", "motif", "uncon", "depth")


# P1 --------------------------------------------------------------------
def uncon_depth_from_tiers(df: DataFrame) -> DataFrame:
    """Six-count layout -> (uncon, depth): tiers 1 and 2 count, tier 0 is ignored.

    uncon = u1 + u2; depth = u1 + m1 + u2 + m2.
    """
    u1, u2, m1, m2 = (F.col(c).cast("bigint") for c in ("u1", "u2", "m1", "m2"))
    return df.withColumn("uncon", u1 + u2).withColumn("depth", u1 + m1 + u2 + m2)


# P2 --------------------------------------------------------------------
def depth_gt0(df: DataFrame, depth: str = "depth") -> DataFrame:
    return df.where(F.col(depth) > 0)


# P13 -------------------------------------------------------------------
def drop_dot_strand(df: DataFrame, strand: str = "strand") -> DataFrame:
    return df.where(F.col(strand) != ".")


# P14 -------------------------------------------------------------------
def motif_no_n(df: DataFrame, motif: str = "motif") -> DataFrame:
    """Keep sites whose 3-mer has no N."""
    return df.where(~has_n(motif3(motif)))


# P15 -------------------------------------------------------------------
def depth_window(df: DataFrame, lo: int = 1, hi: int = 100_000, depth: str = "depth") -> DataFrame:
    """lo <= depth < hi (background points only)."""
    d = F.col(depth)
    return df.where((d >= lo) & (d < hi))


# P20 -------------------------------------------------------------------
def columns_matching(df: DataFrame, pattern: str, exclude: str | None = None) -> list[str]:
    """Column names matching a regex (the wide-form selectors), optionally excluding one."""
    import re

    rx = re.compile(pattern)
    ex = re.compile(exclude) if exclude else None
    return [c for c in df.columns if rx.search(c) and not (ex and ex.search(c))]


# P21 -------------------------------------------------------------------
def rename_insert_null(df: DataFrame, renames: dict[str, str], inserts: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Rename columns, then insert typed null columns at given positions."""
    out = df.withColumnsRenamed(renames) if renames else df
    cols: list[Column | str] = [F.col(c) for c in out.columns]
    for pos, name, dtype in sorted(inserts):
        cols.insert(pos, F.lit(None).cast(dtype).alias(name))
    return out.select(*cols)


# wide <-> long ---------------------------------------------------------
def to_wide(long_df: DataFrame, samples: Sequence[str], keys: Sequence[str],
            values: Sequence[str] = ("uncon", "depth"),
            names: dict[str, str] | None = None, fill: int | None = 0,
            site_cols: Sequence[str] = ()) -> DataFrame:
    """Pivot the long table to ``Uncon_<s>``/``Depth_<s>`` columns (sink edge).

    One grouped aggregate with conditional sums; the sample list is config-sized.
    Missing samples are ``fill`` (0 as in the original merge).  ``site_cols``
    are site-level annotations (functionally dependent on ``keys``): they join
    the grouping key, which keeps the groups, needs no extra shuffle (hash
    partitioning on ``keys`` already clusters them) and leaves only fixed-width
    sum buffers, so Spark can use a code-generated hash aggregate.
    """
    names = names or {"uncon": "Uncon", "depth": "Depth"}
    aggs = []
    for s in samples:
        for v in values:
            a = F.sum(F.when(F.col("sample") == s, F.col(v)))
            if fill is not None:
                a = F.coalesce(a, F.lit(fill).cast("bigint"))
            aggs.append(a.alias(f"{names.get(v, v)}_{s}"))
    return long_df.groupBy(*keys, *site_cols).agg(*aggs)


def to_long(wide: DataFrame, keys: Sequence[str], prefixes: dict[str, str] | None = None) -> DataFrame:
    """Unpivot ``Uncon_<s>``/``Depth_<s>`` columns to (keys..., sample, uncon, depth)."""
    prefixes = prefixes or {"Uncon_": "uncon", "Depth_": "depth"}
    samples: list[str] = []
    first = next(iter(prefixes))
    for c in wide.columns:
        if c.startswith(first):
            samples.append(c[len(first):])
    if not samples:
        schema = ", ".join([f"`{k}` string" for k in keys] + ["sample string"] + [f"{v} bigint" for v in prefixes.values()])
        return wide.sparkSession.createDataFrame([], schema)
    structs = [
        F.struct(F.lit(s).alias("sample"), *[F.col(f"{p}{s}").cast("bigint").alias(v) for p, v in prefixes.items()])
        for s in samples
    ]
    return wide.select(*[F.col(k) for k in keys], F.explode(F.array(*structs)).alias("_e")).select(
        *keys, "_e.*"
    )
