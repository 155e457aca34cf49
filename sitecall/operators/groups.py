"""Replicate-group test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall.functions.motif import motif3_rna
from sitecall.functions.stats import group_pvalue
from sitecall.operators.joins import bounded_broadcast
from sitecall.options import GROUP_ERROR_RATE, GROUP_MIN_DEPTH


def group_table(spark, groups: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """(group, sample) rows from the configured groups; a sample may sit in several groups."""
    rows = [(g, s) for g, members in groups for s in members]
    return spark.createDataFrame(rows, "group string, sample string")


def pool_groups(long_sites: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Σ uncon, Σ depth over each group's samples, per site.

    ``groups`` is config-sized (group x sample); it is broadcast behind a check.
    """
    g, _ = bounded_broadcast(groups)
    other = [c for c in long_sites.columns if c not in (*keys, "sample", "uncon", "depth")]
    return (
        long_sites.join(g, on="sample", how="inner")
        .groupBy("group", *keys)
        .agg(
            F.sum("uncon").alias("uncon"),
            F.sum("depth").alias("depth"),
            *[F.first(c, ignorenulls=True).alias(c) for c in other],
        )
    )


def group_test(pooled: DataFrame, min_depth: int = GROUP_MIN_DEPTH, p: float = GROUP_ERROR_RATE,
               strand: str = "strand") -> DataFrame:
    """P18 + P13 before F9: depth >= 20 and strand != "."; m3 (all T -> U); binomial p."""
    return (
        pooled.where((F.col("depth") >= min_depth) & (F.col(strand) != "."))
        .withColumn("m3", motif3_rna("motif"))
        .withColumn("p", group_pvalue("uncon", "depth", p))
    )
