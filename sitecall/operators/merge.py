"""N-sample merge of per-sample site counts.

The original joins one sample at a time: required samples with a full outer
join, optional samples with a left join, and a one-off depth filter on the
joined table just before the first optional sample.  With unique site keys per
sample this equals ONE union of the long table and ONE window over
(chrom, pos, strand):

* the samples are stably ordered, required first (J3) -> ``rank``;
* the "base" samples are ranks ``[0, k)`` where ``k`` is the first optional
  rank after rank 0 (all samples if none);
* a site survives if a base sample has it (full-join union, J1) and, when an
  optional sample exists, the max base depth is >= ``min_depth`` (P16);
* optional samples only annotate surviving sites (left join, J2);
* motif = the motif of the lowest-ranked sample that has one.

A site's window holds at most one row per sample, so groups are bounded by
the sample count whatever the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitecall.operators.joins import literal_map
from sitecall.operators.sites import SITE_KEYS


def merge_order(samples: Sequence[str], requires: Sequence[int | bool]) -> list[tuple[str, bool]]:
    """Stable order, required samples first."""
    pairs = list(zip(samples, [bool(r) for r in requires]))
    return sorted(pairs, key=lambda p: not p[1])


def base_size(ordered: Sequence[tuple[str, bool]]) -> int:
    """Number of leading samples joined before the depth filter."""
    for i, (_, req) in enumerate(ordered):
        if i >= 1 and not req:
            return i
    return len(ordered)


def merge_site_counts(site_counts: DataFrame, samples: Sequence[str], requires: Sequence[int | bool],
                  min_depth: int = 3) -> DataFrame:
    """Merge long per-sample counts; returns the long merged table.

    Input columns: sample, chrom, pos, strand, motif, uncon, depth.
    Output: chrom, pos, strand, motif, sample, uncon, depth (one row per sample
    that has the site; absent samples count as 0 at the wide edge).

    One shuffle on the site key and one sort by (site, rank): the site-level
    facts (in a base sample, max base depth, first motif by rank) are window
    aggregates over a site's rows, which number at most one per sample.
    """
    ordered = merge_order(samples, requires)
    k = base_size(ordered)
    shrink = k < len(ordered)
    rank = literal_map({s: i for i, (s, _) in enumerate(ordered)})

    x = site_counts.where(F.col("sample").isin([s for s, _ in ordered])).withColumn(
        "_rank", F.element_at(rank, F.col("sample"))
    )
    w = Window.partitionBy(*SITE_KEYS).orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_base = F.col("_rank") < k
    y = x.select(
        "*",
        F.max(is_base).over(w).alias("_in_base"),
        F.coalesce(F.max(F.when(is_base, F.col("depth"))).over(w), F.lit(0)).alias("_base_max"),
        F.first("motif", ignorenulls=True).over(w).alias("_motif"),
    )
    keep = F.col("_in_base")
    if shrink:
        keep = keep & (F.col("_base_max") >= min_depth)
    return y.where(keep).select(*SITE_KEYS, F.col("_motif").alias("motif"), "sample", "uncon", "depth")


def merged_wide(merged_long: DataFrame, ordered_samples: Sequence[str]) -> DataFrame:
    """Wide view ``Chrom Pos Strand Motif Uncon_<s> Depth_<s> ...`` with zeros for absent samples.

    The motif is constant per merged site, so it is part of the grouping key
    (same groups, no new shuffle, code-generated hash aggregate).
    """
    from sitecall.operators.sites import to_wide

    w = to_wide(merged_long, ordered_samples, SITE_KEYS, site_cols=("motif",))
    return w.withColumnsRenamed({"chrom": "Chrom", "pos": "Pos", "strand": "Strand", "motif": "Motif"})
