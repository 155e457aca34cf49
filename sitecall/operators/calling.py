"""Site calling (entry "filter sites"): A8, F1/F2 preparation, F8, F10, P19."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecall.functions.motif import gc_pct, has_n, motif3_rna, site_ratio
from sitecall.functions.stats import call_gate, call_pvalue, chi2_stat
from sitecall.operators import background as bg
from sitecall.operators.joins import materialise_dealt
from sitecall.options import Options

POOL_MARK = "-p-"
POOL_SUFFIX = "-FTO"


def by_site(long_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by site, so that later groupings and windows by site find the partitioning and need no shuffle."""
    return long_df.repartition(int(long_df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pool_treated(long_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Samples named ``<s>-p-*`` are summed into ``<s>-FTO``; the originals disappear."""
    s = F.col("sample")
    pooled = F.when(
        F.instr(s, POOL_MARK) > 0, F.concat(F.substring_index(s, POOL_MARK, 1), F.lit(POOL_SUFFIX))
    ).otherwise(s)
    other = [c for c in long_df.columns if c not in (*keys, "sample", "uncon", "depth")]
    return (
        long_df.withColumn("sample", pooled)
        .groupBy(*keys, "sample")
        .agg(
            F.sum("uncon").alias("uncon"),
            F.sum("depth").alias("depth"),
            *[F.first(c, ignorenulls=True).alias(c) for c in other],
        )
    )


def prepare_sites(long_df: DataFrame, strand: str = "strand") -> DataFrame:
    """Add motif3 (first two T -> U) and integer GC percent; drop "." strand and N 3-mers."""
    return (
        long_df.withColumn("motif3", motif3_rna("motif", max_t=2))
        .withColumn("gc_pct", gc_pct("motif"))
        .where((F.col(strand) != ".") & ~has_n("motif3"))
    )


def score_sites(sites_bg: DataFrame, opts: Options = Options()) -> DataFrame:
    """F10 + F8: ratio, chi-square statistic and p per (site, library)."""
    return sites_bg.withColumn("ratio", site_ratio("uncon", "depth")).withColumn(
        "p", call_pvalue("uncon", "depth", "background", opts.call_min_depth, opts.call_min_ratio)
    )


def keep_significant(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep all library rows of sites where any library has p < 1.

    A site's window holds one row a library.
    """
    # one window: the rows are scored once, on the partitioning by site that they have (by_site)
    hit = F.max((F.col("p") < 1).cast("int")).over(Window.partitionBy(*keys))
    return scored.withColumn("_hit", hit).where(F.col("_hit") == 1).drop("_hit")


def call_sites(long_sites: DataFrame, keys: Sequence[str], opts: Options = Options(),
               params: DataFrame | None = None, pool: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Full calling plan.  Returns (called rows, fit points, fit parameters).

    ``long_sites``: keys..., motif, sample, uncon, depth (plus any annotation).
    ``params``: precomputed parameters (sample, motif3, a, b, ...); fitted if None.
    """
    dealt = by_site(long_sites, keys)
    x = pool_treated(dealt, [*keys, "motif"]) if pool else dealt
    # the site table feeds both the fit and the scoring: write it once to the
    # shared checkpoint folder instead of recomputing it; the one shuffle, of unscored
    # rows by site, serves the pooling and the hit test
    sites = materialise_dealt(prepare_sites(x))
    points = bg.background_points(sites, opts.fit_depth_max)
    if params is None:
        params = bg.fit_background(points, opts.fallback_params)
    with_bg = bg.attach_background(sites, params)
    scored = score_sites(with_bg, opts)
    return keep_significant(scored, keys), points, params


def chi2_columns(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """Statistic and gate as columns (the SQL-comparable part of F8)."""
    return df.withColumn("stat", chi2_stat("uncon", "depth", "background")).withColumn(
        "tested", F.coalesce(call_gate("uncon", "depth", "background", opts.call_min_depth, opts.call_min_ratio), F.lit(False))
    )


def called_wide(called: DataFrame, samples: Sequence[str], keys: Sequence[str],
                site_cols: Sequence[str] = ("motif", "motif3", "gc_pct")) -> DataFrame:
    """Wide called-sites table: per library ``Uncon_/Depth_/Background_/Ratio_/p_`` columns.

    A library without a row at a site had zero counts there: Uncon/Depth 0,
    Ratio NaN (0/0), p 1 (never tested); its background is left null.  Site-level
    columns join the grouping key (one aggregate, no extra shuffle after the
    calling plan's site partitioning).  GC is reported as a fraction.
    """
    aggs = []
    for s in samples:
        here = F.col("sample") == s
        present = F.max(here)
        aggs += [
            F.coalesce(F.sum(F.when(here, F.col("uncon"))), F.lit(0)).cast("bigint").alias(f"Uncon_{s}"),
            F.coalesce(F.sum(F.when(here, F.col("depth"))), F.lit(0)).cast("bigint").alias(f"Depth_{s}"),
            F.max(F.when(here, F.col("background"))).alias(f"Background_{s}"),
            F.when(present, F.max(F.when(here, F.col("ratio")))).otherwise(F.lit(float("nan"))).alias(f"Ratio_{s}"),
            F.when(present, F.max(F.when(here, F.col("p")))).otherwise(F.lit(1.0)).alias(f"p_{s}"),
        ]
    w = called.groupBy(*keys, *site_cols).agg(*aggs)
    if "gc_pct" in site_cols:
        w = w.withColumn("GC", F.col("gc_pct") / F.lit(100.0)).drop("gc_pct")
    return w
