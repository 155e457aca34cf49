"""Tables behind the read and site reports.

All of them are grouped aggregates over the long tables; per-sample columns
appear only in the final pivots, whose width is the (config-sized) sample list.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.functions.motif import col, motif3, motif_valid
from sitecall.operators.joins import materialise
from sitecall.options import DEPTH_BINS, DEPTH_HIST_MIN_MAX, RATIO_BINS


# A2 ---------------------------------------------------------------------
def motif_conversion(pileup: DataFrame, target_base: str = "A", by: Sequence[str] = ("sample", "reftype")) -> DataFrame:
    """Per 3-mer (A/T/G/C only, centred on the target): n, Σuncon, Σdepth, mean of site ratios."""
    m3 = motif3("motif")
    x = pileup.where(F.col("depth") > 0).withColumn("m3", m3).where(motif_valid("m3", target_base))
    return x.groupBy(*by, "m3").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("uncon").alias("unconverted"),
        F.sum("depth").alias("depth"),
        F.avg(F.col("uncon") / F.col("depth")).alias("ratio"),
    )


# A3 ---------------------------------------------------------------------
def gene_stats(pileup: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    """Per gene (= transcript pileup chrom), excluding ``probe_*``: n, Σuncon, Σdepth, mean ratio."""
    x = pileup.where((F.col("depth") > 0) & ~F.col("chrom").startswith("probe_"))
    return x.groupBy(*by, F.col("chrom").alias("gene")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("uncon").alias("uncon"),
        F.sum("depth").alias("depth"),
        F.avg(F.col("uncon") / F.col("depth")).alias("ratio"),
    )


# A9 / A14 -----------------------------------------------------------------
def heatmap_ratio(sites_long: DataFrame, target_base: str = "A") -> DataFrame:
    """Per sample x 3-mer: pooled 100 * Σuncon / Σdepth over sites with depth > 0; 3-mer T -> U."""
    m3 = motif3("motif")
    x = sites_long.where(F.col("depth") > 0).withColumn("m3", m3).where(
        (F.substring("m3", 2, 1) == target_base.upper()) & (F.instr("m3", "N") == 0)
    )
    return x.groupBy("sample", "m3").agg(
        (F.sum("uncon") / F.sum("depth") * F.lit(100.0)).alias("ratio_pct")
    ).select("sample", F.translate("m3", "T", "U").alias("motif"), "ratio_pct")


def heatmap_scale(heatmap: DataFrame) -> DataFrame:
    """Colour scale: max over all cells (100 when there are none) and half of it."""
    mx = F.coalesce(F.max("ratio_pct"), F.lit(100.0))
    return heatmap.agg(mx.alias("max_val"), (mx / F.lit(2.0)).alias("mid_val"))


# A10 ----------------------------------------------------------------------
def site_summary(sites_long: DataFrame) -> DataFrame:
    """Per sample: sites, mean depth, exact median depth, mean ratio, max ratio (depth > 0)."""
    x = sites_long.where(F.col("depth") > 0).withColumn("_r", F.col("uncon") / F.col("depth"))
    return x.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total_sites"),
        F.avg("depth").alias("mean_depth"),
        F.percentile(F.col("depth").cast("double"), F.lit(0.5)).alias("median_depth"),
        F.avg("_r").alias("mean_ratio"),
        F.max("_r").alias("max_ratio"),
    )


# A11 / A12 / A13 ------------------------------------------------------------
def ratio_edges(n: int = RATIO_BINS) -> list[float]:
    """n equal bins on [0, 1]; edges are i * (1/n) in double arithmetic, last edge exactly 1."""
    step = 1.0 / n
    edges = [i * step for i in range(n)] + [1.0]
    return edges


def depth_edges(max_depth: float, n: int = DEPTH_BINS) -> list[float]:
    """n log10 bins on [1, max(1000, max depth) + 1]."""
    m = max(float(DEPTH_HIST_MIN_MAX), float(max_depth or 0))
    return [float(v) for v in np.logspace(0, np.log10(m + 1), n + 1)]


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """Bin of x: edges[i] <= x < edges[i+1], last bin closed; null outside [edges[0], edges[-1]].

    Counting the interior edges <= x reproduces edge-array binning exactly
    (not floor(x * n), which disagrees at 0.7, 0.58, 0.82, 0.94).
    """
    interior = [float(e) for e in edges[1:-1]]

    def tree(lo: int, hi: int) -> Column:
        # number of interior edges <= x, knowing interior[:lo] <= x < interior[hi:]
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x >= F.lit(interior[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    # balanced comparison tree: ~log2(n) comparisons per value, stays in whole-stage codegen
    return F.when((x >= F.lit(float(edges[0]))) & (x <= F.lit(float(edges[-1]))), tree(0, len(interior)))


def ratio_labels(n: int = RATIO_BINS) -> list[str]:
    e = ratio_edges(n)
    return [f"{(e[i] + e[i + 1]) / 2:.2f}" for i in range(n)]


def depth_labels(edges: Sequence[float]) -> list[int]:
    return [int((edges[i] + edges[i + 1]) / 2) for i in range(len(edges) - 1)]


def ratio_histogram(sites_long: DataFrame, n: int = RATIO_BINS) -> DataFrame:
    """(sample, bin, label, count) of uncon/depth over sites with depth > 0."""
    edges = ratio_edges(n)
    labels = ratio_labels(n)
    x = sites_long.where(F.col("depth") > 0).select(
        "sample", bin_index(F.col("uncon") / F.col("depth"), edges).alias("bin")
    ).where(F.col("bin").isNotNull())
    lab = F.array(*[F.lit(v) for v in labels])
    return x.groupBy("sample", "bin").agg(F.count(F.lit(1)).alias("count")).select(
        "sample", F.col("bin").cast("bigint").alias("bin"), F.get(lab, F.col("bin")).alias("label"), "count"
    )


def depth_counts(sites_long: DataFrame) -> DataFrame:
    """(sample, depth, count) of sites with depth > 0, computed once: at most samples x distinct depths rows."""
    x = sites_long.where(F.col("depth") > 0)
    return materialise(x.groupBy("sample", "depth").agg(F.count(F.lit(1)).alias("count")))


def depth_bins(counts: DataFrame, n: int = DEPTH_BINS) -> tuple[DataFrame, list[float]]:
    """(sample, bin, label, count) of depth in log bins and their edges, from the compact counts."""
    edges = depth_edges(counts.agg(F.max("depth")).first()[0] or 0, n)
    labels = depth_labels(edges)
    b = counts.select("sample", bin_index(F.col("depth").cast("double"), edges).alias("bin"), "count").where(F.col("bin").isNotNull())
    lab = F.array(*[F.lit(v).cast("bigint") for v in labels])
    out = b.groupBy("sample", "bin").agg(F.sum("count").alias("count")).select(
        "sample", F.col("bin").cast("bigint").alias("bin"), F.get(lab, F.col("bin")).alias("label"), "count"
    )
    return out, edges


def depth_histogram(sites_long: DataFrame, n: int = DEPTH_BINS) -> tuple[DataFrame, list[float]]:
    """(sample, bin, label, count) of depth in log bins; the sites are read once."""
    return depth_bins(depth_counts(sites_long), n)


def present_samples(hist: DataFrame, samples: Sequence[str]) -> list[str]:
    """Those of the design's samples that a compact histogram holds."""
    found = hist.agg(*[F.max((F.col("sample") == s).cast("int")).alias(f"s{i}") for i, s in enumerate(samples)]).first()
    return [s for i, s in enumerate(samples) if found[i]]


def histograms_wide(sites_long: DataFrame, samples: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The ratio and the depth histogram, one column a sample that has sites: one run of the sites for each."""
    ratio = materialise(ratio_histogram(sites_long))
    counts = depth_counts(sites_long)
    depth, edges = depth_bins(counts)
    return (histogram_wide(ratio, present_samples(ratio, samples), RATIO_BINS, ratio_labels()),
            histogram_wide(depth, present_samples(counts, samples), DEPTH_BINS, depth_labels(edges)))


def histogram_wide(hist: DataFrame, samples: Sequence[str], n: int, labels: Sequence) -> DataFrame:
    """One column per sample beside the bin label; empty bins 0 (bin spine of n rows)."""
    spark = hist.sparkSession
    spine = spark.createDataFrame([(i, labels[i]) for i in range(n)], ["bin", "label"]).select(
        F.col("bin").cast("bigint").alias("bin"), "label"
    )
    piv = hist.groupBy("bin").agg(
        *[F.sum(F.when(F.col("sample") == s, F.col("count"))).alias(s) for s in samples]
    )
    # both sides hold at most n rows (the bin count): a plain join, Spark/AQE pick the strategy
    return spine.join(piv, "bin", "left").select(
        "bin", "label", *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in samples]
    )


# J6 ------------------------------------------------------------------------
def motif_table_wide(motif_tables: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Full join of per-sample motif tables on Motif (N-free, T -> U), ratio x 100 per sample."""
    x = motif_tables.where(F.instr(F.upper("motif"), "N") == 0).select(
        "sample", F.translate(F.upper("motif"), "T", "U").alias("motif"), (F.col("ratio") * 100).alias("pct")
    )
    return x.groupBy("motif").agg(
        *[F.first(F.when(F.col("sample") == s, F.col("pct")), ignorenulls=True).alias(f"{s} (%)") for s in samples]
    )


# F14 -----------------------------------------------------------------------
def read_hierarchy(stage_counts: DataFrame) -> DataFrame:
    """Six non-negative segments from the stage counts (one row per sample; missing keys 0)."""

    def g(k):
        return F.coalesce(F.col(k), F.lit(0)).cast("bigint")

    target_passed = g("Transcript_Passed") + g("Genome_Passed")
    target_unique = g("Transcript_Dedup") + g("Genome_Dedup")
    zero = F.lit(0).cast("bigint")
    return stage_counts.select(
        "sample",
        target_unique.alias("unique_mapped"),
        F.greatest(zero, target_passed - target_unique).alias("duplicates"),
        g("Masking_Passed").alias("masking"),
        g("Contamination_Passed").alias("contamination"),
        F.greatest(zero, g("Clean") - (g("Contamination_Passed") + g("Masking_Passed") + target_passed)).alias("unmapped"),
        F.greatest(zero, g("Raw") - g("Clean")).alias("discarded_short"),
    )


STAGE_KEYS = (
    "Raw", "Clean", "Contamination_Passed", "Contamination_Dedup", "Masking_Passed", "Masking_Dedup",
    "Transcript_Passed", "Transcript_Dedup", "Genome_Passed", "Genome_Dedup",
)


def stage_counts_wide(stage_long: DataFrame) -> DataFrame:
    """(sample, key, value) -> one row per sample, one column per known key (null when absent)."""
    return stage_long.groupBy("sample").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in STAGE_KEYS]
    )


# F15 / F16 / F17 -------------------------------------------------------------
def sample_type_label(sample, typ) -> Column:
    return F.format_string("%s_%s", col(sample), col(typ))


def ratio_percent(x, digits: int = 3) -> Column:
    """x * 100 with ``digits`` decimals (round-half-even on the double) and a % sign; null stays null."""
    return F.when(col(x).isNotNull(), F.concat(F.format_number(col(x) * 100, digits), F.lit("%")))


def json_first_number(text, key: str) -> Column:
    """First ``"<key>": <digits>,`` in a report text, as bigint (null if absent)."""
    v = F.regexp_extract(col(text), f'"{key}": ([0-9]+),', 1)
    return F.when(v != "", v.cast("bigint"))


def trimmed_pct(text) -> Column:
    """percent_trimmed with the fallback path when the first is 0 or missing; 0 if neither."""
    a = F.get_json_object(col(text), "$.filtering_statistics.percent_trimmed").cast("double")
    b = F.get_json_object(col(text), "$.report.summary.terminal_stats.percent_trimmed").cast("double")
    return F.when(F.coalesce(a, F.lit(0.0)) == 0, F.coalesce(b, F.lit(0.0))).otherwise(a)


def trimmed_pct_of_samples(trim_reports: DataFrame) -> DataFrame:
    """(sample, report) of all runs -> (sample, trimmed_pct): the runs' percentages weighted by their input reads."""
    t = trim_reports.select("sample", json_first_number("report", "input").alias("n"), trimmed_pct("report").alias("pct"))
    return t.groupBy("sample").agg(F.try_divide(F.sum(F.col("pct") * F.col("n")), F.sum("n").cast("double")).alias("trimmed_pct"))


def spike_table(counts: DataFrame) -> DataFrame:
    """Spike-in calibration per sample and rate, as the probe report lists it."""
    from sitecall.operators.pileup import spike_ratio

    return spike_ratio(counts).select("sample", "rate", "m6a_pct", "a_convert_pct", "c_convert_pct")
