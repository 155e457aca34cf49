"""Registered report-table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall import fixtures as fx
from sitecall.operators import merge, report, sites
from sitecall.operators.joins import materialise
from sitecall.plans import sqltext as q
from sitecall.plans.registry import register
from sitecall.plans.site_queries import PIPE_REQUIRES, PIPE_SAMPLES

ORDERED = [s for s, _ in merge.merge_order(PIPE_SAMPLES, PIPE_REQUIRES)]


def pileups(spark, sf) -> DataFrame:
    """Per-sample pileups of both reference types: genome (six-count layout) and transcript."""
    g = sites.uncon_depth_from_tiers(fx.load(spark, sf, "pileup_tiers")).select(
        "sample", F.lit("genome").alias("reftype"), "chrom", "pos", "strand", "motif", "uncon", "depth"
    )
    t = fx.load(spark, sf, "transcript_counts").select(
        "sample", F.lit("transcript").alias("reftype"), "chrom", "pos", "strand", "motif", "uncon", "depth"
    )
    return g.unionByName(t)


_PILEUPS_SQL = (
    "select sample, 'genome' as reftype, chrom, pos, strand, motif, cast(u1 + u2 as bigint) as uncon, "
    "cast(u1 + m1 + u2 + m2 as bigint) as depth from pileup_tiers "
    "union all select sample, 'transcript', chrom, pos, strand, motif, uncon, depth from transcript_counts"
)
_A2_SQL = (
    f"select sample, reftype, {q.motif3('motif')} as m3, cast(count(*) as bigint) as count, cast(sum(uncon) as bigint) as unconverted, "
    "cast(sum(depth) as bigint) as depth, avg(cast(uncon as double) / depth) as ratio from pileups "
    f"where depth > 0 and regexp_full_match({q.motif3('motif')}, '[ATGC]+') and substr({q.motif3('motif')}, 2, 1) = 'A' group by all"
)


def motif_tables(spark, sf) -> DataFrame:
    return report.motif_conversion(pileups(spark, sf))


@register(
    "motif_conversion", "A2",
    fx.with_fixtures(
        ["pileup_tiers", "transcript_counts"],
        "select sample, reftype, m3, count, unconverted, depth, round(ratio, 6) as ratio from a2",
        [("pileups", _PILEUPS_SQL), ("a2", _A2_SQL)],
    ),
)
def motif_conversion(spark, sf):
    """A2: per sample, reference type and 3-mer: sites, Σuncon, Σdepth, mean site ratio."""
    return motif_tables(spark, sf).withColumn("ratio", F.round("ratio", 6))


@register(
    "gene_stats", "A3",
    fx.with_fixtures(
        ["transcript_counts"],
        "select sample, chrom as gene, cast(count(*) as bigint) as n, cast(sum(uncon) as bigint) as uncon, "
        "cast(sum(depth) as bigint) as depth, round(avg(cast(uncon as double) / depth), 6) as ratio "
        "from transcript_counts where depth > 0 and not starts_with(chrom, 'probe_') group by all",
    ),
)
def gene_stats(spark, sf):
    """A3: per gene of the transcript pileup (probes excluded): n, Σuncon, Σdepth, mean ratio."""
    return report.gene_stats(fx.load(spark, sf, "transcript_counts")).withColumn("ratio", F.round("ratio", 6))


@register(
    "motif_table_join", "J6",
    fx.with_fixtures(
        ["pileup_tiers", "transcript_counts"],
        "select motif, " + ", ".join(
            f"round(max(case when sample = '{s}' then pct end), 6) as \"{s} (%)\"" for s in ORDERED
        ) + " from (select sample, replace(upper(m3), 'T', 'U') as motif, ratio * 100 as pct from a2 "
        "where reftype = 'genome' and strpos(upper(m3), 'N') = 0) group by motif",
        [("pileups", _PILEUPS_SQL), ("a2", _A2_SQL)],
    ),
)
def motif_table_join(spark, sf):
    """Genome motif tables of all samples joined on Motif, one ``<s> (%)`` column each."""
    t = motif_tables(spark, sf).where(F.col("reftype") == "genome").withColumnRenamed("m3", "motif")
    w = report.motif_table_wide(t, ORDERED)
    return w.select("motif", *[F.round(F.col(f"`{s} (%)`"), 6).alias(f"{s} (%)") for s in ORDERED])


def sites_long(spark, sf) -> DataFrame:
    """Genome merged sites (long) as read by the site report."""
    return merge.merge_site_counts(fx.load(spark, sf, "site_counts"), PIPE_SAMPLES, PIPE_REQUIRES, 3)


def _sites_long_sql(body: str, extra=None) -> str:
    ordered = merge.merge_order(PIPE_SAMPLES, PIPE_REQUIRES)
    ctes, out = q.merge_chain("site_counts", ordered, 3)
    unp = " union all ".join(
        f"select '{s}' as sample, \"Motif\" as motif, \"Uncon_{s}\" as uncon, \"Depth_{s}\" as depth from {out}" for s in ORDERED
    )
    return fx.with_fixtures(["site_counts"], body, [*ctes, ("sl", unp), *(extra or [])])


_HEAT_SQL = (
    "select sample, replace(m3, 'T', 'U') as motif, cast(sum(uncon) as double) / sum(depth) * 100.0 as ratio_pct from "
    f"(select *, {q.motif3('motif')} as m3 from sl where depth > 0) where substr(m3, 2, 1) = 'A' and strpos(m3, 'N') = 0 group by sample, m3"
)


@register("heatmap_ratio", "A9", _sites_long_sql("select sample, motif, round(ratio_pct, 6) as ratio_pct from heat", [("heat", _HEAT_SQL)]))
def heatmap_ratio(spark, sf):
    """Pooled 100 * Σuncon / Σdepth per sample and 3-mer."""
    return report.heatmap_ratio(sites_long(spark, sf)).withColumn("ratio_pct", F.round("ratio_pct", 6))


@register(
    "heatmap_scale", "A14",
    _sites_long_sql(
        "select round(coalesce(max(ratio_pct), 100.0), 6) as max_val, round(coalesce(max(ratio_pct), 100.0) / 2, 6) as mid_val from heat",
        [("heat", _HEAT_SQL)],
    ),
)
def heatmap_scale(spark, sf):
    """Heatmap colour scale (max, half of max; 100 when empty)."""
    s = report.heatmap_scale(report.heatmap_ratio(sites_long(spark, sf)))
    return s.select(F.round("max_val", 6).alias("max_val"), F.round("mid_val", 6).alias("mid_val"))


@register(
    "site_summary", "A10",
    _sites_long_sql(
        "select sample, cast(count(*) as bigint) as total_sites, round(avg(depth), 6) as mean_depth, "
        "round(median(cast(depth as double)), 6) as median_depth, round(avg(cast(uncon as double) / depth), 6) as mean_ratio, "
        "round(max(cast(uncon as double) / depth), 6) as max_ratio from sl where depth > 0 group by sample"
    ),
)
def site_summary(spark, sf):
    """A10: per sample sites, mean and exact median depth, mean and max ratio."""
    s = report.site_summary(sites_long(spark, sf))
    return s.select("sample", "total_sites", *[F.round(c, 6).alias(c) for c in ("mean_depth", "median_depth", "mean_ratio", "max_ratio")])


def _edge_case_sql(value: str, edges) -> str:
    interior = ", ".join(repr(float(e)) for e in edges[1:-1])
    return (
        f"case when {value} >= {float(edges[0])!r} and {value} <= {float(edges[-1])!r} then "
        f"len(list_filter([{interior}]::double[], lambda e: e <= {value})) end"
    )


_R_EDGES = report.ratio_edges()
_R_LABELS = report.ratio_labels()
_RHIST_SQL = (
    "select sample, cast(bin as bigint) as bin, (['" + "', '".join(_R_LABELS) + "'])[bin + 1] as label, cast(count(*) as bigint) as count from "
    f"(select sample, {_edge_case_sql('cast(uncon as double) / depth', _R_EDGES)} as bin from sl where depth > 0) where bin is not null group by sample, bin"
)


@register("ratio_histogram", "A11", _sites_long_sql("select * from rh", [("rh", _RHIST_SQL)]))
def ratio_histogram(spark, sf):
    """50 equal ratio bins on [0, 1] (edge-array binning), label = midpoint %.2f."""
    return report.ratio_histogram(sites_long(spark, sf))


_DHIST_SQL = """
select sample, cast(bin as bigint) as bin, cast(floor((edges[bin + 1] + edges[bin + 2]) / 2) as bigint) as label, cast(count(*) as bigint) as count
from (
 select sample, edges,
  case when depth >= edges[1] and depth <= edges[51] then len(list_filter(edges[2:50], lambda e: e <= depth)) end as bin
 from (select sample, cast(depth as double) as depth from sl where depth > 0) d,
  (select list_transform(range(51), lambda i: case when i = 50 then pow(10.0, log10(m + 1)) else pow(10.0, i * (log10(m + 1) / 50)) end) as edges
   from (select greatest(1000, max(depth)) as m from sl where depth > 0)) e
) where bin is not null group by sample, bin, edges
"""


@register("depth_histogram", "A12", _sites_long_sql("select * from dh", [("dh", _DHIST_SQL)]))
def depth_histogram(spark, sf):
    """50 log10 depth bins on [1, max(1000, max depth) + 1]; label = int(midpoint)."""
    return report.depth_histogram(sites_long(spark, sf))[0]


@register(
    "histogram_wide", "A13",
    _sites_long_sql(
        "select cast(i as bigint) as bin, (['" + "', '".join(_R_LABELS) + "'])[i + 1] as label, "
        + ", ".join(f"cast(coalesce(max(case when rh.sample = '{s}' then rh.count end), 0) as bigint) as \"{s}\"" for s in ORDERED)
        + " from range(50) t(i) left join rh on rh.bin = t.i group by i",
        [("rh", _RHIST_SQL)],
    ),
)
def histogram_wide(spark, sf):
    """Ratio histogram with one column per sample that has sites; empty bins 0."""
    h = materialise(report.ratio_histogram(sites_long(spark, sf)))
    return report.histogram_wide(h, report.present_samples(h, ORDERED), len(_R_LABELS), _R_LABELS)


@register(
    "depth_histogram_wide", "A13",
    _sites_long_sql(
        "select cast(i as bigint) as bin, cast(floor((edges[i + 1] + edges[i + 2]) / 2) as bigint) as label, "
        + ", ".join(f"cast(coalesce(max(case when dh.sample = '{s}' then dh.count end), 0) as bigint) as \"{s}\"" for s in ORDERED)
        + " from range(50) t(i) cross join (select list_transform(range(51), lambda i: case when i = 50 then pow(10.0, log10(m + 1)) else pow(10.0, i * (log10(m + 1) / 50)) end) as edges "
        "from (select greatest(1000, max(depth)) as m from sl where depth > 0)) e left join dh on dh.bin = t.i group by i, edges",
        [("dh", _DHIST_SQL)],
    ),
)
def depth_histogram_wide(spark, sf):
    """Depth histogram with one column per sample that has sites, from the compact depth counts."""
    counts = report.depth_counts(sites_long(spark, sf))
    hist, edges = report.depth_bins(counts)
    return report.histogram_wide(hist, report.present_samples(counts, ORDERED), 50, report.depth_labels(edges))


@register(
    "motif_table_join_transcript", "J6",
    fx.with_fixtures(
        ["pileup_tiers", "transcript_counts"],
        "select motif, " + ", ".join(
            f"round(max(case when sample = '{s}' then pct end), 6) as \"{s} (%)\"" for s in ORDERED
        ) + " from (select sample, replace(upper(m3), 'T', 'U') as motif, ratio * 100 as pct from a2 "
        "where reftype = 'transcript' and strpos(upper(m3), 'N') = 0) group by motif",
        [("pileups", _PILEUPS_SQL), ("a2", _A2_SQL)],
    ),
)
def motif_table_join_transcript(spark, sf):
    """Transcript motif tables of all samples joined on Motif."""
    t = motif_tables(spark, sf).where(F.col("reftype") == "transcript").withColumnRenamed("m3", "motif")
    w = report.motif_table_wide(t, ORDERED)
    return w.select("motif", *[F.round(F.col(f"`{s} (%)`"), 6).alias(f"{s} (%)") for s in ORDERED])


@register(
    "ratio_percent", "F16",
    fx.with_fixtures(
        ["pileup_tiers", "transcript_counts"],
        "select sample, reftype, m3, printf('%.3f%%', ratio * 100) as ratio_pct from a2",
        [("pileups", _PILEUPS_SQL), ("a2", _A2_SQL)],
    ),
)
def ratio_percent(spark, sf):
    """F16: ratio x 100 formatted ``%.3f%%``."""
    t = motif_tables(spark, sf)
    return t.select("sample", "reftype", "m3", report.ratio_percent("ratio", 3).alias("ratio_pct"))
