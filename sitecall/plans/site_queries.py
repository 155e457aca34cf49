"""Registered site-level queries: merge, liftover, calling, group test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitecall import fixtures as fx
from sitecall.functions import motif as fm
from sitecall.functions import stats as fs
from sitecall.functions.coords import span_end0, span_start0
from sitecall.operators import background as bg
from sitecall.operators import calling, groups, liftover, merge, sites
from sitecall.options import FALLBACK_PARAMS, Options
from sitecall.plans import sqltext as q
from sitecall.plans.registry import register

KEYS = list(sites.SITE_KEYS)
ALL4 = ("s0", "s1", "s2", "s3")
# pipeline sample sheet: s0 is a skipped (optional) sample
PIPE_SAMPLES, PIPE_REQUIRES = ("s0", "s1", "s2", "s3"), (0, 1, 1, 1)
FA, FB = FALLBACK_PARAMS[0], FALLBACK_PARAMS[1]


def _sc(spark, sf):
    return fx.load(spark, sf, "site_counts")


def _tiers(spark, sf):
    return fx.load(spark, sf, "pileup_tiers")


def _wide_merge(spark, sf, samples, requires, min_depth=3, src="site_counts") -> DataFrame:
    long = merge.merge_site_counts(fx.load(spark, sf, src), samples, requires, min_depth)
    ordered = [s for s, _ in merge.merge_order(samples, requires)]
    return merge.merged_wide(long, ordered)


def _oracle_merge(samples, requires, min_depth=3, src="site_counts", extra_body=None):
    ordered = merge.merge_order(samples, requires)
    ctes, out = q.merge_chain(src, ordered, min_depth)
    return fx.with_fixtures([src], extra_body or f"select * from {out}", ctes)


# J1 / J2 / J3 / P16 ------------------------------------------------------
register("merge_required", "J1", _oracle_merge(ALL4, (1, 1, 1, 1)))(
    lambda spark, sf: _wide_merge(spark, sf, ALL4, (1, 1, 1, 1))
)
register("merge_optional", "J2", _oracle_merge(PIPE_SAMPLES, PIPE_REQUIRES))(
    lambda spark, sf: _wide_merge(spark, sf, PIPE_SAMPLES, PIPE_REQUIRES)
)
register("merge_order", "J3", _oracle_merge(("s2", "s0", "s3", "s1"), (0, 1, 0, 1)))(
    lambda spark, sf: _wide_merge(spark, sf, ("s2", "s0", "s3", "s1"), (0, 1, 0, 1))
)
register("min_depth_any", "P16", _oracle_merge(("s3", "s1", "s2", "s0"), (0, 0, 0, 0)))(
    lambda spark, sf: _wide_merge(spark, sf, ("s3", "s1", "s2", "s0"), (0, 0, 0, 0))
)


@register("sort_sites", "O1", _oracle_merge(PIPE_SAMPLES, PIPE_REQUIRES, extra_body='select * from m_out order by "Chrom", "Pos", "Strand"'))
def sort_sites(spark, sf):
    """O1: merged sites in (Chrom, Pos, Strand) order (range-partitioned global sort)."""
    return _wide_merge(spark, sf, PIPE_SAMPLES, PIPE_REQUIRES).orderBy("Chrom", "Pos", "Strand")


# P1 / P2 / P14 / P15 / F10 -------------------------------------------------
_P1_SQL = "select sample, chrom, pos, strand, motif, cast(u1 + u2 as bigint) as uncon, cast(u1 + m1 + u2 + m2 as bigint) as depth from pileup_tiers"


def _p1(spark, sf):
    return sites.uncon_depth_from_tiers(_tiers(spark, sf)).select("sample", *KEYS, "motif", "uncon", "depth")


register("uncon_depth", "P1", fx.with_fixtures(["pileup_tiers"], _P1_SQL))(_p1)
register("depth_gt0", "P2", fx.with_fixtures(["pileup_tiers"], f"select * from ({_P1_SQL}) where depth > 0"))(
    lambda spark, sf: sites.depth_gt0(_p1(spark, sf))
)
register(
    "depth_window", "P15",
    fx.with_fixtures(["pileup_tiers"], f"select * from ({_P1_SQL}) where depth >= 1 and depth < 100000"),
)(lambda spark, sf: sites.depth_window(_p1(spark, sf), 1, 100_000))


@register(
    "motif_valid", "P14",
    fx.with_fixtures(
        ["pileup_tiers"],
        f"select sample, chrom, pos, strand, {q.motif3('motif')} as motif3, "
        f"regexp_full_match({q.motif3('motif')}, '[ATGC]+') and substr({q.motif3('motif')}, 2, 1) = 'A' as valid_target "
        f"from ({_P1_SQL}) where depth > 0 and strpos({q.motif3('motif')}, 'N') = 0",
    ),
)
def motif_valid(spark, sf):
    """Drop 3-mers with N; flag A/T/G/C-only 3-mers centred on the target base."""
    df = sites.motif_no_n(sites.depth_gt0(_p1(spark, sf)))
    m3 = fm.motif3("motif")
    return df.select("sample", *KEYS, m3.alias("motif3"), fm.motif_valid(m3, "A").alias("valid_target"))


@register(
    "site_ratio", "F10",
    fx.with_fixtures(["pileup_tiers"], f"select sample, chrom, pos, strand, round({q.ratio('uncon', 'depth')}, 6) as ratio from ({_P1_SQL})"),
)
def site_ratio(spark, sf):
    """uncon / depth, null where depth is 0."""
    return _p1(spark, sf).select("sample", *KEYS, F.round(fm.site_ratio("uncon", "depth"), 6).alias("ratio"))


# F1 / F2 / F3 / F4 ------------------------------------------------------------
@register(
    "motif3_rna", "F1",
    fx.with_fixtures(
        ["transcript_counts"],
        f"select sample, chrom, pos, {q.motif3('motif')} as motif3, {q.motif3_rna_all('motif')} as m3_all, "
        f"{q.motif3_rna2('motif')} as m3_first2 from transcript_counts",
    ),
)
def motif3_rna(spark, sf):
    """3-mer, T -> U everywhere (group test) and at most twice (site filter)."""
    df = fx.load(spark, sf, "transcript_counts")
    return df.select(
        "sample", "chrom", "pos", fm.motif3("motif").alias("motif3"),
        fm.motif3_rna("motif").alias("m3_all"), fm.motif3_rna("motif", max_t=2).alias("m3_first2"),
    )


@register(
    "gc_fraction", "F2",
    fx.with_fixtures(["site_counts"], f"select sample, chrom, pos, strand, {q.gc_pct('motif')} as gc_pct, round({q.gc_pct('motif')} / 100.0, 2) as gc from site_counts"),
)
def gc_fraction(spark, sf):
    """G/C count of the two 10-base flanks over a fixed 20, as percent and fraction."""
    g = fm.gc_pct("motif")
    return _sc(spark, sf).select("sample", *KEYS, g.alias("gc_pct"), F.round(fm.gc_value(g), 2).alias("gc"))


@register(
    "gc_bin", "F3",
    fx.with_fixtures(["site_counts"], f"select sample, chrom, pos, strand, {q.gc_bin(q.gc_pct('motif'))} as gc_bin from site_counts"),
)
def gc_bin(spark, sf):
    """GC > 0.8 -> 1, < 0.2 -> 0, else unchanged (percent units)."""
    return _sc(spark, sf).select("sample", *KEYS, fm.gc_bin_pct(fm.gc_pct("motif")).alias("gc_bin"))


@register(
    "ratio_round2", "F4",
    fx.with_fixtures(["site_counts"], f"select sample, chrom, pos, strand, {q.ratio2('uncon', 'depth')} as r2, round({q.ratio2('uncon', 'depth')} / 100.0, 2) as ratio2 from site_counts"),
)
def ratio_round2(spark, sf):
    """round(uncon/depth, 2), exact half-up, as hundredths and as a double."""
    r2 = fm.ratio_pct2("uncon", "depth")
    return _sc(spark, sf).select("sample", *KEYS, r2.alias("r2"), F.round(r2 / F.lit(100.0), 2).alias("ratio2"))


# W1 / F13 / J4 / F5 / P13 / O4 ------------------------------------------------
_EXONS = q.exons_cte("transcripts")


@register("exon_offsets", "W1", fx.with_fixtures(["transcripts"], "select * from exons", [("exons", _EXONS)]))
def exon_offsets(spark, sf):
    """Exon rows with running transcript offsets (listed span order)."""
    return liftover.exon_offsets(fx.load(spark, sf, "transcripts")).drop("_tx_row")


@register(
    "span_parse", "F13",
    fx.with_fixtures(
        ["transcripts"],
        "select gene_id, cast(idx as bigint) as idx, cast(split_part(span, '-', 1) as bigint) - 1 as start0, "
        "cast(substr(span, strpos(span, '-') + 1) as bigint) as end0 from (select gene_id, unnest(string_split(spans, ',')) as span, "
        "generate_subscripts(string_split(spans, ','), 1) - 1 as idx from transcripts)",
    ),
)
def span_parse(spark, sf):
    """split spans on ',', each span on its first '-'; start - 1."""
    t = fx.load(spark, sf, "transcripts")
    e = t.select("gene_id", F.posexplode(F.split("spans", ",")).alias("idx", "span"))
    return e.select("gene_id", F.col("idx").cast("bigint").alias("idx"), span_start0("span").alias("start0"), span_end0("span").alias("end0"))


def _lifted(spark, sf) -> DataFrame:
    ex = liftover.exon_offsets(fx.load(spark, sf, "transcripts"))
    return liftover.liftover_sites(fx.load(spark, sf, "transcript_counts"), ex)


_LIFT_SQL = q.lifted_rows("transcript_counts", "exons")
register(
    "liftover_join", "J4",
    fx.with_fixtures(["transcripts", "transcript_counts"], "select * from lifted", [("exons", _EXONS), ("lifted", _LIFT_SQL)]),
)(_lifted)


@register(
    "liftover_pos", "F5",
    fx.with_fixtures(
        ["transcripts", "transcript_counts"],
        "select distinct gene_name, gene_pos, chrom, pos, strand from lifted",
        [("exons", _EXONS), ("lifted", _LIFT_SQL)],
    ),
)
def liftover_pos_q(spark, sf):
    """transcript position -> genome position per gene (distinct mapping)."""
    return _lifted(spark, sf).select("gene_name", "gene_pos", *KEYS).distinct()


register(
    "drop_dot_strand", "P13",
    fx.with_fixtures(
        ["transcripts", "transcript_counts"], "select * from lifted where strand <> '.'",
        [("exons", _EXONS), ("lifted", _LIFT_SQL)],
    ),
)(lambda spark, sf: sites.drop_dot_strand(_lifted(spark, sf)))


@register(
    "union_sites", "O4",
    fx.with_fixtures(
        ["transcripts", "transcript_counts", "site_counts"],
        "select chrom, pos, strand, gene_name, gene_pos, motif, sample, uncon, depth from lifted "
        "union all select chrom, pos, strand, null, null, motif, sample, uncon, depth from site_counts",
        [("exons", _EXONS), ("lifted", _LIFT_SQL)],
    ),
)
def union_sites(spark, sf):
    """Lifted transcript rows stacked on genome rows (same columns)."""
    g = _sc(spark, sf).select(
        *KEYS, F.lit(None).cast("string").alias("gene_name"), F.lit(None).cast("bigint").alias("gene_pos"),
        "motif", "sample", "uncon", "depth",
    )
    return _lifted(spark, sf).unionByName(g)


# The merged site table ---------------------------------------
def _design():
    from sitecall.plans.pipeline import SampleDesign

    return SampleDesign(PIPE_SAMPLES, PIPE_REQUIRES, fx.GROUPS)


def merged_sites_long(spark, sf, min_depth: int = 1) -> DataFrame:
    """Entry C: merge per reference type, lift transcripts, union, re-aggregate (long)."""
    from sitecall.plans import pipeline

    return pipeline.merged_sites(
        _sc(spark, sf), fx.load(spark, sf, "transcript_counts"), fx.load(spark, sf, "transcripts"),
        _design(), Options(merged_min_depth=min_depth),
    )


def merged_sites_wide(spark, sf, min_depth: int = 1) -> DataFrame:
    from sitecall.plans import pipeline

    return pipeline.merged_sites_wide(merged_sites_long(spark, sf, min_depth), _design())


def _oracle_merged_sites(min_depth: int, body: str | None = None) -> str:
    ordered = merge.merge_order(PIPE_SAMPLES, PIPE_REQUIRES)
    tx_ctes, tx_out = q.merge_chain("transcript_counts", ordered, 3, prefix="tx")
    gn_ctes, gn_out = q.merge_chain("site_counts", ordered, 3, prefix="gn")
    samples = [s for s, _ in ordered]
    vals = [f'"Uncon_{s}"' for s in samples] + [f'"Depth_{s}"' for s in samples]
    vals_sel = ", ".join(vals)
    lifted = (
        "lifted_w",
        q.lifted_rows(f'(select "Chrom" as chrom, "Pos" as pos, "Strand" as strand, "Motif" as motif, {vals_sel} from {tx_out})', "exons"),
    )
    union = (
        "u",
        f"select chrom, pos, strand, 0 as src, gene_name, gene_pos, motif, {vals_sel} from lifted_w "
        f'union all select "Chrom", "Pos", "Strand", 1, null, null, "Motif", {vals_sel} from {gn_out}',
    )
    firsts = (
        "fd",
        "select chrom, pos, strand, gene_name, min(gene_pos) as gene_pos from u where gene_name is not null group by all",
    )
    lists = (
        "gl",
        "select chrom, pos, strand, string_agg(gene_name, ';' order by gene_name) as gn, "
        "string_agg(cast(gene_pos as varchar), ';' order by gene_name) as gp from fd group by all",
    )
    sums = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in vals)
    tot = " + ".join(f"sum({c})" for c in [f'"Depth_{s}"' for s in samples])
    agg = (
        "agg",
        f"select chrom, pos, strand, first(motif order by src, gene_name, gene_pos, motif) as motif, {sums} "
        f"from u group by chrom, pos, strand having {tot} >= {min_depth}",
    )
    out = (
        "merged",
        'select a.chrom as "Chrom", a.pos as "Pos", a.strand as "Strand", coalesce(gl.gn, \'\') as "GeneName", '
        f'coalesce(gl.gp, \'\') as "GenePos", a.motif as "Motif", {", ".join("a." + c for c in vals)} '
        "from agg a left join gl using (chrom, pos, strand)",
    )
    return fx.with_fixtures(
        ["transcripts", "transcript_counts", "site_counts"],
        body or "select * from merged",
        [("exons", _EXONS), *tx_ctes, *gn_ctes, lifted, union, firsts, lists, agg, out],
    )


register("merged_site_sum", "A4", _oracle_merged_sites(1))(lambda spark, sf: merged_sites_wide(spark, sf, 1))
register("min_depth_total", "P17", _oracle_merged_sites(5))(lambda spark, sf: merged_sites_wide(spark, sf, 5))
register(
    "ordered_first_distinct", "A5",
    _oracle_merged_sites(1, 'select "Chrom", "Pos", "Strand", "GeneName", "GenePos", "Motif" from merged'),
)(lambda spark, sf: merged_sites_wide(spark, sf, 1).select("Chrom", "Pos", "Strand", "GeneName", "GenePos", "Motif"))


@register(
    "first_distinct", "W3",
    _oracle_merged_sites(1, 'select "Chrom", "Pos", "Strand", "GeneName", "GenePos" from merged where "GeneName" <> \'\''),
)
def first_distinct(spark, sf):
    """First row per (site, gene) by window, then genes joined in order."""
    ex = liftover.exon_offsets(fx.load(spark, sf, "transcripts"))
    tx = merge.merge_site_counts(fx.load(spark, sf, "transcript_counts"), PIPE_SAMPLES, PIPE_REQUIRES, 3)
    gn = merge.merge_site_counts(_sc(spark, sf), PIPE_SAMPLES, PIPE_REQUIRES, 3)
    lifted = liftover.liftover_sites(tx, ex)
    kept = liftover.merge_transcript_genome(lifted, gn, 1).select(*KEYS).distinct()
    w = Window.partitionBy(*KEYS, "gene_name").orderBy("gene_pos")
    firsts = (
        lifted.select(*KEYS, "gene_name", "gene_pos").distinct()
        .withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
        .join(kept, KEYS, "left_semi")
    )
    agg = firsts.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("gene_name", "gene_pos"))).alias("_g"))
    return agg.select(
        F.col("chrom").alias("Chrom"), F.col("pos").alias("Pos"), F.col("strand").alias("Strand"),
        F.array_join(F.transform("_g", lambda x: x["gene_name"]), ";").alias("GeneName"),
        F.array_join(F.transform("_g", lambda x: x["gene_pos"].cast("string")), ";").alias("GenePos"),
    )


@register(
    "column_regex_project", "P20",
    _oracle_merge(PIPE_SAMPLES, PIPE_REQUIRES, extra_body='select "Chrom", "Pos", "Strand", "Depth_s1", "Depth_s2", "Depth_s3", "Depth_s0" from m_out'),
)
def column_regex_project(spark, sf):
    """P20: select the key columns and every column matching ``^Depth_.*$``."""
    w = _wide_merge(spark, sf, PIPE_SAMPLES, PIPE_REQUIRES)
    return w.select("Chrom", "Pos", "Strand", *sites.columns_matching(w, r"^Depth_.*$", exclude=r"^Background_.*$"))


@register(
    "rename_insert_null", "P21",
    _oracle_merge(
        PIPE_SAMPLES, PIPE_REQUIRES,
        extra_body='select "Chrom", "Pos", "Strand", cast(null as varchar) as "GeneName", cast(null as bigint) as "GenePos", * exclude ("Chrom", "Pos", "Strand") from m_out',
    ),
)
def rename_insert_null(spark, sf):
    """Genome merged table with typed null GeneName/GenePos inserted at positions 3 and 4."""
    w = _wide_merge(spark, sf, PIPE_SAMPLES, PIPE_REQUIRES)
    return sites.rename_insert_null(w, {}, [(3, "GeneName", "string"), (4, "GenePos", "bigint")])


# A6 / U3 / F6 / J5 / F7 / F8 / P19 / A8 ------------------------------------------
def _prepared(spark, sf, pooled: bool = False) -> DataFrame:
    df = _sc(spark, sf)
    if pooled:
        df = _renamed_for_pool(df)
        df = calling.pool_treated(df, [*KEYS, "motif"])
    return calling.prepare_sites(df)


_PREP_SQL = (
    f"select *, {q.motif3_rna2('motif')} as motif3, {q.gc_pct('motif')} as gc_pct from site_counts "
    f"where strand <> '.' and strpos({q.motif3_rna2('motif')}, 'N') = 0"
)
_POINTS_SQL = (
    f"select sample, motif3, {q.gc_bin('gc_pct')} as gc_bin, "
    f"cast(sum({q.ratio2('uncon', 'depth')}) as double) / (cast(count(*) as double) * 100.0) as ratio, "
    f"cast(sum(gc_pct) as double) / (cast(count(*) as double) * 100.0) as gc, cast(count(*) as bigint) as count "
    f"from prep where depth >= 1 and depth < 100000 group by all"
)


@register("background_points", "A6", fx.with_fixtures(["site_counts"], "select * from points", [("prep", _PREP_SQL), ("points", _POINTS_SQL)]))
def background_points(spark, sf):
    """Per (sample, 3-mer, GC bin): mean rounded ratio, mean GC, site count."""
    return bg.background_points(_prepared(spark, sf))


@register("fit_background", "U3")
def fit_background(spark, sf):
    """Gated three-stage bounded fit per (sample, 3-mer); fallback parameters on gate or failure."""
    return bg.fit_background(bg.background_points(_prepared(spark, sf)))


@register(
    "fit_gates", "U3",
    fx.with_fixtures(
        ["site_counts"],
        "select sample, motif3, count(*) as n_points, case when count(*) < 5 then 'few_points' when max(ratio) - min(ratio) < 1e-10 then 'constant' "
        "when avg(ratio) > 0 and (max(ratio) - min(ratio)) / avg(ratio) < 0.05 then 'narrow' when count(distinct gc) < 3 then 'few_gc' else 'fit' end as gate "
        "from points group by sample, motif3",
        [("prep", _PREP_SQL), ("points", _POINTS_SQL)],
    ),
)
def fit_gates(spark, sf):
    """U3's gates: per (sample, 3-mer) its number of fit points, and whether it is fitted or why not."""
    return bg.fit_gates(bg.background_points(_prepared(spark, sf)))


def _fallback_bg(spark, sf) -> DataFrame:
    prep = _prepared(spark, sf)
    params = bg.fallback_background(bg.background_points(prep))
    return bg.attach_background(prep, params)


_BG_SQL = (
    f"select p.*, case when exists (select 1 from points x where x.sample = p.sample and x.motif3 = p.motif3) "
    f"then {FA} * exp({FB} * (gc_pct * 0.01)) end as background from prep p"
)


@register(
    "background_lookup", "J5",
    fx.with_fixtures(
        ["site_counts"],
        "select sample, chrom, pos, strand, motif3, gc_pct, round(background, 9) as background from bgt",
        [("prep", _PREP_SQL), ("points", _POINTS_SQL), ("bgt", _BG_SQL)],
    ),
)
def background_lookup(spark, sf):
    """Background per site from its (sample, 3-mer) parameters (fallback parameters here)."""
    return _fallback_bg(spark, sf).select("sample", *KEYS, "motif3", "gc_pct", F.round("background", 9).alias("background"))


@register(
    "background_rate", "F6",
    fx.with_fixtures(
        ["site_counts"],
        f"select distinct sample, motif3, gc_pct, round({FA} * exp({FB} * (gc_pct * 0.01)), 9) as background from prep",
        [("prep", _PREP_SQL)],
    ),
)
def background_rate(spark, sf):
    """a * exp(b * gc) on the 0.01 GC grid."""
    prep = _prepared(spark, sf).select("sample", "motif3", "gc_pct").distinct()
    return prep.select("sample", "motif3", "gc_pct", F.round(fs.background_rate(FA, FB, F.col("gc_pct") * F.lit(0.01)), 9).alias("background"))


@register(
    "mod_level", "F7",
    fx.with_fixtures(
        ["site_counts"],
        "select sample, motif3, gc_bin, round(0.03 * exp(-10.0 * (gc - 0.4) * (gc - 0.4)), 9) as mod_level, "
        f"round(0.03 * exp(-10.0 * (gc - 0.4) * (gc - 0.4)) + (1 - 0.03 * exp(-10.0 * (gc - 0.4) * (gc - 0.4))) * {FA} * exp({FB} * gc), 9) as combined "
        "from points",
        [("prep", _PREP_SQL), ("points", _POINTS_SQL)],
    ),
)
def mod_level(spark, sf):
    """c * exp(-d (x - e)^2) and m + (1 - m) * a * exp(b x) at each fit point (fallback parameters)."""
    pts = bg.background_points(_prepared(spark, sf))
    a, b, c, d, e = FALLBACK_PARAMS
    return pts.select(
        "sample", "motif3", "gc_bin",
        F.round(fs.mod_level(c, d, e, F.col("gc")), 9).alias("mod_level"),
        F.round(fs.combined_level(a, b, c, d, e, F.col("gc")), 9).alias("combined"),
    )


_CHI_SQL = (
    "select sample, chrom, pos, strand, uncon, depth, "
    f"round({q.chi2('uncon', 'depth', 'background')}, 6) as stat, {q.call_tested('uncon', 'depth', 'background')} as tested from bgt"
)
# erfc(z) = 1 - 2 / sqrt(pi) exp(-z^2) sum of 2^n z^(2n+1) / (2n+1)!!; it is 0 to 9 places beyond z = 6
_P_SQL = (
    "select *, round(case when background is null and depth > 10 and uncon >= 0.1 * depth and uncon > 0 then null when not tested then 1.0 when z > 6 then 0.0 else "
    "1 - 2 / sqrt(pi()) * exp(-z * z) * list_sum(list_transform(range(0, 200), lambda n: exp((2 * n + 1) * ln(z) + 2 * n * ln(2) + lgamma(n + 1) - lgamma(2 * n + 2)))) end, 9) as p "
    f"from (select *, sqrt({q.chi2('uncon', 'depth', 'background')} / 2) as z, {q.call_tested('uncon', 'depth', 'background')} as tested from bgt) x"
)


@register(
    "chi2_pvalue", "F8",
    fx.with_fixtures(
        ["site_counts"], "select sample, chrom, pos, strand, uncon, depth, round(2 * z * z, 6) as stat, tested, p from scored",
        [("prep", _PREP_SQL), ("points", _POINTS_SQL), ("bgt", _BG_SQL), ("scored", _P_SQL)],
    ),
)
def chi2_pvalue(spark, sf):
    """F8: chi-square statistic, test gate and p per (site, library)."""
    s = calling.score_sites(calling.chi2_columns(_fallback_bg(spark, sf)))
    return s.select("sample", *KEYS, "uncon", "depth", F.round("stat", 6).alias("stat"), "tested", F.round("p", 9).alias("p"))


@register(
    "any_sample_significant", "P19",
    fx.with_fixtures(
        ["site_counts"],
        "select sample, chrom, pos, strand, uncon, depth, tested, p from t "
        "where (chrom, pos, strand) in (select chrom, pos, strand from t where tested)",
        [("prep", _PREP_SQL), ("points", _POINTS_SQL), ("bgt", _BG_SQL), ("t", _P_SQL)],
    ),
)
def any_sample_significant(spark, sf):
    """Every library row of sites where some library has p < 1 (fallback background)."""
    scored = calling.score_sites(_fallback_bg(spark, sf))
    kept = calling.keep_significant(scored, KEYS)
    return kept.select("sample", *KEYS, "uncon", "depth", (F.col("p") < 1).alias("tested"), F.round("p", 9).alias("p"))


def _renamed_for_pool(df: DataFrame) -> DataFrame:
    m = F.col("sample")
    for old, new in fx.POOLED_RENAME.items():
        m = F.when(F.col("sample") == old, F.lit(new)).otherwise(m)
    return df.withColumn("sample", m)


_POOL_SQL = (
    "select chrom, pos, strand, motif, case when strpos(sample, '-p-') > 0 then concat(split_part(sample, '-p-', 1), '-FTO') else sample end as sample, "
    "cast(sum(uncon) as bigint) as uncon, cast(sum(depth) as bigint) as depth from "
    "(select * replace (case sample when 's2' then 's1-p-1' when 's3' then 's1-p-2' else sample end as sample) from site_counts) group by all"
)


@register("treated_pool", "A8", fx.with_fixtures(["site_counts"], _POOL_SQL))
def treated_pool(spark, sf):
    """``<s>-p-*`` libraries summed into ``<s>-FTO`` (here s2, s3 renamed s1-p-1, s1-p-2)."""
    df = _renamed_for_pool(_sc(spark, sf))
    return calling.pool_treated(df, [*KEYS, "motif"]).select(*KEYS, "motif", "sample", "uncon", "depth")


# A7 / P18 / F9 / K3 ------------------------------------------------------------
_GROUP_SQL = (
    "select g.grp as \"group\", chrom, pos, strand, any_value(motif) as motif, cast(sum(uncon) as bigint) as uncon, cast(sum(depth) as bigint) as depth "
    "from site_counts s join (values ('g1', 's0'), ('g1', 's1'), ('g2', 's2'), ('g2', 's3')) g(grp, smp) on s.sample = g.smp group by all"
)


def _pooled_groups(spark, sf) -> DataFrame:
    gt = groups.group_table(spark, fx.GROUPS)
    return groups.pool_groups(_sc(spark, sf), gt, [*KEYS])


register("replicate_pool", "A7", fx.with_fixtures(["site_counts"], _GROUP_SQL))(
    lambda spark, sf: _pooled_groups(spark, sf).select("group", *KEYS, "motif", "uncon", "depth")
)
register(
    "group_min_depth", "P18",
    fx.with_fixtures(["site_counts"], "select * from grp where depth >= 20 and strand <> '.'", [("grp", _GROUP_SQL)]),
)(lambda spark, sf: groups.group_test(_pooled_groups(spark, sf)).select("group", *KEYS, "motif", "uncon", "depth"))

_BINOM_SQL = (
    "select \"group\", chrom, pos, strand, uncon, depth, "
    "round(case when uncon <= 0 or depth <= 0 then 1.0 when uncon > depth then 0.0 else "
    "list_sum(list_transform(range(uncon, depth + 1), lambda j: exp(lgamma(depth + 1) - lgamma(j + 1) - lgamma(depth - j + 1) "
    "+ j * ln(0.01) + (depth - j) * ln(0.99)))) end, 8) as p from grp where depth >= 20 and strand <> '.'"
)


@register("binom_pvalue", "F9", fx.with_fixtures(["site_counts"], _BINOM_SQL, [("grp", _GROUP_SQL)]))
def binom_pvalue(spark, sf):
    """P(X >= uncon), X ~ Binomial(depth, 0.01); 1 when uncon or depth <= 0."""
    t = groups.group_test(_pooled_groups(spark, sf))
    return t.select("group", *KEYS, "uncon", "depth", F.round("p", 8).alias("p"))


# entry: the minimum slice -------------------------------------------------------
def flagship(spark: SparkSession, sf: str, fitted: bool = True) -> DataFrame:
    """Which sites are modified in which library: merge -> background fit -> chi-square -> any p < 1."""
    long = merge.merge_site_counts(_sc(spark, sf), PIPE_SAMPLES, PIPE_REQUIRES, 3)
    params = None if fitted else bg.fallback_background(bg.background_points(calling.prepare_sites(long)))
    pool = any(calling.POOL_MARK in smp for smp in PIPE_SAMPLES)  # treated libraries in the design?
    called, _, _ = calling.call_sites(long, KEYS, Options(), params=params, pool=pool)
    return called.select("sample", *KEYS, "motif", "motif3", "gc_pct", "uncon", "depth", "background", "ratio", "p")


# entry B with a fixed parameter table in place of the fit: rates by the 3-mer's first base, none for CAC; libraries pooled
_FIXED_RATES = {"A": (2e-4, 7.0), "C": (1e-4, 9.0), "G": (3e-4, 5.0), "U": (1e-4, 8.0)}
_FIXED_SQL = (
    "select *, case when motif3 = 'CAC' then null " + " ".join(f"when motif3[1] = '{m}' then {a} * exp({b} * (gc_pct * 0.01))" for m, (a, b) in _FIXED_RATES.items()) + " end as background from prep"
)


@register(
    "call_sites_fixed", "entry B",
    fx.with_fixtures(
        ["site_counts"],
        "select sample, chrom, pos, strand, motif, motif3, gc_pct, uncon, depth, round(background, 9) as background, round(uncon::double / depth, 9) as ratio, p from t "
        "where (chrom, pos, strand) in (select chrom, pos, strand from t where p < 1)",
        [("pooled", _POOL_SQL), ("prep", _PREP_SQL.replace("from site_counts", "from pooled")), ("bgt", _FIXED_SQL), ("t", _P_SQL)],
    ),
)
def call_sites_fixed(spark, sf):
    """Entry B, all but the fit: pooled libraries, background by a fixed parameter table, chi-square p, sites with any p < 1."""
    long = _renamed_for_pool(_sc(spark, sf))
    first = F.substring("motif3", 1, 1)
    pick = lambda i: F.coalesce(*[F.when(first == m, F.lit(ab[i])) for m, ab in _FIXED_RATES.items()])
    found = calling.prepare_sites(calling.pool_treated(long, [*KEYS, "motif"])).select("sample", "motif3").distinct().where("motif3 <> 'CAC'")
    params = found.select("sample", "motif3", pick(0).alias("a"), pick(1).alias("b"))
    called, _, _ = calling.call_sites(long, KEYS, Options(), params=params, pool=True)
    return called.select("sample", *KEYS, "motif", "motif3", "gc_pct", "uncon", "depth", F.round("background", 9).alias("background"), F.round("ratio", 9).alias("ratio"), F.round("p", 9).alias("p"))


register("call_sites", "entry B")(lambda spark, sf: flagship(spark, sf, True))


@register(
    "sort_motif", "O3",
    fx.with_fixtures(["site_counts"], "select * from points order by motif3, gc, sample", [("prep", _PREP_SQL), ("points", _POINTS_SQL)]),
)
def sort_motif(spark, sf):
    """O3: fit points ordered by 3-mer, then GC, then sample (as they are fitted and reported)."""
    return bg.background_points(_prepared(spark, sf)).orderBy("motif3", "gc", "sample")
