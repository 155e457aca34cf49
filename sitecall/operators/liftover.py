"""Transcript -> genome liftover and merged site table.

Exons are derived per transcript row without a shuffle: the span list is split,
exon lengths are prefix-summed inside the array (listed order, 5' -> 3'), and
the array is exploded.  The site -> exon join is an equi-join on the gene plus
a residual range predicate; the exon table is bounded by the annotation (not by
the sequencing data) and is broadcast behind a check of its bytes, else joined by
bins of the transcript position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitecall.functions.coords import liftover_pos
from sitecall.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, sized_side
from sitecall.operators.sites import SITE_KEYS


def exon_offsets(transcripts: DataFrame) -> DataFrame:
    """(gene_id, chrom, strand, spans) -> one row per exon with transcript offsets.

    Output: _tx_row (id of the transcript row), gene_name, ex_chrom, ex_strand,
    g_start, g_end (0-based half-open), tx_start, tx_end (running sum of exon
    lengths in listed order).  Duplicate gene rows are kept, each with its own
    offsets (no de-duplication).
    """
    spans = F.split(F.col("spans"), ",")
    exons = F.transform(
        spans,
        lambda s: F.struct(
            (F.split(s, "-", 2).getItem(0).cast("bigint") - 1).alias("g_start"),
            F.split(s, "-", 2).getItem(1).cast("bigint").alias("g_end"),
        ),
    )
    lens = F.transform(F.col("_ex"), lambda e: e["g_end"] - e["g_start"])
    with_off = F.transform(
        F.col("_ex"),
        lambda e, i: F.struct(
            e["g_start"].alias("g_start"),
            e["g_end"].alias("g_end"),
            F.aggregate(F.slice(F.col("_len"), 1, i), F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("tx_start"),
        ),
    )
    return (
        transcripts.select(
            F.monotonically_increasing_id().alias("_tx_row"),
            F.col("gene_id").alias("gene_name"),
            F.col("chrom").alias("ex_chrom"),
            F.col("strand").alias("ex_strand"),
            exons.alias("_ex"),
        )
        .withColumn("_len", lens)
        .select("_tx_row", "gene_name", "ex_chrom", "ex_strand", F.explode(with_off).alias("e"))
        .select(
            "_tx_row", "gene_name", "ex_chrom", "ex_strand", "e.g_start", "e.g_end", "e.tx_start",
            (F.col("e.tx_start") + F.col("e.g_end") - F.col("e.g_start")).alias("tx_end"),
        )
    )


def liftover_sites(tx_long: DataFrame, exons: DataFrame, broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, width: int = 1000) -> DataFrame:
    """Lift transcript sites to genome coordinates (J4 + F5).

    ``tx_long``: sample, chrom (= gene), pos (1-based), strand, motif, uncon, depth.
    Unknown gene -> kept with chrom = gene, strand ".", same position.
    Known gene, position outside every exon -> dropped.
    The transcript strand is discarded; the exon strand is used.
    Output: chrom, pos, strand, gene_name, gene_pos, motif, sample, uncon, depth.

    An exon table whose bytes allow it is broadcast and joined by gene. A larger one is joined by gene as one row a gene,
    its exons in a map by position div ``width``: an exon stands in each bin that it overlaps, so a site is compared with
    the exons of one bin, not of its gene, and the sites are read once, whether their gene is known or not.
    """
    t = tx_long.select(
        F.col("chrom").alias("gene"), F.col("pos").cast("bigint").alias("gene_pos"),
        "motif", "sample", "uncon", "depth",
    ).withColumn("_gp0", F.col("gene_pos") - 1)
    ex, small = sized_side(exons, broadcast_max_bytes)
    gp0 = F.col("_gp0")
    if small:
        inside = (gp0 >= F.col("tx_start")) & (gp0 < F.col("tx_end"))
        joined = t.join(ex, t["gene"] == ex["gene_name"], "left").where(F.col("ex_chrom").isNull() | inside)
    else:
        bins = ex.where(F.col("gene_name").isNotNull()).select(
            "gene_name", F.struct("ex_chrom", "ex_strand", "g_start", "g_end", "tx_start", "tx_end").alias("_e"),
            F.explode_outer(F.sequence(F.expr(f"tx_start div {width}"), F.expr(f"greatest(tx_end - 1, tx_start) div {width}"))).alias("_bin"),
        )
        filled = F.when(F.col("_bin").isNotNull(), F.struct("_bin", "_es"))
        genes = bins.groupBy("gene_name", "_bin").agg(F.collect_list("_e").alias("_es")).groupBy("gene_name").agg(
            F.map_from_entries(F.collect_list(filled)).alias("_at"))
        hits = F.filter(F.try_element_at("_at", F.expr(f"_gp0 div {width}")), lambda e: (gp0 >= e["tx_start"]) & (gp0 < e["tx_end"]))
        # no exon: a site of a known gene outside its exons goes, one of an unknown gene stays
        none = F.array(F.lit(None).cast(bins.schema["_e"].dataType))
        joined = t.join(genes, F.col("gene") == F.col("gene_name"), "left").select(
            *t.columns, F.explode(F.when(F.col("gene_name").isNull(), none).otherwise(hits)).alias("_e"),
        ).select(*t.columns, "_e.*")
    return joined.select(
        F.coalesce(F.col("ex_chrom"), F.col("gene")).alias("chrom"),
        liftover_pos(F.col("ex_strand"), "g_start", "g_end", "tx_start", "_gp0").cast("bigint").alias("pos"),
        F.coalesce(F.col("ex_strand"), F.lit(".")).alias("strand"),
        F.col("gene").alias("gene_name"),
        F.col("gene_pos"),
        "motif", "sample", "uncon", "depth",
    )


def merge_transcript_genome(lifted: DataFrame, genome_long: DataFrame, min_depth: int = 1) -> DataFrame:
    """Union lifted transcript rows with genome rows and re-aggregate per site.

    Per genomic site: counts summed per sample; ``gene_names`` = distinct genes
    in first-seen order (transcript rows first, then by gene and gene position),
    nulls dropped, ``;``-joined; ``gene_pos`` = each listed gene's position at
    its first row; ``motif`` = first motif in the same order; sites whose depth
    summed over samples is < ``min_depth`` are dropped.

    One shuffle on (chrom, pos, strand) and one sort by it: a window yields the
    site total, the gene list (bounded by the genes overlapping one site) and the
    first motif; the per-sample sums then group by site-level columns on the same
    partitioning (no further shuffle).
    Output (long): chrom, pos, strand, gene_names, gene_pos, motif, sample, uncon, depth.
    """
    t = lifted.select(*SITE_KEYS, F.lit(0).alias("_src"), "gene_name", "gene_pos", "motif", "sample", "uncon", "depth")
    g = genome_long.select(
        *SITE_KEYS, F.lit(1).alias("_src"), F.lit(None).cast("string").alias("gene_name"),
        F.lit(None).cast("bigint").alias("gene_pos"), "motif", "sample", "uncon", "depth",
    )
    w = _site()
    first = F.min(F.struct("_src", *_motif_order())).over(w)
    y = t.unionByName(g).select("*", F.sum("depth").over(w).alias("_tot"), _genes(w).alias("_g"), first["motif"].alias("_m"))
    return _sample_sums(y.where(F.col("_tot") >= min_depth))


def _site():
    """A site's rows, in no order; sorted by the position first, as it parts most sites without comparing strings."""
    return Window.partitionBy("pos", "chrom", "strand")


def _motif_order() -> list:
    """Columns whose lowest struct holds a site's first motif: by gene and position, of equal rows the lowest, a missing one last."""
    return [F.col("gene_name"), F.col("gene_pos"), F.col("motif").isNull().alias("_none"), F.col("motif")]


def _genes(w):
    """The (gene, position) pairs at a site; not sorted yet, as a window computes them once a site but its reader once a row."""
    return F.collect_set(F.when(F.col("gene_name").isNotNull(), F.struct("gene_name", "gene_pos"))).over(w)


def _sample_sums(y: DataFrame) -> DataFrame:
    """Second level of entry C: the sums per sample of rows (keys, sample, uncon, depth) with their site's genes _g and motif _m."""
    # sorted by (gene, position): a gene's first entry holds its first position
    firsts = F.filter("_s", lambda x, i: F.coalesce(F.get(F.col("_s"), i - 1)["gene_name"] != x["gene_name"], F.lit(True)))

    def listed(field: str):
        joined = F.array_join(F.transform(firsts, lambda x: x[field].cast("string")), ";")
        one = F.coalesce(F.get("_g", F.lit(0))[field].cast("string"), F.lit(""))
        return F.when(F.size("_g") > 1, joined).otherwise(one)  # most sites have one gene or none

    z = y.withColumn("_s", F.when(F.size("_g") > 1, F.array_sort("_g"))).select(
        *SITE_KEYS, listed("gene_name").alias("gene_names"), listed("gene_pos").alias("gene_pos"), F.col("_m").alias("motif"),
        "sample", "uncon", "depth",
    )
    return z.groupBy(*SITE_KEYS, "gene_names", "gene_pos", "motif", "sample").agg(
        F.sum("uncon").alias("uncon"), F.sum("depth").alias("depth")
    )


def merge_lifted_with_genome(lifted: DataFrame, genome_long: DataFrame, samples, requires,
                             merge_min_depth: int = 3, min_depth: int = 1) -> DataFrame:
    """Entry C in one shuffle of the genome rows: the genome sample merge and the
    merged-site aggregation share the site partitioning, the sort and the window.

    Genome rows are merged across samples exactly as ``merge.merge_site_counts``
    (base samples, depth filter before the first optional sample, motif by rank);
    whether a site's genome rows stay is known once a site, so its total is that of
    its transcript rows and, if they stay, that of its genome rows.  Same output as
    :func:`merge_transcript_genome` after merging the genome rows first.
    """
    from sitecall.operators.joins import literal_map
    from sitecall.operators.merge import base_size, merge_order

    ordered = merge_order(samples, requires)
    k = base_size(ordered)
    shrink = k < len(ordered)
    rank = literal_map({s: i for i, (s, _) in enumerate(ordered)})
    t = lifted.select(*SITE_KEYS, F.lit(0).alias("_src"), "gene_name", "gene_pos", "motif", "sample", "uncon", "depth",
                      F.lit(None).cast("bigint").alias("_rank"))
    g = genome_long.where(F.col("sample").isin([s for s, _ in ordered])).select(
        *SITE_KEYS, F.lit(1).alias("_src"), F.lit(None).cast("string").alias("gene_name"),
        F.lit(None).cast("bigint").alias("gene_pos"), "motif", "sample", "uncon", "depth",
        F.element_at(rank, F.col("sample")).alias("_rank"),
    )
    u = t.unionByName(g).repartition("pos", "chrom", "strand")  # as the window deals them, without the columns it adds
    w = _site()
    is_g = F.col("_src") == 1
    is_base = is_g & (F.col("_rank") < k)
    y = u.select(
        "*",
        F.coalesce(F.max(is_base).over(w), F.lit(False)).alias("_in"),
        F.coalesce(F.max(F.when(is_base, F.col("depth"))).over(w), F.lit(0)).alias("_bm"),
        F.min(F.when(is_g & F.col("motif").isNotNull(), F.struct("_rank", "motif"))).over(w)["motif"].alias("_gm"),
        F.sum(F.when(is_g, F.col("depth"))).over(w).alias("_gd"),
        F.min(F.when(~is_g, F.struct(*_motif_order()))).over(w).alias("_t"),
        F.sum(F.when(~is_g, F.col("depth"))).over(w).alias("_td"),
        _genes(w).alias("_g"),
    )
    keep_g = F.col("_in") & ((F.col("_bm") >= merge_min_depth) if shrink else F.lit(True))
    total = F.when(keep_g, F.coalesce(F.col("_gd") + F.col("_td"), F.col("_gd"), F.col("_td"))).otherwise(F.col("_td"))
    # a site with transcript rows takes the first of their motifs
    y = y.where((~is_g | keep_g) & (total >= min_depth)).withColumn("_m", F.when(F.col("_t").isNotNull(), F.col("_t.motif")).otherwise(F.col("_gm")))
    return _sample_sums(y)
