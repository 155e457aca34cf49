"""Per-base counting from aligned reads: site pileup (A1), spike-in calibration (A15, A16,
F11, F12) and whole-alignment liftover (J11, O6).

Aligned bases are counted per Arrow batch (``basecount``) and the partial counts
are summed by Spark: a reference with a third of all reads adds rows to many
tasks' partials, never to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.functions.motif import col
from sitecall.operators.basecount import aligned_pair_partials
from sitecall.operators.joins import bounded_broadcast
from sitecall.options import PROBE_MIN_SUPPORT, SIGNAL_POS

MOTIF_HALF = 15  # motif = 15 bases each side of the site


# F11 / F12 -----------------------------------------------------------------
def probe_rate(reference) -> Column:
    """Last ``_`` token of the reference name if it is all digits, else 0."""
    last = F.element_at(F.split(col(reference), "_"), -1)
    return F.when(last.rlike("^[0-9]+$"), last.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def read_min_support(df: DataFrame, min_support: int = PROBE_MIN_SUPPORT) -> DataFrame:
    """Keep reads whose Yf + Zf >= min_support (a missing tag drops the read)."""
    return df.where((F.col("yf") + F.col("zf")) >= min_support)


# A15 / A16 -----------------------------------------------------------------
def spike_counts(probe_reads: DataFrame, prefix: str = "probe_", signal_pos: int = SIGNAL_POS) -> DataFrame:
    """(sample, rate, is_signal, ref_base, read_base) -> aligned base pairs.

    Input: sample, reference, ref_seq, seq (ungapped, base i of seq on base i of ref_seq), yf, zf.
    """
    r = read_min_support(probe_reads.where(F.col("reference").startswith(prefix)))
    c = aligned_pair_partials(r.withColumn("rate", probe_rate("reference")), ["sample", "rate"])
    return c.groupBy(
        "sample", "rate", (F.col("pos") == signal_pos).alias("is_signal"), F.upper("ref_base").alias("ref_base"), "read_base",
    ).agg(F.sum("n").alias("n"))


def _pct(num: Column, den: Column) -> Column:
    """``f"{x:.3%}"``: x * 100 with 3 decimals (round-half-even on the double) and a % sign."""
    return F.when(den > 0, F.concat(F.format_number(num * F.lit(100.0) / den, 3), F.lit("%")))


def spike_ratio(counts: DataFrame) -> DataFrame:
    """Per (sample, rate) seen in background positions: m6A% at the signal base
    (``NA`` without A reads there), A->G and C->T conversion elsewhere (null without A/C)."""

    def n(sig: bool, ref: str, read: str) -> Column:
        return F.sum(F.when((F.col("is_signal") == sig) & (F.col("ref_base") == ref) & (F.col("read_base") == read), F.col("n")).otherwise(0))

    g = counts.groupBy("sample", "rate").agg(
        n(True, "A", "A").alias("s_aa"), n(True, "A", "G").alias("s_ag"),
        n(False, "A", "A").alias("b_aa"), n(False, "A", "G").alias("b_ag"),
        n(False, "C", "C").alias("b_cc"), n(False, "C", "T").alias("b_ct"),
        F.max(~F.col("is_signal")).alias("_has_bg"),
    ).where("_has_bg")
    return g.select(
        "sample", "rate",
        F.coalesce(_pct(F.col("s_aa"), F.col("s_aa") + F.col("s_ag")), F.lit("NA")).alias("m6a_pct"),
        _pct(F.col("b_ag"), F.col("b_aa") + F.col("b_ag")).alias("a_convert_pct"),
        _pct(F.col("b_ct"), F.col("b_cc") + F.col("b_ct")).alias("c_convert_pct"),
    )


# A1 -------------------------------------------------------------------------
def default_tier(min_support: int = PROBE_MIN_SUPPORT) -> Column:
    """Our read-level tier rule: 0 = low support (Yf + Zf < 5), 1 = Zf <= 2, 2 = otherwise."""
    return F.when((F.col("yf") + F.col("zf")) < min_support, F.lit(0)).when(F.col("zf") <= 2, F.lit(1)).otherwise(F.lit(2))


def pileup_counts(reads: DataFrame, ref_base: str = "A", mut_base: str = "G", tier: Column | None = None,
                  chrom: str = "reference") -> DataFrame:
    """Six-count pileup at reference ``ref_base`` positions: u<t> = read shows ``ref_base``
    (unconverted), m<t> = read shows ``mut_base`` (converted), per tier t.

    Input: sample, <chrom>, ref_seq, seq (ungapped, read base i on reference base i), yf, zf.
    Output: sample, chrom, pos, strand, motif (31 bases, N-padded), u0 u1 u2 m0 m1 m2.
    """
    tier = default_tier() if tier is None else tier
    ref_base, mut_base = ref_base.upper(), mut_base.upper()
    r = reads.select("sample", F.col(chrom).alias("chrom"), tier.alias("tier"), "ref_seq", "seq")
    # the motif window comes with the counts (functionally dependent on chrom, pos); the batch counts are summed
    # in their task before the one shuffle, so a hot site sends one row a task
    c = aligned_pair_partials(r, ["sample", "chrom", "tier"], context=MOTIF_HALF).where(F.upper("ref_base") == ref_base)
    b = F.upper("read_base")
    aggs = []
    for base, prefix in ((ref_base, "u"), (mut_base, "m")):
        for t in (0, 1, 2):
            aggs.append(F.sum(F.when((F.col("tier") == t) & (b == base), F.col("n")).otherwise(0)).cast("bigint").alias(f"{prefix}{t}"))
    g = c.groupBy("sample", "chrom", "pos", F.col("context").alias("motif")).agg(*aggs)
    return g.select(
        "sample", "chrom", F.col("pos").cast("bigint").alias("pos"), F.lit("+").alias("strand"), "motif",
        *[F.col(f"u{t}") for t in (0, 1, 2)], *[F.col(f"m{t}") for t in (0, 1, 2)],
    )


# J11 / O6 -----------------------------------------------------------------------
def gene_exon_arrays(exons: DataFrame) -> DataFrame:
    """One row per transcript row: (gene_name, ex_chrom, ex_strand, exons array), listed order.

    Bounded by the annotation; a gene listed twice keeps two rows.
    """
    return exons.groupBy("gene_name", "ex_chrom", "ex_strand", "_tx_row").agg(
        F.array_sort(F.collect_list(F.struct("tx_start", "tx_end", "g_start", "g_end"))).alias("exons")
    ).drop("_tx_row")


def alignment_liftover(tx_aln: DataFrame, exons: DataFrame, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Lift transcript-coordinate alignments to genome blocks, one block per overlapped exon.

    Input: sample, read_id, gene, tx_pos (1-based start), aln_len.  Unknown genes
    cannot be lifted and are dropped; parts beyond the transcript are clipped.
    Output: sample, read_id, gene, chrom, strand, pos (1-based genomic start),
    blocks (``start-end`` 1-based inclusive, genomic order), n_blocks, aligned.

    Each alignment meets the exon array of its gene (broadcast after a size
    check) and its blocks are built within the row: no shuffle of alignments.
    """
    ex = exons if "_tx_row" in exons.columns else exons.withColumn("_tx_row", F.lit(0))
    arrays, _ = bounded_broadcast(gene_exon_arrays(ex), broadcast_max_rows)
    a = tx_aln.select("sample", "read_id", "gene", (F.col("tx_pos") - 1).alias("_as"), (F.col("tx_pos") - 1 + F.col("aln_len")).alias("_ae"))
    s0, e0 = F.col("_as"), F.col("_ae")
    plus = F.col("ex_strand") == "+"
    # exons are in transcript order and tile [0, transcript length): genomic order is
    # the same order on "+" and the reverse on "-", and the aligned length is the
    # overlap of the alignment with the transcript (two array passes in total)
    hit = F.filter("exons", lambda e: (s0 < e["tx_end"]) & (e0 > e["tx_start"]))
    ordered = F.when(plus, F.col("_hit")).otherwise(F.reverse("_hit"))

    def bs(e):
        return F.when(plus, e["g_start"] + (F.greatest(s0, e["tx_start"]) - e["tx_start"])).otherwise(
            e["g_end"] - (F.least(e0, e["tx_end"]) - e["tx_start"]))

    def be(e):
        return F.when(plus, e["g_start"] + (F.least(e0, e["tx_end"]) - e["tx_start"])).otherwise(
            e["g_end"] - (F.greatest(s0, e["tx_start"]) - e["tx_start"]))

    tx_len = F.element_at("exons", -1)["tx_end"]
    x = a.join(arrays, a["gene"] == arrays["gene_name"], "inner").select(
        "sample", "read_id", "gene", F.col("ex_chrom").alias("chrom"), F.col("ex_strand").alias("strand"),
        "_as", "_ae", "ex_strand", "exons", hit.alias("_hit"),
    ).where(F.size("_hit") > 0).withColumn("_ord", ordered)
    first = F.element_at("_ord", 1)

    def block(e):
        return F.concat((bs(e) + 1).cast("string"), F.lit("-"), be(e).cast("string"))

    # up to three blocks as plain (code-generated) expressions; longer lists take the
    # array pass, evaluated only in that branch
    n = F.size("_ord")
    few = F.concat_ws(",", *[F.when(n >= i, block(F.element_at("_ord", i))) for i in (1, 2, 3)])
    blocks = F.when(n <= 3, few).otherwise(F.array_join(F.transform("_ord", block), ","))
    return x.select(
        "sample", "read_id", "gene", "chrom", "strand",
        (bs(first) + 1).alias("pos"),
        blocks.alias("blocks"),
        n.cast("bigint").alias("n_blocks"),
        (F.least(e0, tx_len) - F.greatest(s0, F.lit(0))).cast("bigint").alias("aligned"),
    )


def genome_alignment_blocks(aln: DataFrame) -> DataFrame:
    """Genome alignments in the lifted layout (one ungapped block)."""
    end = F.col("pos") + F.col("qlen") - F.col("sclen") - 1
    return aln.select(
        "sample", "read_id", F.lit(None).cast("string").alias("gene"), "chrom", "strand", F.col("pos").cast("bigint").alias("pos"),
        F.concat(F.col("pos").cast("string"), F.lit("-"), end.cast("string")).alias("blocks"),
        F.lit(1).cast("bigint").alias("n_blocks"), (F.col("qlen") - F.col("sclen")).cast("bigint").alias("aligned"),
    )


def union_lifted(lifted: DataFrame, genome: DataFrame, keys: Sequence[str] = ("sample", "chrom", "pos", "read_id")) -> DataFrame:
    """Lifted transcript alignments plus genome alignments, coordinate-sorted."""
    return lifted.unionByName(genome).orderBy(*keys)
