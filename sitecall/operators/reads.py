"""Read/alignment layer.

The aligners stay outside; their output is an alignment table
(sample, run, read_id, reftype, chrom, pos, strand, flag, qlen, sclen, xm, ns,
nc, umi, isize, mapq).  Per-read logic (routing, mates, competition) is one
aggregate keyed by the read, whose groups are bounded by the alignments of one
read; where whole records are carried (competition) it sorts.  Duplicate marking folds records to fragments and fragments to
duplicate sets with map-side partial aggregation, so a hugely duplicated fragment cannot skew one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.functions.cigar import five_prime_of
from sitecall.functions.motif import col
from sitecall.options import Options

READ_KEYS = ("sample", "run", "read_id")

# Fixed SAM flag bits.
PAIRED, PROPER, UNMAP, MUNMAP, REVERSE, READ1, READ2 = 0x1, 0x2, 0x4, 0x8, 0x10, 0x40, 0x80
SECONDARY, QCFAIL, DUP, SUPPLEMENTARY = 0x100, 0x200, 0x400, 0x800


def bit(flag, mask: int) -> Column:
    return (col(flag).bitwiseAND(F.lit(mask))) != 0


# P3 / P4 / P5 / P6 ---------------------------------------------------------
def premap_accept_pe(opts: Options = Options()) -> Column:
    aligned = F.col("qlen") - F.col("sclen")
    return (
        bit("flag", PROPER) & ~bit("flag", UNMAP) & ~bit("flag", MUNMAP)
        & (aligned >= opts.premap_min_aligned) & (F.col("xm") * opts.premap_xm_factor < aligned)
    )


def premap_accept_se(opts: Options = Options()) -> Column:
    aligned = F.col("qlen") - F.col("sclen")
    return ~bit("flag", UNMAP) & (aligned >= opts.premap_min_aligned) & (F.col("xm") * opts.premap_xm_factor < aligned)


def remap_accept(opts: Options = Options()) -> Column:
    rate = F.try_divide(F.col("ns") + F.col("nc") * opts.remap_nc_weight, F.col("qlen").cast("double"))
    return (rate <= opts.remap_max_mismatch_rate) & ~bit("flag", SECONDARY)


def mainmap_accept(opts: Options = Options()) -> Column:
    """Our column definition of the main mapper's thresholds (its formulas are external):
    mapped ratio (qlen - sclen) / qlen >= 0.8, mismatches ns <= 6, converted ratio nc / (qlen - sclen) <= 0.33.
    """
    aligned = (F.col("qlen") - F.col("sclen")).cast("double")
    return (
        ~bit("flag", UNMAP)
        & (F.try_divide(aligned, F.col("qlen").cast("double")) >= opts.mainmap_min_mapped_ratio)
        & (F.col("ns") <= opts.mainmap_max_mismatches)
        & (F.try_divide(F.col("nc").cast("double"), aligned) <= opts.mainmap_max_converted_ratio)
    )


def premap_accept(opts: Options = Options()) -> Column:
    """Paired records use the paired rule, single-end records the single-end rule."""
    return F.when(bit("flag", PAIRED), premap_accept_pe(opts)).otherwise(premap_accept_se(opts))


def stage_accept(opts: Options = Options()) -> Column:
    rt = F.col("reftype")
    return (
        F.when(rt == "contamination", premap_accept(opts))
        .when(rt.isin("genes", "transcript"), mainmap_accept(opts))
        .when(rt == "genome", remap_accept(opts))
    )


# P7 / P8 --------------------------------------------------------------------
def accept_reject_split(aln: DataFrame, predicate: Column) -> DataFrame:
    """Materialise ``ok`` once (null counts as rejected); route with ``where(ok)`` / ``where(!ok)``."""
    return aln.withColumn("ok", F.coalesce(predicate, F.lit(False)))


def accept_counts(split: DataFrame, by: Sequence[str] = ("sample", "run", "reftype")) -> DataFrame:
    return split.groupBy(*by).agg(
        F.count_if(F.col("ok")).alias("passed"), F.count_if(~F.col("ok")).alias("rejected")
    )


# P9 / P10 -------------------------------------------------------------------
def primary_reads(aln: DataFrame) -> DataFrame:
    """Exclude secondary and supplementary records (flag & 0x900 = 0)."""
    return aln.where(~bit("flag", SECONDARY | SUPPLEMENTARY))


def split_mates(rejected: DataFrame) -> DataFrame:
    """Rejected primary records of complete pairs, labelled R1/R2; singletons and others dropped.

    Read-keyed aggregate (bounded by one read's records), then explode.
    """
    p = primary_reads(rejected).withColumn(
        "mate",
        F.when(bit("flag", READ1) & ~bit("flag", READ2), F.lit("R1"))
        .when(bit("flag", READ2) & ~bit("flag", READ1), F.lit("R2")),
    ).where(F.col("mate").isNotNull())
    other = [c for c in p.columns if c not in READ_KEYS]
    g = p.groupBy(*READ_KEYS).agg(
        F.max(F.col("mate") == "R1").alias("_r1"), F.max(F.col("mate") == "R2").alias("_r2"),
        F.collect_list(F.struct(*other)).alias("_recs"),
    )
    return g.where("_r1 and _r2").select(*READ_KEYS, F.explode("_recs").alias("_x")).select(*READ_KEYS, "_x.*")


# P11 / P12 ------------------------------------------------------------------
def adapter_clip(reads: DataFrame, adapter: str, umi_len: int = 0, min_overlap: int = 3) -> DataFrame:
    """Clip at the first full occurrence of a literal 3' adapter, else at a 3' partial
    adapter (prefix of >= ``min_overlap`` bases at the read end); move a fixed-length
    UMI prefix into ``umi``.  Quality strings are clipped alike.
    """
    seq = F.col("seq")
    n = F.length(seq)
    full = F.instr(seq, adapter)  # 1-based, 0 if absent
    partial = None  # flat CASE chain, longest adapter prefix first
    for k in range(len(adapter) - 1, min_overlap - 1, -1):
        cond, val = seq.endswith(adapter[:k]), n - k + 1
        partial = F.when(cond, val) if partial is None else partial.when(cond, val)
    if partial is None:
        partial = F.lit(None).cast("int")
    cut = F.when(full > 0, full).otherwise(F.coalesce(partial, n + 1))  # first clipped position
    keep_len = cut - 1
    # as a generated column: a filter on the clipped read is then not rewritten into one that clips it all over again
    out = reads.select("*", F.explode(F.array(keep_len)).alias("_keep"))
    if umi_len:
        out = out.withColumn("umi", F.substring("seq", 1, umi_len))
    start = umi_len + 1
    return out.withColumn("seq", F.expr(f"substring(seq, {start}, greatest(_keep - {umi_len}, 0))")).withColumn(
        "qual", F.expr(f"substring(qual, {start}, greatest(_keep - {umi_len}, 0))")
    ).drop("_keep")


def length_route(clipped: DataFrame, min_len: int = 20) -> DataFrame:
    """Route clipped reads: ``clean`` if length >= min_len else ``too_short``."""
    return clipped.withColumn("route", F.when(F.length("seq") < min_len, F.lit("too_short")).otherwise(F.lit("clean")))


# J8 -------------------------------------------------------------------------
def mate_join(aln: DataFrame) -> DataFrame:
    """Each primary paired record gets its mate's (chrom, pos, strand); single-end passes with nulls.

    If a read has several primary records of one mate, the lowest (chrom, pos,
    strand) is its mate (deterministic, no pair fan-out).
    """
    p = primary_reads(aln)
    is1, is2 = bit("flag", READ1), bit("flag", READ2)
    loc = F.struct("chrom", "pos", "strand")
    other = [c for c in p.columns if c not in READ_KEYS]
    g = p.groupBy(*READ_KEYS).agg(
        F.min(F.when(is1, loc)).alias("_m1"), F.min(F.when(is2, loc)).alias("_m2"),
        F.collect_list(F.struct(*other)).alias("_recs"),
    )
    x = g.select(*READ_KEYS, "_m1", "_m2", F.explode("_recs").alias("_x")).select(*READ_KEYS, "_m1", "_m2", "_x.*")
    paired = bit("flag", PAIRED)
    mate = F.when(paired & is1, F.col("_m2")).when(paired & is2, F.col("_m1"))
    return x.withColumn("_mate", mate).select(
        *READ_KEYS, *other,
        F.col("_mate.chrom").alias("mate_chrom"), F.col("_mate.pos").alias("mate_pos"), F.col("_mate.strand").alias("mate_strand"),
    )


# J9 / J10 -------------------------------------------------------------------
STAGES = ("contamination", "main", "genome")


def reject_cascade(aln: DataFrame, opts: Options = Options(), stages: Sequence[str] = STAGES, reads: DataFrame | None = None) -> DataFrame:
    """Final stage of each read: the first stage (contamination -> main -> genome) with an
    accepted alignment, else ``unmapped``.  Equals the chain of left-anti joins, as one
    read-keyed aggregate.  Stages not configured (no reference) are skipped.  ``reads`` (the
    cleaned reads) adds those without any alignment record, which are unmapped.
    """
    if reads is not None:
        aln = aln.unionByName(reads.select(*READ_KEYS), allowMissingColumns=True)
    ok = F.coalesce(stage_accept(opts), F.lit(False))
    st = F.col("reftype")
    flags = {
        "contamination": F.coalesce(F.max(ok & (st == "contamination")), F.lit(False)).alias("contamination"),
        "main": F.coalesce(F.max(ok & st.isin("genes", "transcript")), F.lit(False)).alias("main"),
        "genome": F.coalesce(F.max(ok & (st == "genome")), F.lit(False)).alias("genome"),
    }
    g = aln.groupBy(*READ_KEYS).agg(*[flags[s] for s in stages])
    stage = F.lit("unmapped")
    for s in reversed(stages):
        stage = F.when(F.col(s), F.lit(s)).otherwise(stage)
    return g.select(*READ_KEYS, stage.alias("stage"))


def alignment_score(opts: Options = Options()) -> Column:
    """Our competition score: aligned bases minus mismatches."""
    return F.col("qlen") - F.col("sclen") - F.col("ns")


def competitive_assign(aln: DataFrame, opts: Options = Options()) -> DataFrame:
    """Among accepted genes/transcript alignments of a read, keep one: highest score, then
    genes before transcript, then lowest (chrom, pos).  Hash aggregate with ``min(struct)``.
    """
    main = aln.where(F.col("reftype").isin("genes", "transcript") & F.coalesce(mainmap_accept(opts), F.lit(False)))
    prio = F.when(F.col("reftype") == "genes", F.lit(0)).otherwise(F.lit(1))
    other = [c for c in aln.columns if c not in READ_KEYS]
    best = main.groupBy(*READ_KEYS).agg(
        F.min(F.struct((-alignment_score(opts)).alias("_neg"), prio.alias("_prio"), *[F.col(c) for c in ("chrom", "pos")],
                       F.struct(*other).alias("_rec"))).alias("_b")
    )
    return best.select(*READ_KEYS, "_b._rec.*")


# W2 / A23 -------------------------------------------------------------------
def five_prime(aln: DataFrame) -> Column:
    """5' reference position of a record: from the CIGAR, clips counted as aligned, where the table has one, else the
    start on '+' and pos + qlen - sclen - 1 on '-'."""
    if "cigar" in aln.columns:
        return five_prime_of("cigar", "pos", F.col("strand") == "-")
    return F.when(F.col("strand") == "-", F.col("pos") + F.col("qlen") - F.col("sclen") - 1).otherwise(F.col("pos"))


FRAGMENT_KEYS = ("sample", "reftype", "run", "read_id")
DEDUP_KEYS = ("sample", "reftype", "end1", "end2", "umi")


def fragments(aln: DataFrame) -> DataFrame:
    """One narrow row a fragment: the 5' ends (chrom, strand, position) of its first and of its second mate, its UMI,
    the summed mapping quality and the number of its primary mapped records.

    A single read is its own first mate; a mate that is unmapped or missing is a null end. Where one mate has several
    primary records, the lowest end counts.
    """
    p = primary_reads(aln).where(~bit("flag", UNMAP))
    second = bit("flag", PAIRED) & bit("flag", READ2)
    end = F.struct("chrom", "strand", five_prime(aln).alias("five_prime"))
    return p.groupBy(*FRAGMENT_KEYS).agg(
        F.min(F.when(~second, end)).alias("end1"), F.min(F.when(second, end)).alias("end2"), F.min("umi").alias("umi"),
        F.sum("mapq").alias("mapq"), F.count(F.lit(1)).alias("records"),
    )


def dedup_alignments(aln: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the fragments with the same 5' ends of both mates and the same UMI, keep one with all its records: the best
    summed mapping quality, then the lowest read id, then run.

    Returns (kept primary mapped records, duplicate sets: end1, end2, umi, set_size, records, kept_records). Two levels,
    both partial aggregates: records fold to fragments, and a duplicate set of any size folds map-side to its winner,
    a narrow row that is joined back to the records, so that mates stay or go together.
    """
    f = fragments(aln)
    winner = F.struct((-F.col("mapq")).alias("negq"), "read_id", "run", F.col("records").alias("kept_records"))
    sets = f.groupBy(*DEDUP_KEYS).agg(
        F.min(winner).alias("_w"), F.count(F.lit(1)).alias("set_size"), F.sum("records").alias("records"),
    )
    won = sets.select(F.col("sample").alias("_s"), F.col("reftype").alias("_t"), F.col("_w.run").alias("_u"), F.col("_w.read_id").alias("_i"))
    p = primary_reads(aln).where(~bit("flag", UNMAP))
    same = F.lit(True)
    for ours, theirs in zip(FRAGMENT_KEYS, ("_s", "_t", "_u", "_i")):
        same = same & F.col(ours).eqNullSafe(F.col(theirs))
    kept = p.join(won, same, "left_semi").withColumn("five_prime", five_prime(aln))
    return kept, sets.select("*", "_w.kept_records").drop("_w")


def dedup_report(sets: DataFrame, by: Sequence[str] = ("sample", "reftype")) -> DataFrame:
    """Total, duplicates, unique records and duplication percentage."""
    g = sets.groupBy(*by).agg(F.sum("records").alias("total_reads"), F.sum("kept_records").alias("unique_reads"))
    dups = F.col("total_reads") - F.col("unique_reads")
    return g.select(
        *by, "total_reads", dups.alias("duplicates"), "unique_reads",
        (dups * F.lit(100.0) / F.col("total_reads")).alias("duplication_rate"),
    )


# A17 / A18 / A19 / A20 --------------------------------------------------------
def flag_classes() -> dict:
    """Flag classes as Columns (built on call: no Spark context is needed at import)."""
    return {
        "primary": ~bit("flag", SECONDARY | SUPPLEMENTARY),
        "secondary": bit("flag", SECONDARY),
        "supplementary": bit("flag", SUPPLEMENTARY),
        "duplicates": bit("flag", DUP),
        "mapped": ~bit("flag", UNMAP),
        "paired": bit("flag", PAIRED),
        "read1": bit("flag", PAIRED) & bit("flag", READ1),
        "read2": bit("flag", PAIRED) & bit("flag", READ2),
        "properly_paired": bit("flag", PAIRED) & bit("flag", PROPER) & ~bit("flag", UNMAP),
        "singletons": bit("flag", PAIRED) & ~bit("flag", UNMAP) & bit("flag", MUNMAP),
    }


def flag_stats(aln: DataFrame, by: Sequence[str] = ("sample", "reftype")) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(c).alias(k) for k, c in flag_classes().items()]
    return aln.groupBy(*by).agg(*aggs)


def read_count_r1(aln: DataFrame, by: Sequence[str] = ("sample", "reftype")) -> DataFrame:
    """Records that are neither secondary nor second mate (flag & 384 = 0)."""
    return aln.groupBy(*by).agg(F.count_if(~bit("flag", SECONDARY | READ2)).alias("n"))


def insert_size_hist(aln: DataFrame, max_isize: int = 1000, by: Sequence[str] = ("sample", "reftype")) -> DataFrame:
    """|isize| -> pairs, over primary properly paired first mates; the row ``max_isize + 1`` holds all larger sizes."""
    p = primary_reads(aln).where(bit("flag", PAIRED) & bit("flag", PROPER) & bit("flag", READ1))
    x = p.select(*by, F.least(F.abs("isize"), F.lit(max_isize + 1).cast(p.schema["isize"].dataType)).alias("isize"))
    return x.groupBy(*by, "isize").agg(F.count(F.lit(1)).alias("pairs"))


def read_length_hist(df: DataFrame, length: Column, by: Sequence[str] = ("sample", "reftype")) -> DataFrame:
    return df.groupBy(*by, length.alias("length")).agg(F.count(F.lit(1)).alias("count"))


# A21 -----------------------------------------------------------------------
STAGE_KEY_OF_REFTYPE = {"contamination": "Contamination", "genes": "Masking", "transcript": "Transcript", "genome": "Genome"}


def stage_counts(trim: DataFrame, passed: DataFrame, dedup: DataFrame) -> DataFrame:
    """Long (sample, key, value): Raw/Clean summed over runs, <Stage>_Passed/<Stage>_Dedup per reference type.

    ``trim``: sample, input, output per run; ``passed``/``dedup``: sample, reftype, n.
    Stages absent from the alignments are omitted.
    """
    raw = trim.groupBy("sample").agg(F.sum("input").alias("Raw"), F.sum("output").alias("Clean"))
    rc = raw.select("sample", F.stack(F.lit(2), F.lit("Raw"), "Raw", F.lit("Clean"), "Clean").alias("key", "value"))
    m = F.create_map(*[x for k, v in STAGE_KEY_OF_REFTYPE.items() for x in (F.lit(k), F.lit(v))])
    pa = passed.select("sample", F.concat(F.element_at(m, F.col("reftype")), F.lit("_Passed")).alias("key"), F.col("n").alias("value"))
    de = dedup.select("sample", F.concat(F.element_at(m, F.col("reftype")), F.lit("_Dedup")).alias("key"), F.col("n").alias("value"))
    return rc.unionByName(pa).unionByName(de).select("sample", "key", F.col("value").cast("bigint").alias("value"))


# A22 -----------------------------------------------------------------------
def read_qc(reads: DataFrame, by: Sequence[str] = ("sample", "mate")) -> DataFrame:
    """Per position: reads covering it, A/C/G/T/N counts, mean Phred quality (offset 33).

    Counted per Arrow batch (``basecount.position_stats``) and summed by Spark:
    no per-base rows are materialised.
    """
    from sitecall.operators.basecount import position_stats

    return position_stats(reads, list(by))


def read_gc(reads: DataFrame, by: Sequence[str] = ("sample", "mate")) -> DataFrame:
    """Per-read GC percent distribution (integer percent)."""
    s = F.upper("seq")
    gc = F.length(s) - F.length(F.regexp_replace(s, "[GC]", ""))
    pct = F.when(F.length(s) > 0, F.floor(gc * 100 / F.length(s))).cast("bigint")
    return reads.groupBy(*by, pct.alias("gc_pct")).agg(F.count(F.lit(1)).alias("count"))


def routed_qc(clean: DataFrame, aln: DataFrame, opts: Options = Options(), by: Sequence[str] = ("sample", "mate")) -> DataFrame:
    """QC tables of the clean reads and of those that end unmapped, in one pass over the reads.

    Each clean read meets its final stage (``reject_cascade``; none is unmapped); the reads are profiled once, parted by
    whether they are unmapped, and the small tables of both parts add up to those of all clean reads.
    Output: by..., group (clean, unmapped), what (position, length, gc), at, reads, a c g t n, mean_quality.
    """
    from sitecall.operators.basecount import PROFILE_COUNTS, read_profile

    stage = reject_cascade(aln, opts).where(F.col("stage") != "unmapped").select(*[F.col(k).alias(f"_{k}") for k in READ_KEYS], F.lit(False).alias("_un"))
    same = F.lit(True)
    for k in READ_KEYS:
        same = same & (F.col(k) == F.col(f"_{k}"))
    parted = clean.join(stage, same, "left").withColumn("unmapped", F.coalesce("_un", F.lit(True)))
    p = read_profile(parted, [*by, "unmapped"])
    group = F.explode(F.when(F.col("unmapped"), F.array(F.lit("clean"), F.lit("unmapped"))).otherwise(F.array(F.lit("clean"))))
    p = p.select(*by, group.alias("group"), "what", "at", *PROFILE_COUNTS, "q_sum")
    g = p.groupBy(*by, "group", "what", "at").agg(*[F.sum(c).alias(c) for c in PROFILE_COUNTS], F.sum("q_sum").alias("q_sum"))
    bases = [c for c in PROFILE_COUNTS if c not in ("reads", "q_n")]
    return g.select(*by, "group", "what", "at", "reads", *bases, F.try_divide(F.col("q_sum"), F.col("q_n").cast("double")).alias("mean_quality"))
