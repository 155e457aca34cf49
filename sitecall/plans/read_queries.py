"""Registered read/alignment-layer queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall import fixtures as fx
from sitecall.operators import reads as rd
from sitecall.operators import report
from sitecall.options import Options
from sitecall.plans.registry import register

OPTS = Options()
ALN_OUT = ["sample", "run", "read_id", "reftype", "chrom", "pos", "strand", "flag"]


def _aln(spark, sf) -> DataFrame:
    return fx.load(spark, sf, "alignments")


def W(body: str, extra=None, fixtures=("alignments",)) -> str:
    return fx.with_fixtures(list(fixtures), body, extra)


# SQL forms of the accept rules ------------------------------------------------
PE_SQL = "((flag & 2) <> 0 and (flag & 4) = 0 and (flag & 8) = 0 and qlen - sclen >= 30 and xm * 15 < qlen - sclen)"
SE_SQL = "((flag & 4) = 0 and qlen - sclen >= 30 and xm * 15 < qlen - sclen)"
REMAP_SQL = "((ns + nc * 0.2) / qlen <= 0.08 and (flag & 256) = 0)"
MAIN_SQL = "((flag & 4) = 0 and (qlen - sclen) / qlen >= 0.8 and ns <= 6 and nc / (qlen - sclen) <= 0.33)"
PREMAP_SQL = f"(case when (flag & 1) <> 0 then {PE_SQL} else {SE_SQL} end)"
STAGE_SQL = (
    f"(case when reftype = 'contamination' then {PREMAP_SQL} when reftype in ('genes', 'transcript') then {MAIN_SQL} "
    f"when reftype = 'genome' then {REMAP_SQL} end)"
)
ACC = ("acc", f"select *, coalesce({STAGE_SQL}, false) as ok from alignments")


def _acc(spark, sf) -> DataFrame:
    return rd.accept_reject_split(_aln(spark, sf), rd.stage_accept(OPTS))


for _name, _sid, _col, _sql in (
    ("premap_accept_pe", "P3", rd.premap_accept_pe, PE_SQL),
    ("premap_accept_se", "P4", rd.premap_accept_se, SE_SQL),
    ("remap_accept", "P5", rd.remap_accept, REMAP_SQL),
    ("mainmap_accept", "P6", rd.mainmap_accept, MAIN_SQL),
):
    register(
        _name, _sid,
        W(f"select sample, run, read_id, reftype, chrom, pos, strand, flag, coalesce({_sql}, false) as ok from alignments"),
    )(lambda spark, sf, _c=_col: _aln(spark, sf).select(*ALN_OUT, F.coalesce(_c(OPTS), F.lit(False)).alias("ok")))


@register(
    "accept_reject_split", "P7",
    W("select sample, run, read_id, reftype, chrom, pos, strand, flag, case when ok then 'passed' else 'rejected' end as route from acc", [ACC]),
)
def accept_reject_split(spark, sf):
    """One stage predicate, two outputs (passed / complement incl. null predicates)."""
    s = _acc(spark, sf)
    passed = s.where("ok").select(*ALN_OUT, F.lit("passed").alias("route"))
    rejected = s.where("not ok").select(*ALN_OUT, F.lit("rejected").alias("route"))
    return passed.unionByName(rejected)


register(
    "accept_counts", "P8",
    W("select sample, run, reftype, cast(count_if(ok) as bigint) as passed, cast(count_if(not ok) as bigint) as rejected from acc group by all", [ACC]),
)(lambda spark, sf: rd.accept_counts(_acc(spark, sf)))

register(
    "primary_reads", "P9",
    W("select sample, run, read_id, reftype, chrom, pos, strand, flag from alignments where (flag & 2304) = 0"),
)(lambda spark, sf: rd.primary_reads(_aln(spark, sf)).select(*ALN_OUT))


@register(
    "split_mates", "P10",
    W(
        "select sample, run, read_id, mate, reftype, chrom, pos, flag from lab where read_id is not null "
        "and (sample, run, read_id) in (select sample, run, read_id from lab group by all having bool_or(mate = 'R1') and bool_or(mate = 'R2'))",
        [ACC, ("lab", "select * from (select *, case when (flag & 64) <> 0 and (flag & 128) = 0 then 'R1' "
                      "when (flag & 128) <> 0 and (flag & 64) = 0 then 'R2' end as mate from acc where not ok and (flag & 2304) = 0) "
                      "where mate is not null")],
    ),
)
def split_mates(spark, sf):
    """P10: rejected primary records of complete pairs to R1/R2."""
    rej = _acc(spark, sf).where("not ok")
    return rd.split_mates(rej).select("sample", "run", "read_id", "mate", "reftype", "chrom", "pos", "flag")


# P11 / P12 / A22 / A20 on raw reads ----------------------------------------------
UMI_LEN = 4


def _clip_sql(adapter: str = fx.ADAPTER, umi: int = UMI_LEN, min_overlap: int = 3) -> str:
    partial = " ".join(
        f"when suffix(seq, '{adapter[:k]}') then length(seq) - {k} + 1" for k in range(len(adapter) - 1, min_overlap - 1, -1)
    )
    cut = f"(case when strpos(seq, '{adapter}') > 0 then strpos(seq, '{adapter}') else coalesce(case {partial} end, length(seq) + 1) end)"
    return (
        f"select sample, run, mate, read_id, substr(seq, 1, {umi}) as umi, "
        f"substr(seq, {umi + 1}, greatest({cut} - 1 - {umi}, 0)) as seq, substr(qual, {umi + 1}, greatest({cut} - 1 - {umi}, 0)) as qual from reads"
    )


CLIP = ("clipped", _clip_sql())


def _clipped(spark, sf) -> DataFrame:
    return rd.adapter_clip(fx.load(spark, sf, "reads"), fx.ADAPTER, umi_len=UMI_LEN)


register("adapter_clip", "P12", W("select * from clipped", [CLIP], ("reads",)))(
    lambda spark, sf: _clipped(spark, sf).select("sample", "run", "mate", "read_id", "umi", "seq", "qual")
)
register(
    "length_route", "P11",
    W("select sample, run, mate, read_id, length(seq) as len, case when length(seq) < 20 then 'too_short' else 'clean' end as route from clipped", [CLIP], ("reads",)),
)(lambda spark, sf: rd.length_route(_clipped(spark, sf), OPTS.min_read_len).select(
    "sample", "run", "mate", "read_id", F.length("seq").cast("bigint").alias("len"), "route"))


@register(
    "read_qc", "A22",
    W(
        "select sample, mate, cast(i as bigint) as position, count(*) as reads, "
        + ", ".join(f"cast(count_if(upper(substr(seq, i, 1)) = '{b}') as bigint) as {b.lower()}" for b in "ACGTN")
        + ", round(avg(ascii(substr(qual, i, 1)) - 33), 6) as mean_quality "
        "from (select *, unnest(generate_series(1, length(seq))) as i from clipped where length(seq) >= 20) group by all",
        [CLIP], ("reads",),
    ),
)
def read_qc(spark, sf):
    """Per-position base composition and mean quality of clean clipped reads."""
    clean = rd.length_route(_clipped(spark, sf), OPTS.min_read_len).where(F.col("route") == "clean")
    return rd.read_qc(clean).withColumn("mean_quality", F.round("mean_quality", 6))


_QC_PARTS = [
    CLIP,
    ("acc", f"select *, coalesce({STAGE_SQL}, false) as ok from read_alignments"),
    ("grouped", "select *, 'clean' as \"group\" from clipped where length(seq) >= 20 union all select *, 'unmapped' from clipped c where length(seq) >= 20 "
                "and not exists (select 1 from acc where ok and acc.sample = c.sample and acc.run = c.run and acc.read_id = c.read_id)"),
]


def _routed_qc(spark, sf, what: str) -> DataFrame:
    clean = rd.length_route(_clipped(spark, sf), OPTS.min_read_len).where(F.col("route") == "clean")
    return rd.routed_qc(clean, fx.load(spark, sf, "read_alignments"), OPTS).where(F.col("what") == what)


@register(
    "read_qc_groups", "A22",
    W(
        'select sample, mate, "group", cast(i as bigint) as position, count(*) as reads, '
        + ", ".join(f"cast(count_if(upper(substr(seq, i, 1)) = '{b}') as bigint) as {b.lower()}" for b in "ACGTN")
        + ", round(avg(ascii(substr(qual, i, 1)) - 33), 6) as mean_quality from (select *, unnest(generate_series(1, length(seq))) as i from grouped) group by all",
        _QC_PARTS, ("reads", "read_alignments"),
    ),
)
def read_qc_groups(spark, sf):
    """Per-position composition and quality of the clean reads and of those that end unmapped."""
    t = _routed_qc(spark, sf, "position")
    return t.select("sample", "mate", "group", F.col("at").alias("position"), "reads", *"acgtn", F.round("mean_quality", 6).alias("mean_quality"))


@register(
    "read_gc", "A22",
    W('select sample, mate, "group", cast(floor(100 * length(regexp_replace(upper(seq), \'[^GC]\', \'\', \'g\')) / length(seq)) as bigint) as gc_pct, count(*) as count from grouped group by all',
      _QC_PARTS, ("reads", "read_alignments")),
)
def read_gc(spark, sf):
    """GC percents of the clean and of the unmapped reads."""
    return _routed_qc(spark, sf, "gc").select("sample", "mate", "group", F.col("at").alias("gc_pct"), F.col("reads").alias("count"))


@register(
    "read_length_groups", "A22",
    W('select sample, mate, "group", cast(length(seq) as bigint) as length, count(*) as count from grouped group by all', _QC_PARTS, ("reads", "read_alignments")),
)
def read_length_groups(spark, sf):
    """Lengths of the clean and of the unmapped reads."""
    return _routed_qc(spark, sf, "length").select("sample", "mate", "group", F.col("at").alias("length"), F.col("reads").alias("count"))


# J8 / J9 / J10 ----------------------------------------------------------------------
_MATE_SQL = """
select p.sample, p.run, p.read_id, p.reftype, p.chrom, p.pos, p.strand, p.flag,
 case when (p.flag & 1) <> 0 and (p.flag & 64) <> 0 then m2.c when (p.flag & 1) <> 0 and (p.flag & 128) <> 0 then m1.c end as mate_chrom,
 case when (p.flag & 1) <> 0 and (p.flag & 64) <> 0 then m2.p when (p.flag & 1) <> 0 and (p.flag & 128) <> 0 then m1.p end as mate_pos,
 case when (p.flag & 1) <> 0 and (p.flag & 64) <> 0 then m2.s when (p.flag & 1) <> 0 and (p.flag & 128) <> 0 then m1.s end as mate_strand
from prim p
left join (select sample, run, read_id, first(chrom order by chrom, pos, strand) as c, first(pos order by chrom, pos, strand) as p,
   first(strand order by chrom, pos, strand) as s from prim where (flag & 64) <> 0 group by all) m1 using (sample, run, read_id)
left join (select sample, run, read_id, first(chrom order by chrom, pos, strand) as c, first(pos order by chrom, pos, strand) as p,
   first(strand order by chrom, pos, strand) as s from prim where (flag & 128) <> 0 group by all) m2 using (sample, run, read_id)
"""


@register("mate_join", "J8", W(_MATE_SQL, [("prim", "select * from alignments where (flag & 2304) = 0")]))
def mate_join(spark, sf):
    """Mate coordinates on each primary paired record; single-end records pass with nulls."""
    return rd.mate_join(_aln(spark, sf)).select(*ALN_OUT, "mate_chrom", "mate_pos", "mate_strand")


_CASCADE_SQL = """
select sample, run, read_id, 'contamination' as stage from r0 semi join c using (sample, run, read_id)
union all select sample, run, read_id, 'main' from (select * from r0 anti join c using (sample, run, read_id)) r1 semi join m using (sample, run, read_id)
union all select sample, run, read_id, 'genome' from (select * from (select * from r0 anti join c using (sample, run, read_id)) x anti join m using (sample, run, read_id)) r2 semi join g using (sample, run, read_id)
union all select sample, run, read_id, 'unmapped' from (select * from (select * from r0 anti join c using (sample, run, read_id)) x anti join m using (sample, run, read_id)) r3 anti join g using (sample, run, read_id)
"""


@register(
    "reject_cascade", "J9",
    W(_CASCADE_SQL, [
        ACC,
        ("r0", "select sample, run, read_id from alignments union select sample, run, read_id from reads"),
        ("c", "select distinct sample, run, read_id from acc where reftype = 'contamination' and ok"),
        ("m", "select distinct sample, run, read_id from acc where reftype in ('genes', 'transcript') and ok"),
        ("g", "select distinct sample, run, read_id from acc where reftype = 'genome' and ok"),
    ], ("alignments", "reads")),
)
def reject_cascade(spark, sf):
    """Final stage per read: contamination -> genes/transcript -> genome -> unmapped (also without an alignment record)."""
    return rd.reject_cascade(_aln(spark, sf), OPTS, reads=fx.load(spark, sf, "reads"))


_COMP_COLS = ["reftype", "chrom", "pos", "strand", "flag", "qlen", "sclen", "xm", "ns", "nc", "umi", "isize", "mapq"]


@register(
    "competitive_assign", "J10",
    W(
        "select sample, run, read_id, " + ", ".join(_COMP_COLS) + " from (select *, row_number() over (partition by sample, run, read_id "
        "order by qlen - sclen - ns desc, case when reftype = 'genes' then 0 else 1 end, chrom, pos, reftype, strand, flag, qlen, sclen, "
        "xm nulls first, ns, nc, umi, isize, mapq) as rn from alignments where reftype in ('genes', 'transcript') and coalesce("
        + MAIN_SQL + ", false)) where rn = 1"
    ),
)
def competitive_assign(spark, sf):
    """One main-stage alignment per read: best score, genes before transcript, lowest position."""
    return rd.competitive_assign(_aln(spark, sf), OPTS).select(*rd.READ_KEYS, *_COMP_COLS)


# W2 / A23 / A17 / A18 / A19 ----------------------------------------------------------
_DEDUP_P = (
    "dp", "select *, case when strand = '-' then pos + qlen - sclen - 1 else pos end as five_prime from alignments "
          "where (flag & 2304) = 0 and (flag & 4) = 0",
)
# a fragment's ends as text, by lowest (chrom, strand, position) of each mate; single reads are first mates
_END = "first(chrom || ' ' || strand || ' ' || five_prime order by chrom, strand, five_prime) filter ({0})"
_SECOND = "(flag & 129) = 129"
_FRAGMENTS = (
    "fragments",
    f"select sample, reftype, run, read_id, coalesce({_END.format('not ' + _SECOND)}, '') as end1, coalesce({_END.format(_SECOND)}, '') as end2, "
    "min(umi) as umi, sum(mapq) as mapq, count(*) as records from dp group by all",
)
_RANKED = (
    "ranked",
    "select *, row_number() over (partition by sample, reftype, end1, end2, umi order by mapq desc, read_id, run) as rn from fragments",
)
_KEPT = ("kept", "select dp.* from dp join ranked r using (sample, reftype, run, read_id) where rn = 1")
_DEDUP = [_DEDUP_P, _FRAGMENTS, _RANKED, _KEPT]
_REPORT_SQL = (
    "select sample, reftype, cast(sum(records) as bigint) as total_reads, cast(sum(case when rn > 1 then records else 0 end) as bigint) as duplicates, "
    "cast(sum(case when rn = 1 then records else 0 end) as bigint) as unique_reads from ranked group by all"
)


@register(
    "dedup_alignments", "W2",
    W("select sample, reftype, chrom, strand, five_prime, umi, run, read_id, pos, flag, mapq from kept", _DEDUP),
)
def dedup_alignments(spark, sf):
    """One fragment, with both mates, per duplicate set (best summed mapq, then read id)."""
    kept, _ = rd.dedup_alignments(_aln(spark, sf))
    return kept.select("sample", "reftype", "chrom", "strand", "five_prime", "umi", "run", "read_id", "pos", "flag", "mapq")


_GAPPED_DEDUP = [
    ("recs", "select row_number() over () as rid, *, case when (flag & 16) <> 0 then '-' else '+' end as strand from sam_records where (flag & 2308) = 0"),
    # 5' end by the CIGAR's first and last operations
    ("dp", "select *, case when strand = '+' then pos - case cigar when '3S45M' then 3 when '5S18M1I12M2D12M' then 5 when '2H40M6S' then 2 else 0 end "
           "else pos - 1 + case cigar when '3S45M' then 45 when '20M2I26M' then 46 when '24M3D24M' then 51 when '5S18M1I12M2D12M' then 44 when '2H40M6S' then 46 "
           "when '16M500N32M' then 548 else 48 end end as five_prime from recs"),
    _FRAGMENTS, _RANKED, _KEPT,
]


@register(
    "dedup_alignments_gapped", "W2",
    W("select sample, reftype, chrom, strand, cast(five_prime as bigint) as five_prime, umi, run, read_id, cast(pos as bigint) as pos, flag, mapq, cigar from kept", _GAPPED_DEDUP, ("sam_records",)),
)
def dedup_alignments_gapped(spark, sf):
    """W2 on gapped records: 5' ends from the CIGAR, clipped bases counted."""
    a = fx.load(spark, sf, "sam_records").withColumn("strand", F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+"))
    kept, _ = rd.dedup_alignments(a)
    return kept.select("sample", "reftype", "chrom", "strand", "five_prime", "umi", "run", "read_id", "pos", "flag", "mapq", "cigar")


@register(
    "dedup_report", "A23",
    W(f"select *, round(duplicates * 100.0 / total_reads, 6) as duplication_rate from ({_REPORT_SQL})", _DEDUP),
)
def dedup_report(spark, sf):
    """Total, duplicates, unique, duplication % per (sample, reference type)."""
    _, sets = rd.dedup_alignments(_aln(spark, sf))
    r = rd.dedup_report(sets)
    return r.withColumn("duplication_rate", F.round("duplication_rate", 6))


@register(
    "flag_stats", "A17",
    W(
        "select sample, reftype, count(*) as total, cast(count_if((flag & 2304) = 0) as bigint) as primary, cast(count_if((flag & 256) <> 0) as bigint) as secondary, "
        "cast(count_if((flag & 2048) <> 0) as bigint) as supplementary, cast(count_if((flag & 1024) <> 0) as bigint) as duplicates, cast(count_if((flag & 4) = 0) as bigint) as mapped, "
        "cast(count_if((flag & 1) <> 0) as bigint) as paired, cast(count_if((flag & 1) <> 0 and (flag & 64) <> 0) as bigint) as read1, "
        "cast(count_if((flag & 1) <> 0 and (flag & 128) <> 0) as bigint) as read2, cast(count_if((flag & 1) <> 0 and (flag & 2) <> 0 and (flag & 4) = 0) as bigint) as properly_paired, "
        "cast(count_if((flag & 1) <> 0 and (flag & 4) = 0 and (flag & 8) <> 0) as bigint) as singletons from alignments group by all"
    ),
)
def flag_stats(spark, sf):
    """Record counts per flag class."""
    return rd.flag_stats(_aln(spark, sf))


register(
    "read_count_r1", "A18",
    W("select sample, reftype, cast(count_if((flag & 384) = 0) as bigint) as n from alignments group by all"),
)(lambda spark, sf: rd.read_count_r1(_aln(spark, sf)))

def _deduplicated(spark, sf) -> DataFrame:
    return rd.dedup_alignments(_aln(spark, sf))[0]


register(
    "insert_size_hist", "A19",
    W("select sample, reftype, least(abs(isize), 1001) as isize, count(*) as pairs from kept where (flag & 1) <> 0 and (flag & 2) <> 0 and (flag & 64) <> 0 group by all", _DEDUP),
)(lambda spark, sf: rd.insert_size_hist(_deduplicated(spark, sf)))

register(
    "read_length_hist", "A20",
    W("select sample, reftype, qlen as length, count(*) as count from kept group by all", _DEDUP),
)(lambda spark, sf: rd.read_length_hist(_deduplicated(spark, sf), F.col("qlen")))


# A21 / F14 / J7 / F15 / F17 --------------------------------------------------------
_TRIM_NUM = (
    "tn",
    "select sample, run, cast(nullif(regexp_extract(report, '\"input\": ([0-9]+),', 1), '') as bigint) as input, "
    "cast(nullif(regexp_extract(report, '\"output\": ([0-9]+),', 1), '') as bigint) as output from trim_reports",
)


def _trim_numbers(spark, sf) -> DataFrame:
    t = fx.load(spark, sf, "trim_reports")
    return t.select("sample", "run", report.json_first_number("report", "input").alias("input"),
                    report.json_first_number("report", "output").alias("output"))


register("json_first_number", "F17", W("select * from tn", [_TRIM_NUM], ("trim_reports",)))(_trim_numbers)


def stage_counts_long(spark, sf) -> DataFrame:
    aln = _acc(spark, sf).where("ok").drop("ok")  # the combined files hold accepted records only
    passed = rd.read_count_r1(aln)
    kept, _ = rd.dedup_alignments(aln)
    dedup = rd.read_count_r1(kept)
    return rd.stage_counts(_trim_numbers(spark, sf), passed, dedup)


_STAGE_SQL = [
    _TRIM_NUM, ACC, ("okd", "select * exclude (ok) from acc where ok"), (_DEDUP_P[0], _DEDUP_P[1].replace("from alignments", "from okd")), _FRAGMENTS, _RANKED, _KEPT,
    ("stage", """
select sample, 'Raw' as key, cast(sum(input) as bigint) as value from tn group by sample
union all select sample, 'Clean', cast(sum(output) as bigint) from tn group by sample
union all select sample, case reftype when 'contamination' then 'Contamination' when 'genes' then 'Masking' when 'transcript' then 'Transcript'
  else 'Genome' end || '_Passed', cast(count_if((flag & 384) = 0) as bigint) from okd group by sample, reftype
union all select sample, case reftype when 'contamination' then 'Contamination' when 'genes' then 'Masking' when 'transcript' then 'Transcript'
  else 'Genome' end || '_Dedup', cast(count_if((flag & 384) = 0) as bigint) from kept group by sample, reftype
"""),
]
register("stage_counts", "A21", W("select * from stage", _STAGE_SQL, ("alignments", "trim_reports")))(stage_counts_long)

_K = report.STAGE_KEYS
_WIDE_STAGE = ("sw", "select sample, " + ", ".join(f"max(case when key = '{k}' then value end) as {k}" for k in _K) + " from stage group by sample")
_HIER = (
    "hier",
    "select sample, coalesce(Transcript_Dedup, 0) + coalesce(Genome_Dedup, 0) as unique_mapped, "
    "greatest(0, coalesce(Transcript_Passed, 0) + coalesce(Genome_Passed, 0) - coalesce(Transcript_Dedup, 0) - coalesce(Genome_Dedup, 0)) as duplicates, "
    "coalesce(Masking_Passed, 0) as masking, coalesce(Contamination_Passed, 0) as contamination, "
    "greatest(0, coalesce(Clean, 0) - (coalesce(Contamination_Passed, 0) + coalesce(Masking_Passed, 0) + coalesce(Transcript_Passed, 0) + coalesce(Genome_Passed, 0))) as unmapped, "
    "greatest(0, coalesce(Raw, 0) - coalesce(Clean, 0)) as discarded_short from sw",
)


def hierarchy(spark, sf) -> DataFrame:
    return report.read_hierarchy(report.stage_counts_wide(stage_counts_long(spark, sf)))


register("read_hierarchy", "F14", W("select * from hier", [*_STAGE_SQL, _WIDE_STAGE, _HIER], ("alignments", "trim_reports")))(hierarchy)

_TRIM_PCT_SQL = (
    "tp",
    "select sample, sum(pct * n) / sum(n) as trimmed_pct from (select sample, "
    "cast(nullif(regexp_extract(report, '\"input\": ([0-9]+),', 1), '') as bigint) as n, "
    "case when coalesce(cast(json_extract(report, '$.filtering_statistics.percent_trimmed') as double), 0) = 0 "
    "then coalesce(cast(json_extract(report, '$.report.summary.terminal_stats.percent_trimmed') as double), 0) "
    "else cast(json_extract(report, '$.filtering_statistics.percent_trimmed') as double) end as pct from trim_reports) group by sample",
)


@register(
    "trim_report_join", "J7",
    W("select h.*, round(tp.trimmed_pct, 6) as trimmed_pct from hier h left join tp using (sample)", [*_STAGE_SQL, _WIDE_STAGE, _HIER, _TRIM_PCT_SQL], ("alignments", "trim_reports")),
)
def trim_report_join(spark, sf):
    """Read hierarchy rows with the trimmed percentage over all runs, weighted by their reads (left join on sample)."""
    from sitecall.operators.joins import join_small

    t = report.trimmed_pct_of_samples(fx.load(spark, sf, "trim_reports"))
    return join_small(hierarchy(spark, sf), t, "sample", "left").withColumn("trimmed_pct", F.round("trimmed_pct", 6))


@register(
    "sample_type_label", "F15",
    W(f"select sample || '_' || reftype as sample_library, total_reads, unique_reads from ({_REPORT_SQL})", _DEDUP),
)
def sample_type_label(spark, sf):
    """``{sample}_{type}`` labels on the dedup table."""
    _, sets = rd.dedup_alignments(_aln(spark, sf))
    r = rd.dedup_report(sets)
    return r.select(report.sample_type_label("sample", "reftype").alias("sample_library"), "total_reads", "unique_reads")


# O2 / O5 -------------------------------------------------------------------------
@register(
    "sort_alignments", "O2",
    W("select sample, reftype, chrom, pos, strand, read_id, flag from alignments order by sample, reftype, chrom, pos, read_id"),
)
def sort_alignments(spark, sf):
    """O2: coordinate sort (range partitioning, then per-partition sort)."""
    return _aln(spark, sf).select("sample", "reftype", "chrom", "pos", "strand", "read_id", "flag").orderBy("sample", "reftype", "chrom", "pos", "read_id")


@register(
    "union_runs", "O5",
    W("select sample, reftype, chrom, pos, read_id, run from alignments"),
)
def union_runs(spark, sf):
    """All runs of a sample stacked, coordinate-ordered per (sample, reference type)."""
    a = _aln(spark, sf).select("sample", "reftype", "chrom", "pos", "read_id", "run")
    # global range-partitioned sort: read_id lets a hot sample or position spread over many range partitions
    return a.orderBy("sample", "reftype", "chrom", "pos", "read_id")


# A1 / A15 / A16 / F11 / F12 / J11 / O6 -------------------------------------------
from sitecall.operators import liftover as lo  # noqa: E402
from sitecall.operators import pileup as pu  # noqa: E402
from sitecall.plans import sqltext as q  # noqa: E402

_RATE_SQL = "cast(case when regexp_full_match(string_split({c}, '_')[-1], '[0-9]+') then string_split({c}, '_')[-1] else '0' end as bigint)"
_SPIKE_SQL = (
    "counts",
    "select sample, rate, i = 18 as is_signal, upper(substr(ref_seq, i, 1)) as ref_base, substr(seq, i, 1) as read_base, count(*) as n "
    f"from (select sample, {_RATE_SQL.format(c='reference')} as rate, ref_seq, seq, "
    "unnest(generate_series(1, least(length(seq), length(ref_seq)))) as i from probe_reads "
    "where starts_with(reference, 'probe_') and yf + zf >= 5) group by all",
)


def _probe(spark, sf) -> DataFrame:
    return fx.load(spark, sf, "probe_reads")


register("spike_counts_ungapped", "A15", W("select * from counts", [_SPIKE_SQL], ("probe_reads",)))(
    lambda spark, sf: pu.spike_counts(_probe(spark, sf))
)


def _pct_sql(num: str, den: str) -> str:
    return f"case when {den} > 0 then printf('%.3f%%', cast({num} as double) * 100.0 / cast({den} as double)) end"


@register(
    "spike_ratio", "A16",
    W(
        "select sample, rate, coalesce(" + _pct_sql("s_aa", "s_aa + s_ag") + ", 'NA') as m6a_pct, "
        + _pct_sql("b_ag", "b_aa + b_ag") + " as a_convert_pct, " + _pct_sql("b_ct", "b_cc + b_ct") + " as c_convert_pct from ("
        "select sample, rate, "
        "sum(case when is_signal and ref_base = 'A' and read_base = 'A' then n else 0 end) as s_aa, "
        "sum(case when is_signal and ref_base = 'A' and read_base = 'G' then n else 0 end) as s_ag, "
        "sum(case when not is_signal and ref_base = 'A' and read_base = 'A' then n else 0 end) as b_aa, "
        "sum(case when not is_signal and ref_base = 'A' and read_base = 'G' then n else 0 end) as b_ag, "
        "sum(case when not is_signal and ref_base = 'C' and read_base = 'C' then n else 0 end) as b_cc, "
        "sum(case when not is_signal and ref_base = 'C' and read_base = 'T' then n else 0 end) as b_ct, "
        "bool_or(not is_signal) as has_bg from counts group by all) where has_bg",
        [_SPIKE_SQL], ("probe_reads",),
    ),
)
def spike_ratio(spark, sf):
    """m6A % at the signal base, A->G and C->T conversion % elsewhere, per sample and rate."""
    return pu.spike_ratio(pu.spike_counts(_probe(spark, sf)))


@register(
    "probe_rate", "F11",
    W(
        f"select distinct name, {_RATE_SQL.format(c='name')} as rate from "
        "(select reference as name from probe_reads union all select chrom from alignments union all select read_id from alignments)",
        None, ("probe_reads", "alignments"),
    ),
)
def probe_rate(spark, sf):
    """spike-in rate from the reference name's last ``_`` token (0 unless all digits)."""
    aln = fx.derive(spark, sf, "alignments")  # two of its sixteen columns: not written first
    names = _probe(spark, sf).select(F.col("reference").alias("name")).unionByName(
        aln.select(F.col("chrom").alias("name"))).unionByName(aln.select(F.col("read_id").alias("name")))
    return names.distinct().select("name", pu.probe_rate("name").alias("rate"))


register(
    "read_min_support", "F12",
    W("select sample, reference, read_id, yf, zf from probe_reads where yf + zf >= 5", None, ("probe_reads",)),
)(lambda spark, sf: pu.read_min_support(_probe(spark, sf)).select("sample", "reference", "read_id", "yf", "zf"))

_PILEUP_SQL = """
select sample, reference as chrom, cast(pos as bigint) as pos, '+' as strand,
 substr(concat(repeat('N', 15), first(ref_seq), repeat('N', 15)), pos, 31) as motif,
 cast(count_if(tier = 0 and upper(substr(seq, pos, 1)) = 'A') as bigint) as u0, cast(count_if(tier = 1 and upper(substr(seq, pos, 1)) = 'A') as bigint) as u1,
 cast(count_if(tier = 2 and upper(substr(seq, pos, 1)) = 'A') as bigint) as u2, cast(count_if(tier = 0 and upper(substr(seq, pos, 1)) = 'G') as bigint) as m0,
 cast(count_if(tier = 1 and upper(substr(seq, pos, 1)) = 'G') as bigint) as m1, cast(count_if(tier = 2 and upper(substr(seq, pos, 1)) = 'G') as bigint) as m2
from (select *, unnest(list_filter(generate_series(1, least(length(seq), length(ref_seq))), lambda i: upper(substr(ref_seq, i, 1)) = 'A')) as pos,
   case when yf + zf < 5 then 0 when zf <= 2 then 1 else 2 end as tier from probe_reads)
group by sample, reference, pos
"""


@register("pileup_counts_ungapped", "A1", W(_PILEUP_SQL, None, ("probe_reads",)))
def pileup_counts_ungapped(spark, sf):
    """A1 where read base i lies on reference base i: six-count pileup (tiers 0/1/2, unconverted A / converted G)."""
    return pu.pileup_counts(_probe(spark, sf))


_TXL_SQL = """
select sample, read_id, gene, chrom, strand, cast(min(bs) + 1 as bigint) as pos,
 string_agg(cast(bs + 1 as varchar) || '-' || cast(be as varchar), ',' order by bs, be) as blocks,
 cast(count(*) as bigint) as n_blocks, cast(sum(be - bs) as bigint) as aligned
from (select a.aid, a.sample, a.read_id, a.gene, e.ex_chrom as chrom, e.ex_strand as strand,
  case when e.ex_strand = '+' then e.g_start + (greatest(a.s, e.tx_start) - e.tx_start) else e.g_end - (least(a.e, e.tx_end) - e.tx_start) end as bs,
  case when e.ex_strand = '+' then e.g_start + (least(a.e, e.tx_end) - e.tx_start) else e.g_end - (greatest(a.s, e.tx_start) - e.tx_start) end as be
 from (select row_number() over () as aid, sample, read_id, gene, tx_pos - 1 as s, tx_pos - 1 + aln_len as e from tx_alignments) a
 join exons e on a.gene = e.gene_name and a.s < e.tx_end and a.e > e.tx_start)
group by aid, sample, read_id, gene, chrom, strand
"""


def _tx_lifted(spark, sf) -> DataFrame:
    ex = lo.exon_offsets(fx.load(spark, sf, "transcripts"))
    return pu.alignment_liftover(fx.load(spark, sf, "tx_alignments"), ex)


register(
    "alignment_liftover_blocks", "J11",
    W("select * from txl", [("exons", q.exons_cte("transcripts")), ("txl", _TXL_SQL)], ("transcripts", "tx_alignments")),
)(_tx_lifted)


@register(
    "union_lifted_blocks", "O6",
    W(
        "select * from txl union all select sample, read_id, null, chrom, strand, cast(pos as bigint), "
        "cast(pos as varchar) || '-' || cast(pos + qlen - sclen - 1 as varchar), 1, cast(qlen - sclen as bigint) from alignments "
        "where reftype = 'genome' order by sample, chrom, pos",
        [("exons", q.exons_cte("transcripts")), ("txl", _TXL_SQL)], ("transcripts", "tx_alignments", "alignments"),
    ),
)
def union_lifted_blocks(spark, sf):
    """O6 on genome blocks alone: lifted transcript alignments plus genome alignments, coordinate-sorted."""
    g = pu.genome_alignment_blocks(_aln(spark, sf).where(F.col("reftype") == "genome"))
    return pu.union_lifted(_tx_lifted(spark, sf), g)
