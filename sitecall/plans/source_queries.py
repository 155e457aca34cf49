"""Registered source and sink queries (S1-S14, K1-K6): files laid out from the
table-derived fixtures, read back through the library's readers; sinks write
and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecall import fixture_files as ff
from sitecall import fixtures as fx
from sitecall.functions.cigar import MATCH_OPS
from sitecall.operators import background as bg
from sitecall.operators import calling, groups, report
from sitecall.operators import reads as rd
from sitecall.operators import sites as st
from sitecall.plans import read_queries as rq
from sitecall.plans import report_queries as repq
from sitecall.plans import site_queries as sq
from sitecall.plans import sqltext as q
from sitecall.plans.registry import register
from sitecall.session import unique_scratch
from sitecall.sources import files as src
from sitecall.sources import sequences
from sitecall.sources import sinks

# S1 / S2 / S3 -----------------------------------------------------------------------
register("scan_pileup", "S1", fx.with_fixtures(["pileup_tiers"], f"select * from ({sq._P1_SQL}) where depth > 0"))(
    lambda spark, sf: src.scan_pileup(spark, ff.pileup_header_files(spark, sf))
)
register(
    "scan_pileup_legacy", "S2",
    fx.with_fixtures(["site_counts"], "select sample, Chrom as chrom, Pos as pos, Strand as strand, Motif as motif, U1 as uncon, D1 as depth from lg where D1 > 0",
                     [("lg", ff.LEGACY_SQL)]),
)(lambda spark, sf: src.scan_pileup_legacy(spark, ff.pileup_legacy_files(spark, sf)))
register(
    "scan_pileup_auto", "S3",
    fx.with_fixtures(
        ["pileup_tiers", "site_counts"],
        f"select * from ({sq._P1_SQL}) where depth > 0 and sample in ('s0', 's2') union all "
        "select sample, Chrom, Pos, Strand, Motif, U1, D1 from lg where D1 > 0 and sample in ('s1', 's3')",
        [("lg", ff.LEGACY_SQL)],
    ),
)(lambda spark, sf: src.scan_pileup_auto(spark, ff.pileup_mixed_files(spark, sf)))


# S4 / S5 / S6 / S7 ------------------------------------------------------------------
@register(
    "scan_sites_wide", "S4",
    fx.with_fixtures(
        ["site_counts"],
        "select s.chrom as Chrom, s.pos as Pos, s.strand as Strand, smp.sample, cast(coalesce(c.uncon, 0) as bigint) as uncon, "
        "cast(coalesce(c.depth, 0) as bigint) as depth from (select distinct chrom, pos, strand from site_counts) s "
        "cross join (values ('s0'), ('s1'), ('s2'), ('s3')) smp(sample) left join site_counts c "
        "on c.chrom = s.chrom and c.pos = s.pos and c.strand = s.strand and c.sample = smp.sample",
    ),
)
def scan_sites_wide(spark, sf):
    """Wide sites TSV.gz read with type overrides, then unpivoted to the long table."""
    w = src.scan_sites_wide(spark, ff.sites_wide_files(spark, sf))
    return st.to_long(w, ["Chrom", "Pos", "Strand"])


register("scan_transcripts", "S5", fx.with_fixtures(["transcripts"], "select gene_id, chrom, strand, spans from transcripts"))(
    lambda spark, sf: src.scan_transcripts(spark, ff.transcripts_files(spark, sf))
)
register(
    "fasta_union", "S6",
    "select concat('G', cast(p_partkey as varchar)) as name, p_name as description, "
    + fx.seq_expr("p_partkey", "p_size", ff.FASTA_LEN) + " as seq from part",
)(lambda spark, sf: src.fasta_union(spark, ff.fasta_files(spark, sf)))
register(
    "transcript_table", "S7",
    fx.with_fixtures(["transcripts"], "select gene_id, gene_id || '.1' as transcript_id, chrom, strand, spans from transcripts"),
)(lambda spark, sf: src.transcript_table(spark, ff.gtf_files(spark, sf)))


# S8 / S9 -----------------------------------------------------------------------------
@register("scan_reads", "S8", fx.with_fixtures(["reads"], "select sample, run, mate, read_id as name, seq, qual from reads"))
def scan_reads(spark, sf):
    """Gzip FASTQ per (sample, run, mate) -> read records."""
    r = sequences.scan_reads(spark, ff.fastq_files(spark, sf))
    return r.select(*[src.path_partition(c).alias(c) for c in ("sample", "run", "mate")], "name", "seq", "qual")


_SAM_COLS = ("sample", "run", "reftype", "read_id", "flag", "chrom", "pos", "strand", "mapq", "cigar", "mate_chrom", "mate_pos", "isize",
             "seq", "qual", "qlen", "sclen", "xm", "ns", "nc", "yf", "zf", "umi")


@register(
    "scan_alignments", "S9",
    fx.with_fixtures(
        ["sam_records"],
        "select sample, run, reftype, read_id, flag, chrom, cast(pos as bigint) as pos, case when (flag & 16) <> 0 then '-' else '+' end as strand, mapq, cigar, "
        "case when rnext = '=' then chrom when rnext <> '*' then rnext end as mate_chrom, cast(nullif(pnext, 0) as bigint) as mate_pos, isize, nullif(seq, '*') as seq, nullif(qual, '*') as qual, "
        "cast(case when cigar = '*' then coalesce(length(nullif(seq, '*')), 0) when cigar = '2H40M6S' then 46 else 48 end as bigint) as qlen, "
        "cast(case cigar when '3S45M' then 3 when '5S18M1I12M2D12M' then 5 when '2H40M6S' then 6 else 0 end as bigint) as sclen, xm, ns, nc, yf, zf, umi, "
        "case cigar " + " ".join(f"when '{c}' then '{t}'" for c, t in ff.CIGAR_BLOCKS.items()) + " else '' end as blocks from sam_records",
    ),
)
def scan_alignments(spark, sf):
    """SAM text -> alignment table with CIGAR operations, mate fields, bases and typed tags."""
    a = src.scan_alignments(spark, ff.sam_files(spark, sf))
    blocks = F.transform(F.filter("ops", lambda o: o["op"].isin(*MATCH_OPS)), lambda o: F.concat_ws(":", o["op"], o["len"].cast("string"), o["q"].cast("string"), o["r"].cast("string")))
    return a.select(*_SAM_COLS, F.array_join(blocks, ",").alias("blocks"))


# S10 / S11 / S12 / S13 / S14 ------------------------------------------------------------
@register(
    "trim_report_json", "S10",
    fx.with_fixtures(
        ["trim_reports"],
        "select sample, run, case when coalesce(cast(json_extract(report, '$.filtering_statistics.percent_trimmed') as double), 0) = 0 "
        "then coalesce(cast(json_extract(report, '$.report.summary.terminal_stats.percent_trimmed') as double), 0) "
        "else cast(json_extract(report, '$.filtering_statistics.percent_trimmed') as double) end as trimmed_pct, "
        "cast(nullif(regexp_extract(report, '\"input\": ([0-9]+),', 1), '') as bigint) as input, "
        "cast(nullif(regexp_extract(report, '\"output\": ([0-9]+),', 1), '') as bigint) as output from trim_reports",
    ),
)
def trim_report_json(spark, sf):
    """Trimmer JSON per (sample, run): trimmed % (with fallback path), input and output counts."""
    t = src.trim_report_json(spark, ff.trim_json_files(spark, sf))
    return t.select("sample", "run", report.trimmed_pct("report").alias("trimmed_pct"),
                    report.json_first_number("report", "input").alias("input"),
                    report.json_first_number("report", "output").alias("output"))


def _dedup_sql_field(label: str, num: str = "[0-9,]+") -> str:
    return f"max(nullif(replace(regexp_extract(line, '{label}\\s*({num})', 1), ',', ''), ''))"


@register(
    "dedup_log_parse", "S11",
    fx.with_fixtures(
        ["dedup_logs"],
        "select sample, reftype, cast(" + _dedup_sql_field("Total reads processed:") + " as bigint) as total_reads, "
        "cast(" + _dedup_sql_field("Duplicates removed:") + " as bigint) as duplicates, "
        "cast(" + _dedup_sql_field("Total Unique Reads:") + " as bigint) as unique_reads, "
        "cast(max(nullif(regexp_extract(line, 'Deduplication rate:\\s*([0-9.]+)%', 1), '')) as double) as duplication_rate "
        "from (select sample, reftype, unnest(string_split(log, chr(10))) as line from dedup_logs) group by sample, reftype "
        "having total_reads is not null",
    ),
)
def dedup_log_parse(spark, sf):
    """Dedup log metrics per (sample, reference type); logs without totals skipped."""
    return src.dedup_log_parse(spark, ff.dedup_log_files(spark, sf)).select(
        "sample", "reftype", "total_reads", "duplicates", "unique_reads", "duplication_rate")


@register("stage_count_parse", "S12", rq.W("select * from stage", rq._STAGE_SQL, ("alignments", "trim_reports")))
def stage_count_parse(spark, sf):
    """Stage-count files (``key<TAB>value`` per sample) written by the counting step, read back."""
    path = unique_scratch(spark, "stage_counts")
    rq.stage_counts_long(spark, sf).select("sample", "key", F.col("value")).write.partitionBy("sample") \
        .option("sep", "\t").csv(path)
    return src.stage_count_parse(spark, path)


@register(
    "motif_file_scan", "S13",
    fx.with_fixtures(["pileup_tiers", "transcript_counts"], "select sample, reftype, m3 as motif, count, unconverted, depth, round(ratio, 6) as ratio from a2",
                     [("pileups", repq._PILEUPS_SQL), ("a2", repq._A2_SQL)]),
)
def motif_file_scan(spark, sf):
    """Motif tables written per (sample, reference type) by the motif step, read back."""
    path = unique_scratch(spark, "motif_tables")
    t = repq.motif_tables(spark, sf).select("sample", "reftype", F.col("m3").alias("Motif"), F.col("count").alias("Count"),
                                            F.col("unconverted").alias("Unconverted"), F.col("depth").alias("Depth"), F.col("ratio").alias("Ratio"))
    t.write.partitionBy("sample", "reftype").option("sep", "\t").option("header", True).csv(path)
    return src.motif_file_scan(spark, path).withColumn("ratio", F.round("ratio", 6))


@register(
    "sample_sheet", "S14",
    fx.with_fixtures(
        ["alignments"],
        "select sample, run, case when sample = 's0' then 'TAKARAv2' else '' end as libtype, 'AGATCGGAAGAGC' as adapter, "
        "'fastq/' || sample || '_' || run || '_R1.fq.gz' as r1, "
        "case when sample in ('s1', 's3') then 'fastq/' || sample || '_' || run || '_R2.fq.gz' end as r2, sample in ('s1', 's3') as is_pe "
        "from (select distinct sample, run from alignments)",
    ),
)
def sample_sheet(spark, sf):
    """Sample sheet -> one row per sample x run with fallbacks and pairing."""
    runs, _ = src.sample_sheet(spark, ff.sample_sheet_files(spark, sf), libtype="", adapter=fx.ADAPTER)
    return runs


@register(
    "sample_mapping", "S14",
    fx.with_fixtures(
        ["alignments"],
        "select sample, run, case when sample = 's0' then 'TAKARAv2' else '' end as libtype, 'AGATCGGAAGAGC' as adapter, "
        "'fastq/' || sample || '_' || run || '_R1.fq.gz' as r1, "
        "case when sample in ('s1', 's3') then 'fastq/' || sample || '_' || run || '_R2.fq.gz' end as r2, sample in ('s1', 's3') as is_pe "
        "from (select distinct sample, run from alignments)",
    ),
)
def sample_mapping(spark, sf):
    """Configuration with a mapping of samples -> one row per sample x run with fallbacks and pairing."""
    return src.sample_mapping(spark, ff.sample_mapping_files(spark, sf), "b1")[0]


# K1-K6 -------------------------------------------------------------------------------
@register("sink_tsv_gz", "K1", sq._oracle_merged_sites(1))
def sink_tsv_gz(spark, sf):
    """K1: merged sites written as TSV.gz in coordinate order and read back with the wide-sites reader."""
    path = unique_scratch(spark, "sites") + "/sites.tsv.gz"  # the sink compresses by the end of the name
    sinks.sink_tsv(sq.merged_sites_wide(spark, sf, 1), path, order_by=["Chrom", "Pos", "Strand"])
    return src.scan_sites_wide(spark, path)


_K2_SQL = (
    "select sample, chrom, pos, strand, uncon, depth, "
    "regexp_replace(printf('%.8e', stat), 'e\\+?(-?)0*([0-9])', 'e\\1\\2') as stat, "
    "regexp_replace(printf('%.8e', background), 'e\\+?(-?)0*([0-9])', 'e\\1\\2') as background from "
    "(select *, " + q.chi2("uncon", "depth", "background") + " as stat from bgt)"
)


@register("sink_tsv_sci", "K2", fx.with_fixtures(["site_counts"], _K2_SQL, [("prep", sq._PREP_SQL), ("points", sq._POINTS_SQL), ("bgt", sq._BG_SQL)]))
def sink_tsv_sci(spark, sf):
    """K2: scored sites with 8-digit scientific floats, written and read back as text."""
    s = calling.chi2_columns(sq._fallback_bg(spark, sf)).select("sample", "chrom", "pos", "strand", "uncon", "depth", "stat", "background")
    path = unique_scratch(spark, "filtered.tsv")
    sinks.sink_tsv_sci(s, path)
    return spark.read.csv(path, sep="\t", header=True, schema="sample string, chrom string, pos bigint, strand string, uncon bigint, depth bigint, stat string, background string")


@register("sink_parquet_groups", "K3", fx.with_fixtures(["site_counts"], sq._BINOM_SQL, [("grp", sq._GROUP_SQL)]))
def sink_parquet_groups(spark, sf):
    """K3: group test results written as one Parquet directory per group, read back."""
    t = groups.group_test(sq._pooled_groups(spark, sf)).select("group", "chrom", "pos", "strand", "uncon", "depth", F.round("p", 8).alias("p"))
    path = unique_scratch(spark, "grouped")
    sinks.sink_parquet_groups(t, path)
    return spark.read.parquet(path).select("group", "chrom", "pos", "strand", "uncon", "depth", "p")


_K4_HEADER = ["# id: duplicates_by_library", "# section_name: 'Duplicates by library'", "# plot_type: 'table'"]


@register(
    "sink_report_tsv", "K4",
    rq.W(
        "select line from (" + " union all ".join("select '" + h.replace("'", "''") + "' as line" for h in _K4_HEADER)
        + " union all select 'sample_library\ttotal_reads\tunique_reads\tduplicates\tduplication_rate' union all "
        "select sample || '_' || reftype || chr(9) || total_reads || chr(9) || unique_reads || chr(9) || duplicates || chr(9) || printf('%.6f', duplicates * 100.0 / total_reads) "
        f"from ({rq._REPORT_SQL}))",
        rq._DEDUP,
    ),
)
def sink_report_tsv(spark, sf):
    """K4: report file (``#`` metadata lines, header, TSV body), read back line by line."""
    _, sets = rd.dedup_alignments(rq._aln(spark, sf))
    r = rd.dedup_report(sets).select(
        report.sample_type_label("sample", "reftype").alias("sample_library"), "total_reads", "unique_reads", "duplicates", "duplication_rate")
    path = unique_scratch(spark, "dedup_stats_mqc.tsv")
    sinks.sink_report_tsv(r, path, _K4_HEADER, order_by=["sample_library"])
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("sink_model", "K5", fx.with_fixtures(["site_counts"], "select * from points", [("prep", sq._PREP_SQL), ("points", sq._POINTS_SQL)]))
def sink_model(spark, sf):
    """K5: fit points and fitted parameters persisted as Parquet; the points are read back."""
    pts = bg.background_points(sq._prepared(spark, sf))
    params = bg.fit_background(pts)
    path = unique_scratch(spark, "model")
    sinks.sink_model(pts, params, path)
    return spark.read.parquet(f"{path}/points")


@register(
    "sink_empty", "K6",
    fx.with_fixtures(["site_counts"], "select sample, chrom, pos, strand, motif, uncon, depth, cast(null as double) as p from site_counts where depth < 0"),
)
def sink_empty(spark, sf):
    """K6: a run with no sites writes an empty table that keeps its schema."""
    empty = fx.load(spark, sf, "site_counts").where(F.col("depth") < 0)
    called, _, _ = calling.call_sites(empty, ["chrom", "pos", "strand"], params=bg.fallback_background(bg.background_points(calling.prepare_sites(empty))))
    out = called.select("sample", "chrom", "pos", "strand", "motif", "uncon", "depth", "p")
    path = unique_scratch(spark, "empty")
    sinks.sink_parquet(out, path)
    return spark.read.parquet(path)
