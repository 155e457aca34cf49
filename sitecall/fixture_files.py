"""Text-file layouts of the fixtures, for the file sources.

Each writer lays out rows of a table-derived fixture in a file format (TSV,
FASTA, GTF, FASTQ.gz, SAM, JSON, logs) under the shared checkpoint folder,
once per session and scale-factor directory.  Writers only format rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecall import fixtures as fx
from sitecall.session import scratch_path

_WRITTEN: dict[tuple, str] = {}


def _path(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, bool]:
    key = (spark.sparkContext.applicationId, fx._sf_key(sf_dir), kind)
    if key in _WRITTEN:
        return _WRITTEN[key], True
    p = scratch_path(spark, "files", key[0], key[1], kind)
    _WRITTEN[key] = p
    return p, False


def _tsv(df: DataFrame, path: str, header: bool, parts=(), compression: str | None = None) -> None:
    w = df.write.mode("overwrite").option("sep", "\t").option("header", header)
    if compression:
        w = w.option("compression", compression)
    if parts:
        w = w.partitionBy(*parts)
    w.csv(path)


def _text_by(df: DataFrame, path: str, *parts: str, per_file: int = 0) -> None:
    """Text files by directory, a writer open for each, so that a task does not sort (and spill) its rows by directory first."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key, None)
    conf.set(key, "64")
    try:
        df.write.mode("overwrite").option("maxRecordsPerFile", per_file).partitionBy(*parts).text(path)
    finally:
        conf.set(key, before) if before else conf.unset(key)


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless 10-column layout of the site counts; sites at pos % 11 = 0 have D1 = 0."""
    s = fx.load(spark, sf_dir, "site_counts")
    return s.select(
        "sample", F.col("chrom").alias("Chrom"), F.col("pos").alias("Pos"), F.col("strand").alias("Strand"),
        F.col("motif").alias("Motif"), (F.col("uncon") % 3).alias("U0"), (F.col("depth") % 5).alias("D0"),
        F.col("uncon").alias("U1"), F.when(F.col("pos") % 11 == 0, F.lit(0)).otherwise(F.col("depth")).alias("D1"),
        F.expr("uncon div 2").alias("U2"), F.expr("depth div 2").alias("D2"),
    )


LEGACY_SQL = (
    "select sample, chrom as Chrom, pos as Pos, strand as Strand, motif as Motif, uncon % 3 as U0, depth % 5 as D0, uncon as U1, "
    "case when pos % 11 = 0 then 0 else depth end as D1, uncon // 2 as U2, depth // 2 as D2 from site_counts"
)

_HEADER_COLS = ["chrom", "pos", "strand", "motif", "u0", "u1", "u2", "m0", "m1", "m2"]
_LEGACY_COLS = ["Chrom", "Pos", "Strand", "Motif", "U0", "D0", "U1", "D1", "U2", "D2"]


def pileup_header_files(spark, sf_dir) -> str:
    p, done = _path(spark, sf_dir, "pileup_header")
    if not done:
        _tsv(fx.load(spark, sf_dir, "pileup_tiers").select("sample", *_HEADER_COLS), p, True, ("sample",))
    return p


def pileup_legacy_files(spark, sf_dir) -> str:
    p, done = _path(spark, sf_dir, "pileup_legacy")
    if not done:
        _tsv(legacy_rows(spark, sf_dir).select("sample", *_LEGACY_COLS), p, False, ("sample",))
    return p


MIXED_HEADER_SAMPLES = ("s0", "s2")


def pileup_mixed_files(spark, sf_dir) -> str:
    """Samples s0, s2 in the header layout, s1, s3 in the legacy layout, one directory tree."""
    p, done = _path(spark, sf_dir, "pileup_mixed")
    if not done:
        h = fx.load(spark, sf_dir, "pileup_tiers").where(F.col("sample").isin(*MIXED_HEADER_SAMPLES)).select("sample", *_HEADER_COLS)
        lg = legacy_rows(spark, sf_dir).where(~F.col("sample").isin(*MIXED_HEADER_SAMPLES)).select("sample", *_LEGACY_COLS)
        _tsv(h, p, True, ("sample",))
        lg.write.mode("append").option("sep", "\t").option("header", False).partitionBy("sample").csv(p)
    return p


def sites_wide_files(spark, sf_dir) -> str:
    """Wide sites table (GeneName/GenePos empty) pivoted from the site counts."""
    p, done = _path(spark, sf_dir, "sites_wide")
    if not done:
        s = fx.load(spark, sf_dir, "site_counts")
        aggs = [F.first("motif").alias("Motif")]
        for smp in fx.SAMPLES:
            aggs.append(F.coalesce(F.sum(F.when(F.col("sample") == smp, F.col("uncon"))), F.lit(0)).alias(f"Uncon_{smp}"))
            aggs.append(F.coalesce(F.sum(F.when(F.col("sample") == smp, F.col("depth"))), F.lit(0)).alias(f"Depth_{smp}"))
        w = s.groupBy("chrom", "pos", "strand").agg(*aggs)
        w = w.select(
            F.col("chrom").alias("Chrom"), F.col("pos").alias("Pos"), F.col("strand").alias("Strand"),
            F.lit("").alias("GeneName"), F.lit("").alias("GenePos"), "Motif",
            *[c for smp in fx.SAMPLES for c in (f"Uncon_{smp}", f"Depth_{smp}")],
        )
        _tsv(w, p, True, compression="gzip")
    return p


def transcripts_files(spark, sf_dir) -> str:
    p, done = _path(spark, sf_dir, "transcripts_tsv")
    if not done:
        t = fx.load(spark, sf_dir, "transcripts")
        _tsv(t.select(F.concat("gene_id", F.lit(".1")).alias("transcript_id"), "chrom", "gene_id",
                      F.lit(120).alias("length"), "strand", "spans"), p, True)
    return p


FASTA_LEN = 150


def fasta_rows(spark, sf_dir) -> DataFrame:
    part = fx.table(spark, sf_dir, "part")
    seq = F.expr(fx.seq_expr("p_partkey", "p_size", FASTA_LEN))
    return part.select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("name"),
                       F.col("p_name").alias("description"), seq.alias("seq"))


def fasta_files(spark, sf_dir) -> str:
    """Records wrapped at 60 bases, spread over several files."""
    p, done = _path(spark, sf_dir, "fasta")
    if not done:
        r = fasta_rows(spark, sf_dir)
        rec = F.concat(
            F.lit(">"), "name", F.lit(" "), "description", F.lit("\n"),
            F.substring("seq", 1, 60), F.lit("\n"), F.substring("seq", 61, 60), F.lit("\n"), F.substring("seq", 121, 60),
        )
        r.select(rec.alias("value")).repartition(3).write.mode("overwrite").text(p)
    return p


def gtf_files(spark, sf_dir) -> str:
    """Gene, transcript and exon lines (exons written 3' -> 5' to test ordering) plus comments."""
    p, done = _path(spark, sf_dir, "gtf")
    if not done:
        t = fx.load(spark, sf_dir, "transcripts")
        attrs = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "gene_id", F.lit('.1"; gene_biotype "protein_coding";'))
        ex = t.select("gene_id", "chrom", "strand", F.posexplode(F.reverse(F.split("spans", ","))).alias("i", "span"))
        exon_lines = ex.select(F.concat_ws(
            "\t", "chrom", F.lit("synthetic"), F.lit("exon"), F.split("span", "-").getItem(0), F.split("span", "-").getItem(1),
            F.lit("."), "strand", F.lit("."),
            F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "gene_id", F.lit('.1"; exon_number "'),
                     (F.col("i") + 1).cast("string"), F.lit('";')),
        ).alias("value"))
        gene_lines = t.select(F.concat_ws("\t", "chrom", F.lit("synthetic"), F.lit("gene"), F.lit("1"), F.lit("2"), F.lit("."), "strand",
                                          F.lit("."), F.concat(F.lit('gene_id "'), "gene_id", F.lit('";'))).alias("value"))
        tx_lines = t.select(F.concat_ws("\t", "chrom", F.lit("synthetic"), F.lit("transcript"), F.lit("1"), F.lit("2"), F.lit("."), "strand",
                                        F.lit("."), attrs).alias("value"))
        head = spark.createDataFrame([("#!genome-build synthetic",)], "value string")
        head.unionByName(gene_lines).unionByName(tx_lines).unionByName(exon_lines).write.mode("overwrite").text(p)
    return p


def fastq_files(spark, sf_dir) -> str:
    """gzip FASTQ per (sample, run, mate), a file a task: a gzip file is one split, so none holds a whole mate."""
    p, done = _path(spark, sf_dir, "fastq")
    if not done:
        r = fx.load(spark, sf_dir, "reads")
        rec = F.concat_ws("\n", F.concat(F.lit("@"), "read_id", F.lit(" "), "mate"), "seq", F.lit("+"), "qual")
        (r.select("sample", "run", "mate", rec.alias("value"))
         .write.mode("overwrite").option("compression", "gzip").partitionBy("sample", "run", "mate").text(p))
    return p


# Aligned stretches (operation, length, query and reference offset) of the fixture's CIGARs, worked out by hand.
CIGAR_BLOCKS = {
    "48M": "M:48:0:0", "3S45M": "M:45:3:0", "20M2I26M": "M:20:0:0,M:26:22:20", "24M3D24M": "M:24:0:0,M:24:24:27",
    "5S18M1I12M2D12M": "M:18:5:0,M:12:24:18,M:12:36:32", "2H40M6S": "M:40:0:0", "16M500N32M": "M:16:0:0,M:32:16:516",
    "4=1X20=23M": "=:4:0:0,X:1:4:4,=:20:5:5,M:23:25:25",
}


def sam_files(spark, sf_dir) -> str:
    """SAM text per (sample, run, reftype) with gapped CIGARs, mate fields, bases and tags of several types, one of them repeated."""
    p, done = _path(spark, sf_dir, "sam")
    if not done:
        a = fx.load(spark, sf_dir, "sam_records")

        def tag(name: str, kind: str, c: str):
            return F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}:{kind}:"), F.col(c).cast("string")))

        line = F.concat_ws(
            "\t", "read_id", F.col("flag").cast("string"), "chrom", F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar",
            "rnext", F.col("pnext").cast("string"), F.col("isize").cast("string"), "seq", "qual",
            F.when(F.col("xm_text"), F.lit("XM:Z:a:b")), tag("XM", "i", "xm"), tag("NS", "i", "ns"), F.lit("NS:i:77"), tag("NC", "i", "nc"),
            tag("RX", "Z", "umi"), tag("Yf", "i", "yf"), tag("Zf", "i", "zf"), F.lit("ML:B:C,1,2"),
        )
        body = a.select("sample", "run", "reftype", line.alias("value"))
        head = a.select("sample", "run", "reftype").distinct().select("sample", "run", "reftype", F.lit("@HD\tVN:1.6\tSO:unsorted").alias("value"))
        _text_by(head.unionByName(body), p, "sample", "run", "reftype")
    return p


def genome_fasta_files(spark, sf_dir) -> str:
    """The reference genome as FASTA, a chromosome one record of many 50-base lines."""
    p, done = _path(spark, sf_dir, "genome_fasta")
    if not done:
        g = fx.load(spark, sf_dir, "genome_segments")
        heads = g.select("chrom").distinct().select("chrom", F.lit(-1).cast("bigint").alias("seg"), F.concat(F.lit(">"), "chrom", F.lit(" synthetic")).alias("value"))
        lines = heads.unionByName(g.select("chrom", "seg", F.col("bases").alias("value")))
        lines.repartition("chrom").sortWithinPartitions("chrom", "seg").select("value").write.mode("overwrite").text(p)
    return p


def probe_fasta_files(spark, sf_dir) -> str:
    """The spike-in probes, one record each."""
    p, done = _path(spark, sf_dir, "probe_fasta")
    if not done:
        lines = [f">{kind}_{rate}\n{seq[:30]}\n{seq[30:]}" for kind in ("probe", "rrna") for rate, seq in fx.PROBES.items()]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(p)
    return p


PLAIN_PARTS = 8


def plain_fastq_rows(spark, sf_dir) -> DataFrame:
    """The records by directory, in fewer and so longer parts than the reads come in; none is moved."""
    r = fx.load(spark, sf_dir, "reads")
    rec = F.concat_ws("\n", F.concat(F.lit("@"), "read_id", F.lit(" "), "mate"), "seq", F.lit("+"), "qual")
    r = r.select("sample", "run", "mate", rec.alias("value"))
    return r.coalesce(max(PLAIN_PARTS, r.rdd.getNumPartitions() // 2))


def plain_fastq_files(spark, sf_dir) -> str:
    """Uncompressed FASTQ per (sample, run, mate), in some parts at least, that stay longer than a split as the reads grow."""
    p, done = _path(spark, sf_dir, "fastq_plain")
    if not done:
        most = fx.load(spark, sf_dir, "reads").groupBy("sample", "run", "mate").count().agg(F.max("count")).first()[0] or 0
        _text_by(plain_fastq_rows(spark, sf_dir), p, "sample", "run", "mate", per_file=most // PLAIN_PARTS + 1)
    return p


def trim_json_files(spark, sf_dir) -> str:
    p, done = _path(spark, sf_dir, "trim_json")
    if not done:
        t = fx.load(spark, sf_dir, "trim_reports")
        t.select("sample", "run", F.col("report").alias("value")).repartition("sample", "run") \
            .write.mode("overwrite").partitionBy("sample", "run").text(p)
    return p


def dedup_log_files(spark, sf_dir) -> str:
    p, done = _path(spark, sf_dir, "dedup_logs")
    if not done:
        d = fx.load(spark, sf_dir, "dedup_logs")
        d.select("sample", "reftype", F.col("log").alias("value")).repartition("sample", "reftype") \
            .write.mode("overwrite").partitionBy("sample", "reftype").text(p)
    return p


def sample_sheet_files(spark, sf_dir) -> str:
    """JSON lines, one sample each: runs from the alignments, R2 for odd samples, groups, one libtype."""
    p, done = _path(spark, sf_dir, "sample_sheet")
    if not done:
        a = fx.load(spark, sf_dir, "alignments").select("sample", "run").distinct()
        odd = F.col("sample").isin("s1", "s3")
        runs = a.select("sample", "run", F.struct(
            F.concat(F.lit("fastq/"), "sample", F.lit("_"), "run", F.lit("_R1.fq.gz")).alias("R1"),
            F.when(odd, F.concat(F.lit("fastq/"), "sample", F.lit("_"), "run", F.lit("_R2.fq.gz"))).alias("R2"),
        ).alias("d"))
        s = runs.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("run", "d"))).alias("_r"))
        grp = F.when(F.col("sample").isin("s0", "s1"), F.lit("g1")).otherwise(F.lit("g2"))
        out = s.select(F.to_json(F.struct(
            "sample", F.when(F.col("sample") == "s0", F.lit("TAKARAv2")).alias("libtype"), grp.alias("group"),
            F.transform("_r", lambda x: x["d"]).alias("data"),
        )).alias("value"))
        out.write.mode("overwrite").text(p)
    return p


def sample_mapping_files(spark, sf_dir) -> str:
    """The sample sheet as one configuration: a mapping of samples under a batch's name and a global adapter."""
    p, done = _path(spark, sf_dir, "sample_mapping")
    if not done:
        lines = spark.read.text(sample_sheet_files(spark, sf_dir))
        one = lines.select(F.concat(F.lit('"'), F.get_json_object("value", "$.sample"), F.lit('": '), F.col("value")).alias("line"))
        text = F.concat(F.lit(f'{{"adapter": "{fx.ADAPTER}",\n"samples_b1": {{'), F.array_join(F.array_sort(F.collect_list("line")), ",\n"), F.lit("}}"))
        one.agg(text.alias("value")).write.mode("overwrite").text(p)
    return p
