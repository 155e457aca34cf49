"""File sources (S1-S14).  Every reader is a Spark scan; per-file facts (layout,
sample name) come from the file path or Hive-style partition directories.

Sample names: an explicit ``sample=`` argument, else a ``sample`` partition
directory (``.../sample=<name>/...``), else the file name before its first dot.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitecall.functions.cigar import QUERY_OPS, cigar_ops, ops_length
from sitecall.operators.joins import bounded_broadcast

HEADER_COLS = ("chrom", "pos", "strand", "motif", "u0", "u1", "u2", "m0", "m1", "m2")
LEGACY_COLS = ("Chrom", "Pos", "Strand", "Motif", "U0", "D0", "U1", "D1", "U2", "D2")
LONG_OUT = ("sample", "chrom", "pos", "strand", "motif", "uncon", "depth")


def _file_name() -> Column:
    """Name of the row's file; the metadata has it as in a URL, but for the plus sign."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _file_stem_sample() -> Column:
    return F.substring_index(_file_name(), ".", 1)


def _with_sample(df: DataFrame, sample: str | None) -> DataFrame:
    if sample is not None:
        return df.withColumn("sample", F.lit(sample))
    if "sample" in df.columns:
        return df.withColumn("sample", F.col("sample").cast("string"))
    return df.withColumn("sample", _file_stem_sample())


# S1 -------------------------------------------------------------------------
def _first_lines(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    """First line of every file that has one. Each is a job that stops at the line, 16 at a time."""
    files = spark.read.text(path).inputFiles()

    def first(f: str) -> tuple[str, str | None]:
        row = spark.read.text(unquote(f)).select("value", "_metadata.file_path").limit(1).collect()
        return (row[0]["file_path"], row[0]["value"]) if row else (f, None)

    with ThreadPoolExecutor(16) as pool:
        return {f: line for f, line in pool.map(first, files) if line is not None}


def _by_layout(spark: SparkSession, path: str | Sequence[str], legacy: bool) -> DataFrame:
    """One text scan of all files, each with its own layout: sample columns, ``_legacy``, ``_line`` fields by ``_at``.

    A file whose first line starts with ``chrom`` has the header layout and its columns are found by name, in any order
    and among others; any other has the legacy layout, or is an error if that is not allowed.
    """
    rows = []
    for file, line in _first_lines(spark, path).items():
        names = line.split("\t")
        if line.startswith("chrom"):
            missing = [c for c in HEADER_COLS if c not in names]
            if missing:
                raise ValueError(f"{file}: header without {', '.join(missing)}")
            rows.append((file, False, line, len(names), [names.index(c) for c in HEADER_COLS]))
        elif legacy:
            rows.append((file, True, None, len(LEGACY_COLS), list(range(len(LEGACY_COLS)))))
        else:
            raise ValueError(f"{file}: no header line")
    layout = spark.createDataFrame(rows, "_path string, _legacy boolean, _head string, _width int, _at array<int>")
    layout, _ = bounded_broadcast(layout)  # one row a file
    raw = spark.read.text(path)  # Hive-style directories add partition columns
    lines = raw.select(
        F.col("value").alias("_value"), F.split("value", "\t").alias("_f"), F.col("_metadata.file_path").alias("_file"), _file_name().alias("_name"),
        *(["sample"] if "sample" in raw.columns else []),
    )
    x = lines.join(layout, F.col("_file") == F.col("_path")).where((F.col("_value") != "") & ~F.col("_value").eqNullSafe(F.col("_head")))
    wrong = F.raise_error(F.concat(F.lit("malformed line in "), "_file", F.lit(": "), "_value")).cast("array<string>")
    return x.withColumn("_f", F.when(F.size("_f") == F.col("_width"), F.col("_f")).otherwise(wrong))


def _layout_counts(x: DataFrame, sample: str | None) -> DataFrame:
    """Long counts of both layouts: tiers 1 and 2 of the header layout, U1 and D1 of the legacy one."""

    def field(i: int) -> Column:
        return F.col("_f")[F.col("_at")[i]]

    def num(i: int) -> Column:
        return field(i).cast("bigint")  # a malformed count is an error

    name = F.lit(sample) if sample is not None else F.col("sample").cast("string") if "sample" in x.columns else F.substring_index("_name", ".", 1)
    old = F.col("_legacy")
    out = x.select(
        name.alias("sample"), field(0).alias("chrom"), num(1).alias("pos"), field(2).alias("strand"), field(3).alias("motif"),
        F.when(old, num(6)).otherwise(num(5) + num(6)).alias("uncon"), F.when(old, num(7)).otherwise(num(5) + num(8) + num(6) + num(9)).alias("depth"),
    )
    return out.where(F.col("depth") > 0)


def scan_pileup(spark: SparkSession, path: str | Sequence[str], sample: str | None = None) -> DataFrame:
    """Header layout ``chrom pos strand motif u0 u1 u2 m0 m1 m2``, selected by name file by file -> long counts, zero
    depth dropped. A file without the header or one of its columns, a malformed count and a line of another width are errors."""
    return _layout_counts(_by_layout(spark, path, legacy=False), sample)


# S2 -------------------------------------------------------------------------
def scan_pileup_legacy(spark: SparkSession, path: str | Sequence[str], sample: str | None = None) -> DataFrame:
    """Headerless 10-column layout; uncon = U1, depth = D1 (tier 1 only), D1 > 0."""
    schema = T.StructType(
        [T.StructField("Chrom", T.StringType()), T.StructField("Pos", T.LongType()),
         T.StructField("Strand", T.StringType()), T.StructField("Motif", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in LEGACY_COLS[4:]]
    )
    df = _with_sample(spark.read.csv(path, sep="\t", header=False, schema=schema, mode="FAILFAST"), sample)
    return df.where(F.col("D1") > 0).select(
        "sample", F.col("Chrom").alias("chrom"), F.col("Pos").alias("pos"), F.col("Strand").alias("strand"),
        F.col("Motif").alias("motif"), F.col("U1").alias("uncon"), F.col("D1").alias("depth"),
    )


# S3 -------------------------------------------------------------------------
def scan_pileup_auto(spark: SparkSession, path: str | Sequence[str], sample: str | None = None) -> DataFrame:
    """Mixed layouts: a file whose first line starts with ``chrom`` is read as the header layout, by name, any other file
    as the legacy layout. All files in one scan."""
    return _layout_counts(_by_layout(spark, path, legacy=True), sample)


# S4 -------------------------------------------------------------------------
def scan_sites_wide(spark: SparkSession, path: str | Sequence[str], keys: Sequence[str] = ("Chrom", "Pos", "Strand")) -> DataFrame:
    """Wide sites TSV (``Uncon_<s>``/``Depth_<s>`` pairs): header peek by the CSV
    reader, counts cast to bigint, key columns kept as strings, Pos bigint; empty
    annotation fields (GeneName, GenePos, ...) read as empty strings."""
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    cols = []
    for c in raw.columns:
        if c.startswith(("Depth_", "Uncon_")) or c == "Pos":
            cols.append(F.col(f"`{c}`").cast("bigint").alias(c))
        elif c in keys:
            cols.append(F.col(f"`{c}`").cast("string").alias(c))
        else:
            cols.append(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c))
    return raw.select(*cols)


# S5 -------------------------------------------------------------------------
def scan_transcripts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Spans table selected by column name: gene_id, chrom, strand, spans."""
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    return df.select("gene_id", "chrom", "strand", "spans")


# S6 -------------------------------------------------------------------------
def fasta_union(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records of many FASTA files as (name, description, seq).

    Records are read with ``\\n>`` as the record separator (splittable); the first
    record of each file keeps its leading ``>``, which is stripped.
    """
    rec = spark.read.text(paths, lineSep="\n>").where(F.length(F.trim("value")) > 0)
    body = F.regexp_replace(F.col("value"), "^>", "")
    lines = F.split(body, "\n")
    header = lines.getItem(0)
    seq = F.array_join(F.slice(lines, 2, F.size(lines)), "")
    return rec.select(
        F.substring_index(header, " ", 1).alias("name"),
        F.when(F.instr(header, " ") > 0, F.substring(header, F.instr(header, " ") + 1, 1 << 30)).alias("description"),
        F.regexp_replace(seq, "\\s", "").alias("seq"),
    )


# S7 -------------------------------------------------------------------------
def transcript_table(spark: SparkSession, gtf_path: str | Sequence[str], feature: str = "exon") -> DataFrame:
    """GTF exons -> one spans row per transcript: gene_id, transcript_id, chrom, strand,
    spans (1-based inclusive ``s-e``, listed 5' -> 3': ascending on +, descending on -).

    Exons of one transcript are collected (bounded by the transcript's exon count).
    """
    t = spark.read.text(gtf_path).where(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    ex = t.select(
        f.getItem(0).alias("chrom"), f.getItem(2).alias("feature"), f.getItem(3).cast("bigint").alias("start"),
        f.getItem(4).cast("bigint").alias("end"), f.getItem(6).alias("strand"),
        F.regexp_extract(f.getItem(8), 'gene_id "([^"]+)"', 1).alias("gene_id"),
        F.regexp_extract(f.getItem(8), 'transcript_id "([^"]+)"', 1).alias("transcript_id"),
    ).where((F.col("feature") == feature) & (F.col("transcript_id") != ""))
    g = ex.groupBy("gene_id", "transcript_id", "chrom", "strand").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_e")
    )
    ordered = F.when(F.col("strand") == "-", F.reverse("_e")).otherwise(F.col("_e"))
    spans = F.array_join(F.transform(ordered, lambda e: F.concat(e["start"].cast("string"), F.lit("-"), e["end"].cast("string"))), ",")
    return g.select("gene_id", "transcript_id", "chrom", "strand", spans.alias("spans"))


def path_partition(col_name: str) -> Column:
    """A ``<name>=<value>`` directory component of the column ``file``."""
    return F.regexp_extract(F.col("file"), f"/{col_name}=([^/]+)/", 1)


# S9 -------------------------------------------------------------------------
_TAGS = ("XM", "NS", "NC", "Yf", "Zf", "RX")  # those with a column of their own


def _tag(name: str) -> Column:
    """The first tag of that name, as in the line; null without one."""
    return F.get(F.filter("_tags", lambda x: x.startswith(f"{name}:")), F.lit(0))


def _int_tag(name: str) -> Column:
    """Value of a tag of type ``i``; a tag of that name with another type counts as missing."""
    tag, head = F.col(f"_{name}"), f"{name}:i:"
    return F.when(tag.startswith(head), F.substring(tag, len(head) + 1, 1 << 30)).cast("bigint")


def _star_null(c: Column) -> Column:
    return F.when(c != "*", c)


def scan_alignments(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SAM text -> alignment table: read_id, flag, chrom, pos, mapq, cigar with its operations (``ops``: op, len,
    query offset q, reference offset r), mate fields, isize, seq, qual, strand (flag 0x10), qlen and sclen, the tags as a
    map name -> (type, value) and the usual ones as columns (XM, NS, NC, Yf, Zf of type ``i``; RX as umi).

    Header lines (``@``) are skipped; ``*`` is null for seq, qual and the mate's reference, a mate position 0 is null, the
    mate reference ``=`` is the record's; of a repeated tag the first counts; qlen without a CIGAR is the sequence's.
    """
    t = spark.read.text(path).where(~F.col("value").startswith("@"))
    t = t.withColumn("_f", F.split("value", "\t")).drop("value")
    f = F.col("_f")
    out = t.select(
        "*", f.getItem(0).alias("read_id"), f.getItem(1).cast("bigint").alias("flag"), f.getItem(2).alias("chrom"),
        f.getItem(3).cast("bigint").alias("pos"), f.getItem(4).cast("bigint").alias("mapq"), f.getItem(5).alias("cigar"),
        F.when(f.getItem(6) == "=", f.getItem(2)).otherwise(_star_null(f.getItem(6))).alias("mate_chrom"),
        F.when(f.getItem(7) != "0", f.getItem(7).cast("bigint")).alias("mate_pos"), f.getItem(8).cast("bigint").alias("isize"),
        _star_null(f.getItem(9)).alias("seq"), _star_null(f.getItem(10)).alias("qual"), F.slice(f, 12, 1 << 20).alias("_tags"),
    ).drop("_f")
    # a tag is name:type:value, whether anyone asks for it or not
    cut = F.exists("_tags", lambda x: F.substring_index(x, ":", 2) == x)
    wrong = F.raise_error(F.concat(F.lit("malformed tag in the record "), F.col("read_id"))).cast("array<string>")
    out = out.withColumn("_tags", F.when(cut, wrong).otherwise(F.col("_tags")))
    parts = F.transform("_tags", lambda x: F.split(x, ":", 3))
    names = F.transform("_parts", lambda x: x.getItem(0))
    firsts = F.filter("_parts", lambda x, i: F.array_position(F.col("_names"), x.getItem(0)) == i + 1)
    tag_map = F.map_from_entries(F.transform(
        firsts, lambda x: F.struct(x.getItem(0), F.struct(x.getItem(1).alias("type"), x.getItem(2).alias("value")))))
    out = out.withColumns({"_parts": parts} | {f"_{name}": _tag(name) for name in _TAGS}).withColumn("_names", names)
    out = out.withColumn("tags", tag_map).drop("_tags", "_parts", "_names").withColumn("ops", cigar_ops("cigar"))
    return out.select(
        *[c for c in out.columns if c not in {f"_{name}" for name in _TAGS}], F.when((F.col("flag").bitwiseAND(16)) != 0, F.lit("-")).otherwise(F.lit("+")).alias("strand"),
        F.when(F.size("ops") > 0, ops_length("ops", QUERY_OPS)).otherwise(F.coalesce(F.length("seq"), F.lit(0))).cast("bigint").alias("qlen"),
        ops_length("ops", ("S",)).alias("sclen"),
        _int_tag("XM").alias("xm"), _int_tag("NS").alias("ns"), _int_tag("NC").alias("nc"), _int_tag("Yf").alias("yf"), _int_tag("Zf").alias("zf"),
        F.split("_RX", ":", 3).getItem(2).alias("umi"),
    )


# S10 / S11 / S12 / S13 -----------------------------------------------------------
def trim_report_json(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per trimmer JSON file: its text as ``report`` plus partition columns; without a partition directory
    ``sample`` is the file name before its first underscore."""
    t = spark.read.text(path, wholetext=True)
    name = [] if "sample" in t.columns else [F.substring_index(_file_name(), "_", 1).alias("sample")]
    return t.select("*", *name).withColumnRenamed("value", "report")


# Fixed text of the external tool's log lines.
_LOG_TOTAL = r"Total reads processed:\s*([0-9,]+)"
_LOG_DUPLICATES = r"Duplicates removed:\s*([0-9,]+)"
_LOG_UNIQUE = r"Total Unique Reads:\s*([0-9,]+)"
_LOG_RATE = r"Deduplication rate:\s*([\d\.]+)%"


def dedup_log_parse(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Dedup logs -> (sample, reftype, total_reads, duplicates, unique_reads, duplication_rate);
    files without a total line are dropped.  Without partition directories, sample and type are the
    first two dot-separated parts of the file name.  One aggregate per file (bounded by its lines)."""
    t = spark.read.text(path)
    parts = F.split(_file_name(), "\\.")
    named = {"sample": parts.getItem(0), "reftype": F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).otherwise(F.lit("unknown"))}
    t = t.select("*", F.col("_metadata.file_path").alias("_file"), *[c.alias(k) for k, c in named.items() if k not in t.columns])

    def grab(pattern: str) -> Column:
        v = F.regexp_replace(F.regexp_extract("value", pattern, 1), ",", "")
        return F.when(v != "", v)

    g = t.groupBy("_file", "sample", "reftype").agg(
        F.max(grab(_LOG_TOTAL).cast("bigint")).alias("total_reads"),
        F.max(grab(_LOG_DUPLICATES).cast("bigint")).alias("duplicates"),
        F.max(grab(_LOG_UNIQUE).cast("bigint")).alias("unique_reads"),
        F.max(grab(_LOG_RATE).cast("double")).alias("duplication_rate"),
    )
    return g.where(F.col("total_reads").isNotNull()).drop("_file")


def stage_count_parse(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``key<TAB>value`` stage files -> (sample, key, value)."""
    df = spark.read.csv(path, sep="\t", header=False, schema="key string, value bigint")
    return _with_sample(df, None).select("sample", "key", "value")


def motif_file_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Motif tables -> (sample, reftype, motif, count, unconverted, depth, ratio).

    sample/reftype come from partition directories, else from ``<sample>.<reftype>.tsv``
    (missing part -> ``unknown``)."""
    schema = "motif string, count bigint, unconverted bigint, depth bigint, ratio double"
    # a malformed count or a header with other names or another order is an error, never a silent loss
    df = spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False, mode="FAILFAST")
    name = F.regexp_replace(_file_name(), "\\.tsv$", "")
    parts = F.split(name, "\\.")
    sample = F.col("sample").cast("string") if "sample" in df.columns else parts.getItem(0)
    reftype = F.col("reftype").cast("string") if "reftype" in df.columns else F.coalesce(parts.getItem(1), F.lit("unknown"))
    return df.select(sample.alias("sample"), reftype.alias("reftype"), "motif", "count", "unconverted", "depth", "ratio")


# S14 ------------------------------------------------------------------------
SHEET_SCHEMA = (
    "sample string, libtype string, adapter string, `group` string, data array<struct<R1: string, R2: string>>"
)


def sample_sheet(spark: SparkSession, path: str | Sequence[str], libtype: str = "", adapter: str = "") -> tuple[DataFrame, DataFrame]:
    """Sample sheet (JSON lines, one sample per line) -> (runs, groups).

    runs: sample, run (``run<i>``), libtype/adapter with the global fallback, r1, r2,
    is_pe (two files).  groups: (group, sample).
    """
    s = spark.read.schema(SHEET_SCHEMA).json(path)
    runs = s.select(
        "sample", F.coalesce("libtype", F.lit(libtype)).alias("libtype"), F.coalesce("adapter", F.lit(adapter)).alias("adapter"),
        F.posexplode("data").alias("i", "d"),
    ).select(
        "sample", F.concat(F.lit("run"), (F.col("i") + 1).cast("string")).alias("run"), "libtype", "adapter",
        F.col("d.R1").alias("r1"), F.col("d.R2").alias("r2"), F.col("d.R2").isNotNull().alias("is_pe"),
    )
    groups = s.where(F.col("group").isNotNull()).select("group", "sample")
    return runs, groups


MAPPING_SAMPLE = "struct<libtype: string, adapter: string, `group`: string, data: array<map<string, string>>>"


def sample_mapping(spark: SparkSession, path: str, batch: str = "") -> tuple[DataFrame, DataFrame]:
    """Configuration with a mapping of samples, as JSON: ``samples`` (or ``samples_<batch>``) maps a sample's name to its
    libtype, adapter, group and data, a list of runs each with R1 and maybe R2; libtype and adapter at the top are the
    fallback -> (runs, groups) as from ``sample_sheet``. A run is paired if it has two files; a configuration without
    samples is an error.
    """
    named = f"samples: map<string, {MAPPING_SAMPLE}>, `samples_{batch}`: map<string, {MAPPING_SAMPLE}>"
    config = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<libtype: string, adapter: string, {named}>", {"mode": "FAILFAST"}).alias("c"))
    found = F.coalesce(F.when(F.size("c.samples") > 0, F.col("c.samples")), F.when(F.size(F.col("c")[f"samples_{batch}"]) > 0, F.col("c")[f"samples_{batch}"]))
    empty = F.raise_error(F.lit("a configuration needs samples")).cast(f"map<string, {MAPPING_SAMPLE}>")
    s = config.select("c.libtype", "c.adapter", F.explode(F.coalesce(found, empty)).alias("sample", "s"))
    runs = s.select("sample", F.coalesce("s.libtype", "libtype", F.lit("")).alias("libtype"), F.coalesce("s.adapter", "adapter", F.lit("")).alias("adapter"), F.posexplode("s.data").alias("i", "d"))
    runs = runs.select(
        "sample", F.concat(F.lit("run"), (F.col("i") + 1).cast("string")).alias("run"), "libtype", "adapter",
        F.col("d")["R1"].alias("r1"), F.col("d")["R2"].alias("r2"), (F.size("d") == 2).alias("is_pe"),
    )
    return runs, s.where(F.col("s.group").isNotNull()).select(F.col("s.group").alias("group"), "sample")
