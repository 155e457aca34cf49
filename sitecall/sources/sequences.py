"""Sequence files read as splittable text: FASTQ reads (S8) and FASTA as fixed tiles (S6), transcript sequences.

Spark cuts a text file into splits at line ends; the lines of a split reach one task in file order, and
``_metadata`` names their file and block. What a task cannot know - the record that a split starts in, the bases
before it - is a small row a split or record and is summed over the file afterwards. Every file system that Spark
reads will do; a gzip file is one split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitecall.functions.cigar import reverse_complement
from sitecall.session import unique_scratch


def _split_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """value, file, block, whole: whether the split is its whole file."""
    raw = spark.read.text(path)
    m = F.col("_metadata")
    return raw.select("value", m["file_path"].alias("file"), m["file_block_start"].alias("block"),
                      ((m["file_block_start"] == 0) & (m["file_block_length"] >= m["file_size"])).alias("whole"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.StringArray]]:
    """(file, block, whole, lines) of consecutive lines of one split, as the batches bring them."""
    for rb in batches:
        if not rb.num_rows:
            continue
        values, files, blocks, whole = (rb.column(i) for i in range(4))
        f, b = files.dictionary_encode().indices.to_numpy(), blocks.to_numpy()
        ends = [0, *(int(i) + 1 for i in ((f[1:] != f[:-1]) | (b[1:] != b[:-1])).nonzero()[0]), rb.num_rows]
        for start, end in zip(ends, ends[1:]):
            yield files[start].as_py(), blocks[start].as_py(), whole[start].as_py(), values.slice(start, end - start)


# S8 -------------------------------------------------------------------------
_RECORDS = "file string, name string, seq string, plus string, qual string"
_PIECES = "file string, block long, ord long, line string"


class _Split:
    """Lines of one split: whole records as soon as its first header is known, the rest as pieces of cut records."""

    def __init__(self, file: str, block: int, whole: bool):
        self.file, self.block, self.whole = file, block, whole
        self.known = block == 0  # a file starts with a header
        self.carry = pa.array([], pa.string())
        self.pieces: list[str] = []

    def feed(self, lines: pa.StringArray) -> pa.StringArray:
        """Lines of whole records."""
        self.carry = pa.concat_arrays([self.carry, lines]) if len(self.carry) else lines
        if not self.known:
            # only a header has @ here and + two lines on: a quality line that starts with @ is followed by a header and bases
            line = lambda i: self.carry[i].as_py()
            first = next((i for i in range(len(self.carry) - 2) if line(i)[:1] == "@" and line(i + 2)[:1] == "+"), None)
            if first is None:
                return self.carry[:0]
            self.pieces += self.carry[:first].to_pylist()
            self.carry, self.known = self.carry[first:], True
        n = len(self.carry) - len(self.carry) % 4
        ready, self.carry = self.carry[:n], self.carry[n:]
        return ready

    def end(self) -> list[str]:
        """Lines of cut records: those before the first whole one and those after the last."""
        rest = self.carry.to_pylist()
        if self.whole and any(rest):
            raise ValueError(f"cut read at the end of {self.file}: {rest[0]}")
        return self.pieces + rest


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Split | None = None
    for file, block, whole, lines in _runs(batches):
        if now is None or (now.file, now.block) != (file, block):
            if now:
                now.end()
            now = _Split(file, block, whole)
        if n := len(ready := now.feed(lines)) // 4:
            fields = (ready.take(pa.array(np.arange(k, 4 * n, 4))) for k in range(4))
            yield pa.RecordBatch.from_arrays([pa.repeat(file, n), *fields], names=["file", "name", "seq", "plus", "qual"])
    if now:
        now.end()


def _cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(split: _Split) -> pa.RecordBatch:
        lines = split.end()
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([split.file] * n, pa.string()), pa.array([split.block] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(lines, pa.string())], names=["file", "block", "ord", "line"])

    now: _Split | None = None
    for file, block, whole, lines in _runs(batches):
        if now is None or (now.file, now.block) != (file, block):
            if now:
                yield out(now)
            now = _Split(file, block, whole)
        now.feed(lines)
    if now:
        yield out(now)


def _checked(rows: DataFrame) -> DataFrame:
    """(file, name, seq, qual) of rows with the four lines of a record; an error where they are none."""
    good = F.col("name").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual"))
    name = F.regexp_extract(F.substring("name", 2, 1 << 30), r"^\S*", 0)
    wrong = F.raise_error(F.concat(F.lit("cut or malformed read in "), "file", F.lit(": "), F.coalesce("name", F.lit("")))).cast("string")
    empty = (F.col("name") == "") & (F.col("seq") == "") & (F.col("plus") == "") & (F.col("qual") == "")
    rows = rows.where(~F.coalesce(empty, F.lit(False)))
    return rows.select("file", F.when(F.coalesce(good, F.lit(False)), name).otherwise(wrong).alias("name"), "seq", "qual")


def scan_reads(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """FASTQ, plain or compressed -> (file, name, seq, qual).

    A split's whole records leave its task as they are, without a shuffle. Only the lines of records that a split's
    edge cuts are brought together by file, a few lines a split; files of one split (all gzip files) have none. The
    text is read a second time for them. Any cut or malformed record is an error, also the last one of a file; empty
    lines after the last record are passed over.
    """
    lines = _split_lines(spark, path)
    whole = _checked(lines.mapInArrow(_whole_records, _RECORDS))
    cut = lines.where(~F.col("whole")).mapInArrow(_cut_records, _PIECES)
    # the pieces of a file, in order, are whole records again: each starts where whole ones end
    cut = cut.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("block", "ord")) - 1)
    last = F.max(F.when(F.col("line") != "", F.col("n"))).over(Window.partitionBy("file"))
    cut = cut.withColumn("last", last).where(F.expr("n div 4 <= last div 4"))
    line = {c: F.max(F.when(F.col("n") % 4 == k, F.col("line"))).alias(c) for k, c in enumerate(("name", "seq", "plus", "qual"))}
    cut = cut.groupBy("file", F.expr("n div 4").alias("rec")).agg(*line.values())
    return whole.unionByName(_checked(cut))


# S6 -------------------------------------------------------------------------
TILE = 1 << 14
MARGIN = 15
_CHUNK = 1 << 16
_FASTA = "file string, block long, rec long, name string, description string, off long, bases string"


def _fasta_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bases of a split in chunks, with the headers counted in it (record 0: what goes on from the split before)."""
    fields = [("file", pa.string()), ("block", pa.int64()), ("rec", pa.int64()), ("name", pa.string()), ("description", pa.string()), ("off", pa.int64()), ("bases", pa.string())]
    schema = pa.schema(fields)
    at: tuple[str, int] | None = None
    rec = off = held = 0
    parts: list[str] = []
    rows: list[dict] = []

    def chunk() -> None:
        nonlocal off, held, parts
        if parts:
            rows.append({"file": at[0], "block": at[1], "rec": rec, "off": off, "bases": "".join(parts)})
            off, held, parts = off + held, 0, []

    for file, block, _, lines in _runs(batches):
        if at != (file, block):
            chunk()
            at, rec, off = (file, block), 0, 0
        for line in lines.to_pylist():
            if line[:1] == ">":
                chunk()
                rec, off = rec + 1, 0
                name, _, description = line[1:].partition(" ")
                rows.append({"file": file, "block": block, "rec": rec, "name": name, "description": description or None, "off": 0, "bases": ""})
            else:
                line = "".join(line.split())
                if line:
                    parts.append(line)
                    held += len(line)
                    if held >= _CHUNK:
                        chunk()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            rows = []
    chunk()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def fasta_tiles(spark: SparkSession, paths: str | Sequence[str], tile: int = TILE, margin: int = MARGIN) -> DataFrame:
    """FASTA of records of any length -> (name, description, length, tile, bases), one row a tile.

    Tile t holds the bases from t * tile on; ``bases`` has ``margin`` more on either side, ``N`` beyond the record's
    ends and after the bases of its last tile. Record names must be unique over all files; a record without bases has
    no tile. The bases are written once and read back, so that the record positions are summed from narrow rows.
    """
    path = unique_scratch(spark, "fasta-chunks")
    _split_lines(spark, paths).mapInArrow(_fasta_split, _FASTA).write.parquet(path)
    chunks = spark.read.schema(_FASTA).parquet(path)
    # one row a record and split: its bases there, whose sum before it gives the place in the record
    runs = chunks.groupBy("file", "block", "rec").agg(F.sum(F.length("bases")).cast("bigint").alias("n"), F.max("name").alias("name"), F.max("description").alias("description"))
    along = Window.partitionBy("file").orderBy("block", "rec")
    before = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("before", before).withColumn("record", F.sum((F.col("rec") > 0).cast("int")).over(along))
    own = Window.partitionBy("file", "record")
    runs = runs.select(
        F.col("file").alias("_f"), F.col("block").alias("_b"), F.col("rec").alias("_r"), F.max("name").over(own).alias("name"),
        F.max("description").over(own).alias("description"), (F.col("before") - F.min("before").over(own)).alias("skip"), F.sum("n").over(own).alias("length"),
    )
    x = chunks.where(F.col("bases") != "").drop("name", "description").join(runs, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")) & (F.col("rec") == F.col("_r")))
    x = x.select("name", "description", "length", (F.col("skip") + F.col("off")).alias("at"), "bases")
    x = x.withColumn("name", F.coalesce("name", F.raise_error(F.lit("bases before the first header")).cast("string")))
    end = F.col("at") + F.length("bases")
    first = F.expr(f"greatest(at - {margin}, 0) div {tile}")
    final = F.least(F.expr(f"(at + length(bases) - 1 + {margin}) div {tile}"), F.expr(f"(length - 1) div {tile}"))
    x = x.select("*", F.explode(F.sequence(first, final)).alias("tile"))
    low = F.greatest(F.col("at"), F.col("tile") * tile - margin)
    high = F.least(end, (F.col("tile") + 1) * tile + margin)
    piece = F.substring(F.col("bases"), (low - F.col("at") + 1).cast("int"), (high - low).cast("int"))
    x = x.select("name", "description", "length", "tile", F.struct(low.alias("at"), piece.alias("bases")).alias("p")).where(F.length("p.bases") > 0)
    g = x.groupBy("name", "description", "length", "tile").agg(F.array_sort(F.collect_list("p")).alias("p"))
    text = F.array_join(F.transform("p", lambda y: y["bases"]), "")
    lead = F.greatest(F.lit(0), F.lit(margin) - F.col("tile") * tile).cast("int")
    return g.select("name", "description", "length", "tile", F.rpad(F.concat(F.repeat(F.lit("N"), lead), text), tile + 2 * margin, "N").alias("bases"))


def sequence_tiles(rows: DataFrame, tile: int = TILE, margin: int = MARGIN) -> DataFrame:
    """(name, seq) of short records, such as transcripts or probes -> the tiles of ``fasta_tiles``."""
    padded = F.concat(F.repeat(F.lit("N"), F.lit(margin)), F.col("seq"), F.repeat(F.lit("N"), F.lit(tile + margin)))
    x = rows.where(F.length("seq") > 0).select("name", F.lit(None).cast("string").alias("description"), F.length("seq").cast("bigint").alias("length"), padded.alias("seq"))
    x = x.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(length - 1) div {tile}"))).alias("tile"))
    return x.select("name", "description", "length", "tile", F.substring("seq", (F.col("tile") * tile + 1).cast("int"), F.lit(tile + 2 * margin)).alias("bases"))


# S7 -------------------------------------------------------------------------
def transcript_sequences(transcripts: DataFrame, tiles: DataFrame, tile: int = TILE, margin: int = MARGIN) -> DataFrame:
    """(gene_id, chrom, strand, spans) and reference tiles -> the same with ``seq``: the exons' bases in listed order,
    each reverse complemented on "-".

    An exon meets every tile that it overlaps (equi-join on chromosome and tile); the pieces of a transcript, bounded
    by its length, are put in order. An exon base that the reference does not have is missing from ``seq``; a
    transcript without any is kept with an empty one.
    """
    keys = ["gene_id", "chrom", "strand", "spans"]
    rows = transcripts.select(F.monotonically_increasing_id().alias("_row"), *keys)
    x = rows.select("*", F.posexplode(F.split("spans", ",")).alias("i", "s"))
    x = x.select("_row", *keys, "i", (F.split("s", "-", 2).getItem(0).cast("bigint") - 1).alias("a"), F.split("s", "-", 2).getItem(1).cast("bigint").alias("b"))
    x = x.select("*", F.explode(F.sequence(F.expr(f"a div {tile}"), F.expr(f"(b - 1) div {tile}"))).alias("t"))
    r = tiles.select(F.col("name").alias("_name"), F.col("tile").alias("_tile"), "length", "bases")
    x = x.join(r, (F.col("chrom") == F.col("_name")) & (F.col("t") == F.col("_tile")), "left")
    low = F.greatest(F.col("a"), F.col("t") * tile)
    high = F.least(F.col("b"), (F.col("t") + 1) * tile, F.col("length"))
    part = F.substring(F.col("bases"), (low - F.col("t") * tile + margin + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int"))
    minus = F.col("strand") == "-"
    piece = F.struct("i", F.when(minus, -low).otherwise(low).alias("at"), F.when(minus, reverse_complement(part)).otherwise(part).alias("bases"))
    g = x.groupBy("_row", *keys).agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return g.select(*keys, F.array_join(F.transform("p", lambda y: F.coalesce(y["bases"], F.lit(""))), "").alias("seq"))
