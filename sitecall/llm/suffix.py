"""Suffix dedup: byte strings of 100 that occur earlier are removed, by bucket-pointer refinement.

A suffix (a byte position) gets the identifier of its 8-gram bucket. Refinement replaces a bucket identifier
by that of the pair (own identifier, identifier of the suffix ``q`` later), which doubles the depth ``q``; each
update is used by the next one: 8, 16, 32, 64 bytes. Identifiers are hashes of the content instead of ranks,
so refinement needs no order between tasks and every task does it alone; what is shuffled is only what
must meet across documents:

1. Of the 69 suffixes at which a 100-byte string has a whole 32-gram, the one with the smallest identifier is
   its anchor; equal strings have equal anchors. Each anchor stands for a run of strings. Spark counts the
   32-gram buckets of the anchors; buckets with one member are finished.
2. Members of the other buckets are refined by the identifiers (at later offsets) of all bytes that their run
   covers. Members of one refined bucket have equal runs: all but the first are removed whole.
3. Buckets that fell apart into several refined ones can still share a part of their runs. The first member
   of each is refined again: first in blocks of 8 strings, whose bucket is the 93 bytes that they have in common,
   then, where a block's bucket fell apart too, to depth 100 string by string (64-byte identifiers 36 apart).
4. The byte ranges found are gathered by document and cut out.

The counts of 1 to 3 are hash aggregates with map-side partial sums, joined back to the members, so a passage
that a third of all documents share is never gathered in one task.

Defined cases: null text is empty; texts shorter than 100 bytes lose nothing; rows with the same id and text count
as one document, so neither copy removes the other; rows with the same id and other texts are documents of their own,
ordered by a hash of the text; rows with a null id neither remove nor lose anything;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import as_int64, chunks, doc_columns, ids_of, mix64, staged

DEPTH = 100
CORE = 32
BLOCK = 8
_WINDOWS = DEPTH - CORE + 1  # 69 suffixes of a string have a whole 32-gram in it
_PART = 1 << 19
_POS_BITS = np.uint64(20)
_POS = np.uint64((1 << 20) - 1)
_K1, _K2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of the bucket pair (a, b)."""
    x = a * _K1
    x += b
    x ^= x >> np.uint64(29)
    x *= _K2
    x ^= x >> np.uint64(32)
    return x


def bucket_ids(data: np.ndarray) -> list[np.ndarray]:
    """Identifiers of the 8-, 16-, 32- and 64-byte buckets of each suffix that is long enough."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    ids = [np.ndarray((max(n - 7, 0),), "<u8", padded.tobytes(), strides=(1,)).copy()]
    for q in (8, 16, 32):
        have = ids[-1]
        m = max(len(have) - q, 0)
        ids.append(_pair(have[:m], have[q : q + m]))
    return ids


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size, m = 1, x
    while size * 2 <= w:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    rest = w - size
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, core id, run id, lo, last, anchor): the runs of strings [lo, last] with one anchor, in every row."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < DEPTH:
        return none
    ids = bucket_ids(data)
    core, wide = ids[2], ids[3]
    key = (core & ~_POS) | np.arange(len(core), dtype=np.uint64)
    anchor = (_sliding_min(key, _WINDOWS) & _POS).astype(np.int64)  # of each string start
    lengths = np.diff(off)
    row_at = np.repeat(np.arange(len(lengths)), lengths)[: len(anchor)]
    start = np.arange(len(anchor))
    valid = start + DEPTH <= off[1:][row_at]
    s, a, r = start[valid], anchor[valid], row_at[valid]
    if len(s) == 0:
        return none
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (r[1:] != r[:-1])])
    first = np.flatnonzero(new)
    lo, last = s[first], s[np.append(first[1:], len(s)) - 1]
    p, row = a[first], r[first]
    size = last - lo + DEPTH
    run = _pair(_pair(wide[lo], wide[lo + (size - 64) // 2]), wide[last + DEPTH - 64])
    run = mix64(run ^ ((size << 8) | (p - lo)).astype(np.uint64) * _K1)
    return row, core[p], run, lo, last, p


def _parts(rb, data: np.ndarray, off: np.ndarray):
    """Row ranges of at most _PART bytes; a longer row is cut into parts that overlap by DEPTH - 1 bytes."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + _PART, side="right")) - 1
        if b > a:
            yield a, data[off[a] : off[b]], off[a : b + 1] - off[a], 0
            a = b
        else:
            lo, hi = int(off[a]), int(off[a + 1])
            for s in range(lo, hi, _PART):
                e = min(hi, s + _PART + DEPTH - 1)
                yield a, data[s:e], np.array([0, e - s]), s - lo
                if e == hi:
                    break
            a += 1


def _anchor_batches(batches):
    for rb, data, off in chunks(batches, "text"):
        ids = ids_of(rb)
        for base, part, at, shift in _parts(rb, data, off):
            row, core, run, lo, last, p = anchors(part, at)
            if len(row) == 0:
                continue
            begin = at[row]
            pos = ((lo - begin + shift) << 16) | ((last - lo) << 8) | (p - lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_int64(core)), pa.array(as_int64(run)), ids.take(pa.array(row + base, pa.int64())), pa.array(pos, pa.int64())], ["core", "run", "doc_id", "pos"]
            )


def _listed_runs(batches):
    """(ids, row, text stretch, its first byte, core, lo, last, anchor) of the listed runs of each document.

    Runs come in stretches of text, so that a long text never has all its identifiers at once.
    """
    for rb, data, off in chunks(batches, "text"):
        ids = ids_of(rb)
        runs = rb.column(rb.schema.get_field_index("runs"))
        flat = runs.flatten()
        core, pos = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        listed = np.concatenate([[0], np.cumsum(np.diff(runs.offsets.to_numpy()))])
        for i in range(rb.num_rows):
            text = data[off[i] : off[i + 1]]
            c, x = core[listed[i] : listed[i + 1]], pos[listed[i] : listed[i + 1]]
            order = np.argsort(x, kind="stable")
            c, x = c[order], x[order]
            lo, last, p = x >> 16, (x >> 16) + ((x >> 8) & 0xFF), (x >> 16) + (x & 0xFF)
            k = 0
            while k < len(x):
                e = max(k + 1, int(np.searchsorted(lo, int(lo[k]) + _PART)))
                a, b = int(lo[k]), int(last[k:e].max()) + DEPTH
                yield ids, i, text[a:b], a, c[k:e], lo[k:e], last[k:e], p[k:e]
                k = e


def _emitted(rows, names: list[str]):
    """Arrow batches of the (ids, row, columns) that come, some documents together."""
    held: list = []
    size = 0

    def flush():
        doc = pa.concat_arrays([ids.take(pa.array(np.full(len(cols[0]), i), pa.int64())) for ids, i, cols in held])
        return pa.RecordBatch.from_arrays([doc, *(pa.array(np.concatenate(z)) for z in zip(*(cols for _, _, cols in held)))], ["doc_id", *names])

    for ids, i, cols in rows:
        held.append((ids, i, cols))
        size += len(cols[0])
        if size > 100_000:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... n values of each."""
    return np.repeat(lo, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def _block_batches(batches):
    """Each listed run cut into blocks of BLOCK strings by their distance to the anchor.

    ``core`` becomes the identifier of the bytes that all strings of the block have, ``run`` that of all bytes they cover.
    """

    def rows():
        for ids, i, text, a, core, lo, last, p in _listed_runs(batches):
            wide = bucket_ids(text)[3]
            far, near = (p - lo) // BLOCK, (p - last) // BLOCK
            n = far - near + 1
            j = _ranges(near, n)
            lo, last, p, core = (np.repeat(z, n) for z in (lo, last, p, core))
            lo, last = np.maximum(lo, p - j * BLOCK - BLOCK + 1), np.minimum(last, p - j * BLOCK)
            at = p - j * BLOCK - a
            inner = _pair(_pair(wide[at], wide[at + DEPTH - BLOCK + 1 - 64]), core.view(np.uint64) ^ (j + 1).astype(np.uint64) * _K1)
            outer = _pair(wide[lo - a], wide[last - a + DEPTH - 64])
            outer = mix64(outer ^ (((last - lo) << 8) | (p - lo)).astype(np.uint64) * _K1)
            yield ids, i, (as_int64(inner), as_int64(outer), (lo << 16) | ((last - lo) << 8) | (p - lo))

    yield from _emitted(rows(), ["core", "run", "pos"])


def _string_batches(batches):
    """Depth-100 identifiers of every string of the listed runs of each document."""

    def rows():
        for ids, i, text, a, core, lo, last, p in _listed_runs(batches):
            wide = bucket_ids(text)[3]
            n = last - lo + 1
            start = _ranges(lo, n)
            away = np.repeat(p, n) - start
            string = mix64(_pair(wide[start - a], wide[start - a + DEPTH - 64]) ^ away.astype(np.uint64) * _K1)
            yield ids, i, (np.repeat(core, n), as_int64(string), start)

    yield from _emitted(rows(), ["core", "string", "start"])


def _later(members: DataFrame, keys: list[str], place: str) -> tuple[DataFrame, DataFrame]:
    """(first member of each group by (doc_id, place), the members after the first)."""
    firsts = members.groupBy(*keys).agg(F.min(F.struct("doc_id", place)).alias("first"), F.count("*").alias("n"))
    more = staged(firsts.filter("n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys], "first"), "suffix-more")  # joined as a table, so that hot groups can be split
    cond = [members[k] == more[f"_{k}"] for k in keys]
    later = members.join(more, cond).filter((F.col("first.doc_id") != F.col("doc_id")) | (F.col(f"first.{place}") != F.col(place)))
    return firsts, later.select("doc_id", place)


def _resolved(members: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(byte ranges of members whose whole run occurs earlier, the runs that must be refined as lists by document).

    Buckets (``core``) with one member are finished. Of those with more, the members with equal ``run`` after the
    first are ranges; if a bucket fell apart into several runs, the first of each is refined further.
    """
    shared = members.groupBy("core").agg(F.count("*").alias("n"), F.min("run").alias("a"), F.max("run").alias("b")).filter("n > 1")
    shared = staged(shared.select(F.col("core").alias("_core"), (F.col("a") != F.col("b")).alias("split")), f"{name}-shared")
    alive = staged(members.join(shared, F.col("core") == F.col("_core")).drop("_core"), name)
    firsts, later = _later(alive, ["core", "split", "run"], "pos")
    lo = F.shiftright("pos", 16)
    ranges = later.select("doc_id", lo.alias("lo"), (lo + F.shiftright("pos", 8).bitwiseAND(255) + DEPTH).alias("hi"))
    open_runs = firsts.filter("split").groupBy("first.doc_id").agg(F.collect_list(F.struct("core", "first.pos")).alias("runs"))
    return ranges, open_runs


def _document() -> Column:
    """The key of a document: its id, and a hash of its text for ids that several texts have."""
    return F.struct("doc_id", F.xxhash64("text").alias("h"))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, lo, hi: byte ranges whose every 100-byte string also starts earlier (ranges of a document may overlap).

    Here ``doc_id`` is the key of ``_document``.
    """
    rows = doc_columns(docs, "doc_id", "text").filter("doc_id is not null and octet_length(text) >= 100").withColumn("doc_id", _document())
    kind = dict(rows.dtypes)["doc_id"]
    members = rows.mapInArrow(_anchor_batches, f"core long, run long, doc_id {kind}, pos long")
    whole, open_runs = _resolved(members, "suffix-buckets")
    members = rows.join(open_runs, "doc_id").mapInArrow(_block_batches, f"doc_id {kind}, core long, run long, pos long")
    blocks, open_runs = _resolved(members, "suffix-blocks")
    strings = rows.join(open_runs, "doc_id").mapInArrow(_string_batches, f"doc_id {kind}, core long, string long, start long")
    _, later = _later(staged(strings, "suffix-strings"), ["core", "string"], "start")
    return whole.unionByName(blocks).unionByName(later.select("doc_id", F.col("start").alias("lo"), (F.col("start") + DEPTH).alias("hi")))


def _covered(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the ranges as maximal runs."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return lo[at], reach[np.append(at[1:], len(lo)) - 1]


def _cut_batches(passed: tuple[str, ...], result: str):
    def run(batches):
        for rb, data, off in chunks(batches, "text"):
            ranges = rb.column(rb.schema.get_field_index("ranges"))
            flat = ranges.flatten()
            lo, hi = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            at = np.concatenate([[0], np.cumsum(np.diff(ranges.offsets.to_numpy()))])  # a null list is empty
            kept, n_removed, n_spans = [], [], []
            for i in range(rb.num_rows):
                text = data[off[i] : off[i + 1]]
                if at[i] < at[i + 1]:
                    a, b = _covered(lo[at[i] : at[i + 1]], hi[at[i] : at[i + 1]])
                    flag = np.zeros(len(text) + 1, np.int8)
                    flag[a] += 1
                    flag[b] -= 1
                    text = text[np.cumsum(flag[:-1]) == 0]
                    n_removed.append(int((b - a).sum()))
                    n_spans.append(len(a))
                else:
                    n_removed.append(0)
                    n_spans.append(0)
                kept.append(text.tobytes())
            last = pa.array([hashlib.sha256(k).hexdigest() if result == "kept_sha256" else k.decode("utf-8", "ignore") for k in kept], pa.string())
            sizes = [pa.array(np.diff(off), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(ids_of(rb, c) for c in passed), *sizes, last], [*passed, "n_bytes", "n_removed", "n_spans", result])

    return run


def remove_repeats(docs: DataFrame, passed: tuple[str, ...] = ("doc_id",), result: str = "kept_sha256") -> DataFrame:
    """``passed`` columns, n_bytes, n_removed, n_spans and ``kept_sha256`` of the kept bytes or the text ``kept``.

    As text, the rest of a character that a removal cut through goes too.
    """
    found = staged(repeated_ranges(docs), "suffix-ranges")
    ranges = found.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    rows = doc_columns(docs, *dict.fromkeys([*passed, "text"])).withColumn("_document", _document())
    rows = rows.alias("d").join(ranges.alias("r"), F.col("d._document") == F.col("r.doc_id"), "left").drop("_document")
    rows = rows.select("d.*", F.coalesce("ranges", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("ranges"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*passed).schema)
    return rows.mapInArrow(_cut_batches(passed, result), f"{schema}, n_bytes long, n_removed long, n_spans long, {result} string")
