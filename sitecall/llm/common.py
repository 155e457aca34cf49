"""Helpers shared by the text operators: staged tables, Arrow text views and vectorised hashing.

All per-task work goes through chunks of half a MB of text (``CHUNK_BYTES``), so a task's memory is bounded
by that size (or by its longest single document), never by its partition; memory that a longer document or a
finished task has freed goes back to the system, since the workers live on through later stages.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sitecall.session import unique_scratch

CHUNK_BYTES = 1 << 19

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU libc has it

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def prepare(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of a finished query (the staged tables hold what is still needed), and
    hand texts to Python in small Arrow batches, so that a task's memory does not depend on their number."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    prepare(spark)
    path = unique_scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a relation of the JVM. ``createDataFrame`` of a list is an RDD of pickled rows, for
    which every executor starts a second set of Python workers that live on beside those of the operators."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [()] * len(kinds)
    table = pa.Table.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, kinds)], names=kinds.names)
    return spark.createDataFrame(table, kinds)


def doc_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns of the input can clash with none of an operator's."""
    return docs.select(*[F.col(n) for n in names])


def bucket5(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


# ---- Arrow text ----------------------------------------------------------------------------------


def text_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, row offsets int64 starting at 0); null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0 or col.null_count == n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def give_back() -> None:
    """Return freed memory of this Python worker to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into row ranges of at most ``limit`` text bytes (one longer row makes its own range)."""
    for rb in batches:
        if rb.num_rows == 0:
            continue
        data, off = text_view(rb.column(rb.schema.get_field_index(column)))
        a, n = 0, rb.num_rows
        while a < n:
            b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
            b = min(n, max(b, a + 1), a + 20_000)
            yield rb.slice(a, b - a), data[off[a] : off[b]], off[a : b + 1] - off[a]
            if off[b] - off[a] > limit:
                give_back()
            a = b
    give_back()


def ids_of(rb: pa.RecordBatch, column: str = "doc_id") -> pa.Array:
    return rb.column(rb.schema.get_field_index(column))


# ---- hashing -------------------------------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64) on a uint64 array; works in place on its own copy."""
    x = x ^ (x >> np.uint64(30))
    x *= _C1
    x ^= x >> np.uint64(27)
    x *= _C2
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(B**i, B**-i) mod 2**64 for i < n."""
    have = _POWERS.get("p")
    if have is not None and len(have) >= n:
        return have[:n], _POWERS["q"][:n]
    size = max(n, CHUNK_BYTES + 1)
    p = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, np.uint64)]), dtype=np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    q = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse, np.uint64)]), dtype=np.uint64)
    if size <= CHUNK_BYTES * 2:
        _POWERS["p"], _POWERS["q"] = p, q
    return p[:n], q[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``data[start:end]`` (position-independent)."""
    p, q = _powers(len(data) + 1)
    pre = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * p[: len(data)], out=pre[1:])
    return mix64((pre[end] - pre[start]) * q[start] + (end - start).astype(np.uint64) * _C2)


# ---- words ---------------------------------------------------------------------------------------

#: The separators of the word rule ``[^\x20\x09-\x0D]+`` as a byte table (UTF-8 continuation bytes are never separators).
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word offsets per row) of all words; words never cross rows."""
    rows = len(off) - 1
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(rows + 1, np.int64)
    ok = ~SEPARATOR[data]
    first = ok.copy()
    first[1:] &= ~ok[:-1]
    last = ok.copy()
    last[:-1] &= ~ok[1:]
    filled = off[1:] > off[:-1]
    a, b = off[:-1][filled], off[1:][filled] - 1
    first[a] = ok[a]
    last[b] = ok[b]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, off)


def shingle_hashes(word_hash: np.ndarray, woff: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per row) of each row's k-word shingles in text order.

    A row with 1..k-1 words has one shingle, its whole word sequence; a row without words has none.
    """
    n = np.diff(woff)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    soff = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(woff[:-1], count) + (np.arange(soff[-1]) - np.repeat(soff[:-1], count))
    length = np.repeat(np.minimum(n, k), count)
    padded = np.concatenate([word_hash, np.zeros(k, np.uint64)])
    h = length.astype(np.uint64)
    for j in range(k):
        h = h * np.uint64(_BASE) + np.where(j < length, padded[first + j], np.uint64(0))
    return mix64(h), soff


def as_int64(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
