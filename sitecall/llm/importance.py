"""Importance resampling: documents drawn by the ratio of two hashed n-gram models.

Words and word pairs (lower case) are hashed to ``BUCKETS`` buckets. One bag-of-buckets model is counted over the
target texts and one over all raw texts, both smoothed. A document's log weight is the sum of the log ratios
of its n-grams; with ``stretch`` (off), their mean times that many n-grams, whatever the text's length. Gumbel noise of a seeded hash of the id is added, and the top k keys are drawn: a sample without
replacement in proportion to the weights.

The k-th largest key is found by counting keys in ever finer ranges (at most ``RANGES`` counts a round go to the
driver); only the keys of the last range are ranked, so no sort of all documents is needed.

Defined cases: null or empty text has log weight 0; with no target texts all weights are 0, so the draw is
uniform; equal keys are drawn by smaller id (more than RANGES rows of one key by row number); rows with the same id have the same noise; a null id counts as the
empty text; k = 0 for an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecall.llm.common import LOWER_AZ, chunks, doc_columns, ids_of, mix64, span_hashes, staged, word_spans

BUCKETS = 1 << 16
KEEP = 0.85
RANGES = 4096
SEED = 23


def _row_buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, row of each n-gram)."""
    low = LOWER_AZ[data]
    s, e, woff = word_spans(low, off)
    w = span_hashes(low, s, e)
    row = np.repeat(np.arange(len(off) - 1), np.diff(woff))
    pair = mix64(w[:-1] * np.uint64(3) + w[1:]) if len(w) else w
    same = row[1:] == row[:-1]
    grams = np.concatenate([w, pair[same] if len(w) else pair])
    return (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([row, row[1:][same]])


def _count_batches(batches):
    total = np.zeros(BUCKETS, np.int64)
    for _, data, off in chunks(batches, "text"):
        total += np.bincount(_row_buckets(data, off)[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """N-grams of all texts by bucket; each task sends at most BUCKETS sums."""
    rows = doc_columns(texts, "text").mapInArrow(_count_batches, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    model = (raw + 1) / (raw.sum() + len(raw))
    held = 0.05 * target.sum() + 1  # the raw model smooths the target's rare buckets
    return np.log((target + held * model) / (target.sum() + held)) - np.log(model)


def _weight_batches(ratio: np.ndarray, stretch: float | None):
    def run(batches):
        for rb, data, off in chunks(batches, "text"):
            bucket, row = _row_buckets(data, off)
            n = np.bincount(row, minlength=rb.num_rows)
            weight = np.bincount(row, weights=ratio[bucket], minlength=rb.num_rows)
            if stretch is not None:
                weight = weight / np.maximum(n, 1) * stretch
            yield pa.RecordBatch.from_arrays([ids_of(rb), pa.array(n, pa.int64()), pa.array(weight, pa.float64())], ["doc_id", "n_grams", "log_weight"])

    return run


def top_k(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Mark the k rows with the largest (key, smallest doc_id) as ``kept``; of many rows with one key, the last of ``_row``."""
    low, high, above = rows.agg(F.min(key), F.max(key)).first() + (0,)
    if k <= 0 or low is None:
        return rows.withColumn("kept", F.lit(False))
    last = F.col(key).between(low, high)
    while high > low:
        width = (high - low) / RANGES
        if width <= abs(high) * 1e-15:
            break
        part = F.least(F.floor((F.col(key) - low) / width), F.lit(RANGES - 1)).cast("int")
        counts = {r["p"]: r for r in rows.filter(last).groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min(key).alias("a"), F.max(key).alias("b")).collect()}
        for p in sorted(counts, reverse=True):
            if above + counts[p]["n"] >= k:
                break
            above += counts[p]["n"]
        else:
            return rows.withColumn("kept", F.lit(True))  # fewer than k rows
        low, high = counts[p]["a"], counts[p]["b"]
        last = F.col(key).between(low, high)
        if counts[p]["n"] <= RANGES:
            break
    if low == high and key != "_row" and rows.filter(last).count() > RANGES:  # many rows of one id and text: cut by their unique numbers
        return rows.filter(~last).withColumn("kept", F.col(key) > high).unionByName(top_k(rows.filter(last), "_row", k - above))
    ranked = rows.filter(last).withColumn("_r", F.row_number().over(Window.orderBy(F.desc(key), F.asc_nulls_first("doc_id"))))  # about RANGES rows
    ranked = ranked.withColumn("kept", F.col("_r") <= k - above).drop("_r")
    return rows.filter(~last).withColumn("kept", F.col(key) > high).unionByName(ranked)


def resample(docs: DataFrame, target_ids: DataFrame, keep: float = KEEP, seed: int = SEED, stretch: float | None = None) -> DataFrame:
    """doc_id, n_grams, log_weight, key and kept of every document; k is ``keep`` times the number of documents."""
    rows = doc_columns(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    # a hash join on shuffled sides at every size: the ids grow with the corpus, so they are never to be broadcast
    target = rows.join(target_ids.select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    ratio = log_ratio(bucket_counts(target), bucket_counts(rows))
    weighed = rows.mapInArrow(_weight_batches(ratio, stretch), f"doc_id {kind}, n_grams long, log_weight double")
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 11)
    uniform = (h.cast("double") + 0.5) / float(1 << 53)
    weighed = weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))).withColumn("_row", F.monotonically_increasing_id())
    keyed = staged(weighed, "importance-keys")
    return top_k(keyed, "key", math.floor(keep * keyed.count())).drop("_row")
