"""Mixing sources to target weights by subset-sum budget fitting.

Sources, in code point order with null last, weigh 5, 2, 1, 5, 2, 1, ... and share the words of the whole
corpus. A target stops at 3 times its source's size and the excess is shared again by weight until no
target is above. A source then takes every document ``floor(target / size)`` times, and a subset of its
documents for the rest of the budget:

1. Spark counts the documents of each source by exact length.
2. Per source, the counts (one row per distinct length) are fitted: an equal share of every length first,
   then longest first while the budget is more than the longest length, and the last words by a bounded
   knapsack over the lengths still left (dynamic programming on bit sets, each length's count in powers
   of two), and one document more where that comes nearer from above. The result is how many documents of each length to take.
3. Spark picks that many documents of each length in the order of a seeded hash. Large groups of one
   source and length are cut into buckets of that hash of about ``BUCKET`` rows: whole buckets are taken
   by running totals of their counts, and only the one that the limit falls in is ranked row by row.

Defined cases: null or empty text has size 0 and takes 0; a null source is a source of its own; an empty
table gives an empty result; rows that repeat (same id and text) are separate rows, each taken or not on
its own hash of id and occurrence; other columns are ignored; the same seed gives the same choice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecall.llm.common import chunks, doc_columns, ids_of, local_rows, staged, word_spans

WEIGHTS = (5, 2, 1)
CEILING = 3
BUCKET = 4096
MAX_SOURCES = 100_000  # the table of sources goes to the driver; more than this is an error


def _size_batches(passed: tuple[str, ...]):
    def run(batches):
        for rb, data, off in chunks(batches, "text"):
            _, _, woff = word_spans(data, off)
            yield pa.RecordBatch.from_arrays([*(ids_of(rb, c) for c in passed), pa.array(np.diff(woff), pa.int64())], [*passed, "size"])

    return run


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of each text."""
    rows = doc_columns(docs, "doc_id", "source", "text")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_size_batches(("doc_id", "source")), f"doc_id {kinds['doc_id']}, source {kinds['source']}, size long")


def share_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> dict[str | None, float]:
    """Target words of each source; sums to all words unless every source is at its ceiling."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target: dict[str | None, float] = {}
    free, left = list(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > ceiling * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = float(ceiling * sizes[s])
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in target]
    return target


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to ``budget`` as found."""
    take = np.zeros(len(lengths), np.int64)
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.copy()
    if budget <= 0:
        return take
    whole_budget = budget
    take = (counts * (budget / whole)).astype(np.int64)
    budget -= int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):  # longest first, down to a budget of about one document
        length = int(lengths[i])
        if length == 0 or budget < length:
            continue
        reserve = 2 * int(lengths.max())  # words that the dynamic programming gets
        n = min(int(counts[i] - take[i]), max(0, budget - reserve) // length)
        take[i] += n
        budget -= n * length
    # bounded knapsack: bit b of `reach` says that b words can be made from the items so far
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in np.argsort(lengths, kind="stable"):
        length, left = int(lengths[i]), int(counts[i] - take[i])
        if length == 0 or length > budget:
            continue
        left, size = min(left, budget // length), 1
        while left > 0 and not reach >> budget & 1:
            n = min(size, left)
            after = (reach | reach << (n * length)) & mask
            if after != reach:
                steps.append((i, n, reach))
                reach = after
            left -= n
            size *= 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * int(lengths[i])
    # one more document if that comes nearer from above
    gap = whole_budget - int((take * lengths).sum())
    left = np.flatnonzero((take < counts) & (lengths < 2 * gap))
    if len(left):
        take[left[np.argmin(np.abs(lengths[left] - gap))]] += 1
    return take


def _fit_source(budgets: dict[str | None, int]):
    def run(pdf):
        source = pdf["source"].iloc[0]
        out = pdf.sort_values("size").reset_index(drop=True)
        budget = budgets.get(source if isinstance(source, str) else None, 0)
        out["take"] = fit_lengths(out["size"].to_numpy(np.int64), out["n"].to_numpy(np.int64), budget)
        return out[["source", "size", "n", "take"]]

    return run


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words that the mix takes of the document, repeats counted), copies."""
    spark = docs.sparkSession
    sized = staged(document_sizes(docs), "mix-sizes")
    source_kind = dict(sized.dtypes)["source"]
    lengths = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-lengths")
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["source"]: int(r["words"]) for r in totals}
    target = share_targets(sizes, weights, ceiling)
    whole = {s: int(target[s] // n) if n else 0 for s, n in sizes.items()}
    rest = {s: int(target[s] - whole[s] * n) if n else 0 for s, n in sizes.items()}

    plan = lengths.groupBy("source").applyInPandas(_fit_source(rest), f"source {source_kind}, size long, n long, take long")
    plan = staged(plan.withColumn("buckets", F.ceil(F.col("n") / BUCKET)), "mix-plan").alias("p")
    same = sized["source"].eqNullSafe(F.col("p.source")) & (sized["size"] == F.col("p.size"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    rows = sized.join(plan, same).select(sized["doc_id"], sized["source"], sized["size"], "p.take", "p.buckets")
    rows = rows.withColumn("h", order).withColumn("bucket", F.pmod("h", "buckets"))
    some = rows.filter("take > 0")
    # buckets of a group, in order: how many of its documents come before and in each (one row per BUCKET documents)
    in_bucket = some.groupBy("source", "size", "take", "bucket").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    quota = in_bucket.withColumn("quota", F.least(F.col("m"), F.col("take") - F.coalesce(before, F.lit(0)))).filter("quota > 0")
    quota = quota.select("source", "size", "bucket", "quota").alias("q")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id")))
    same = ranked["source"].eqNullSafe(F.col("q.source")) & (ranked["size"] == F.col("q.size")) & (ranked["bucket"] == F.col("q.bucket"))
    chosen = ranked.join(quota, same, "left").select(ranked["doc_id"], ranked["source"], ranked["size"], F.coalesce(F.col("rank") <= F.col("quota"), F.lit(False)).alias("extra"))
    mixed = chosen.unionByName(rows.filter("take <= 0").select("doc_id", "source", "size", F.lit(False).alias("extra")))
    facts = local_rows(spark, [(s, sizes[s], float(target[s]), whole[s]) for s in sizes], f"source {source_kind}, source_size long, target double, whole long").alias("f")
    out = mixed.join(F.broadcast(facts), mixed["source"].eqNullSafe(F.col("f.source")))  # at most MAX_SOURCES rows
    copies = F.col("whole") + F.col("extra").cast("long")
    return out.select(mixed["doc_id"], mixed["source"], mixed["size"], "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))
