"""Quality rules under weak supervision.

Every rule casts its vote, good or bad, or abstains on each document. The documents are counted by their vote pattern in
Spark (at most 2 ** number of rules patterns, whatever the corpus), and expectation-maximisation over those
counts estimates, without labels, each rule's accuracy, the probability that a vote it casts is right; an abstention says nothing. A document's verdict is the posterior probability
of being good given its votes, and it stays if that is at least one half.

Defined cases: null or empty text has no words (all counts 0) and fails the base rule; the verdict of a row
depends on its text and the table's pattern counts alone, so repeated rows get the same verdict; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import chunks, doc_columns, ids_of, shingle_hashes, span_hashes, staged, word_spans

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper_words", "n_marked_words", "n_exclaim"]


def _per_row(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of true places between each pair of offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(flag)])[off])


def _repeats(h: np.ndarray) -> np.ndarray:
    """True where an equal value occurs at another place too."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = np.zeros(len(h), bool)
    eq = s[1:] == s[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    out = np.zeros(len(h), bool)
    out[order] = same
    return out


def text_counts(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The COUNTS of each row."""
    s, e, woff = word_spans(data, off)
    n_words = np.diff(woff)
    continuation = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80)])
    inside = np.concatenate([[0], np.cumsum(e - s)])
    word_chars = np.diff(inside[woff]) - np.diff(continuation[off])
    wh = span_hashes(data, s, e)
    # lines
    breaks = np.flatnonzero(data == 10)
    filled = off[1:] > off[:-1]
    lo = np.sort(np.concatenate([off[:-1][filled], breaks + 1]))
    hi = np.sort(np.concatenate([off[1:][filled], breaks]))
    at_end = np.isin(lo, off[1:]) & (lo == hi)  # an empty line after a row's last break begins where the next row begins
    row = np.searchsorted(off, lo, side="right") - 1
    worded = np.searchsorted(s, lo) < np.searchsorted(s, hi)
    worded &= ~at_end
    lo, hi, row = lo[worded], hi[worded], row[worded]
    lh = span_hashes(data, lo, hi)
    order = np.lexsort((lh, row))
    again = (row[order][1:] == row[order][:-1]) & (lh[order][1:] == lh[order][:-1])
    rows = len(off) - 1
    n_dup = np.bincount(row[order][1:][again], minlength=rows) if len(row) else np.zeros(rows, np.int64)
    n_lines = np.bincount(row, minlength=rows) if len(row) else np.zeros(rows, np.int64)
    # repeated windows and distinct words
    sh, soff = shingle_hashes(wh, woff, WINDOW)
    n_repeat = np.zeros(rows, np.int64)
    n_distinct = np.zeros(rows, np.int64)
    for i in range(rows):
        a, b = woff[i], woff[i + 1]
        if a == b:
            continue
        w = np.sort(wh[a:b])
        n_distinct[i] = 1 + np.count_nonzero(w[1:] != w[:-1])
        if b - a <= WINDOW:
            continue
        twice = _repeats(sh[soff[i] : soff[i + 1]])
        if twice.any():
            edge = np.zeros(b - a + 1, np.int64)
            at = np.flatnonzero(twice)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
            n_repeat[i] = np.count_nonzero(np.cumsum(edge[:-1]))
    has = lambda table: np.concatenate([[0], np.cumsum(table[data])])
    upper, lower = has(_UPPER), has(_LOWER)
    capital = (upper[e] - upper[s] > 1) & (lower[e] == lower[s])
    marked = _MARK[data[e - 1]] if len(e) else np.zeros(0, bool)
    return [n_words, word_chars, _per_row(_SYMBOL[data], off), n_dup, n_repeat, n_lines, n_distinct, _per_row(capital, woff), _per_row(marked, woff), _per_row(data == ord("!"), off)]


def _count_batches(batches):
    for rb, data, off in chunks(batches, "text"):
        yield pa.RecordBatch.from_arrays([ids_of(rb), *(pa.array(c, pa.int64()) for c in text_counts(data, off))], ["doc_id", *COUNTS])


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the COUNTS of every whole text."""
    rows = doc_columns(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_count_batches, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def rules() -> dict[str, tuple[str, Column]]:
    """Rule name -> (its vote, b for bad or g for good; the condition to cast it). Otherwise it abstains."""
    mean, marked = _share("word_chars", "n_words"), _share("n_marked_words", "n_words")
    return {
        "symbols": ("b", _share("n_symbols", "n_words") > 0.1),
        "dup_lines": ("b", _share("n_dup_lines", "n_lines") > 0.3),
        "repeats": ("b", _share("n_repeat_words", "n_words") > 0.2),
        "monotony": ("b", (F.col("n_words") < 2000) & (_share("n_distinct", "n_words") < 0.2)),
        "word_length": ("b", (mean < 3) | (mean > 12)),
        "capitals": ("b", (_share("n_upper_words", "n_words") > 0.3) & (F.col("n_words") >= MIN_WORDS)),
        "exclaim": ("b", _share("n_exclaim", "n_words") > 0.1),
        "short": ("b", F.col("n_words") < MIN_WORDS),
        "prose": ("g", marked.between(0.02, 0.5) & mean.between(4, 10) & (_share("n_symbols", "n_words") < 0.02)),
        "sentences": ("g", (F.col("n_marked_words") >= 3) & (_share("n_upper_words", "n_words") < 0.2) & (F.col("n_symbols") == 0)),
    }


def vote_pattern() -> Column:
    """One character a rule: g good, b bad, - abstains."""
    return F.concat(*[F.when(cast, vote).otherwise("-") for vote, cast in rules().values()])


#: The odds of a document without any vote are even: only votes speak. A rule's accuracy starts at, and is held towards, this value with the weight of a hundredth of the documents.
EXPECTED_ACCURACY = 0.95


def fit_votes(counts: dict[str, int], rounds: int = 500) -> tuple[dict[str, float], np.ndarray]:
    """Expectation-maximisation over vote patterns: (posterior of good by pattern, accuracy of each rule).

    A rule's accuracy is the probability that a vote it casts is right; an abstention says nothing.
    """
    if not counts:
        return {}, np.zeros(0)
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    votes = np.array([[{"g": 1, "b": -1, "-": 0}[c] for c in p] for p in patterns])
    right = np.full(votes.shape[1], EXPECTED_ACCURACY)
    hold = 0.01 * n.sum() + 1
    post = np.zeros(len(n))
    for _ in range(rounds):
        log = votes @ (np.log(right) - np.log1p(-right))
        post = 1 / (1 + np.exp(-np.clip(log, -500, 500)))
        agree = np.where(votes > 0, post[:, None], 1 - post[:, None]) * (votes != 0) * n[:, None]
        cast = (votes != 0) * n[:, None]
        new = np.clip((agree.sum(0) + EXPECTED_ACCURACY * hold) / (cast.sum(0) + hold), 0.5, 0.9999)
        moved, right = float(np.abs(new - right).max()), new
        if moved < 1e-10:
            break
    return dict(zip(patterns, post.tolist())), right


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, votes, posterior and kept of every document."""
    spark = docs.sparkSession
    counted = staged(document_counts(docs).withColumn("votes", vote_pattern()), "quality-counts")
    seen = {r["votes"]: r["n"] for r in counted.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # at most 2 ** number of rules rows
    posterior, _ = fit_votes(seen)
    known = spark.createDataFrame(list(posterior.items()), "votes string, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = counted.join(F.broadcast(known), "votes").withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
