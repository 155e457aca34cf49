"""Language ID by rank-order profiles.

A profile is the ranked list of the most frequent letter n-grams (1 to 3 letters, words padded on both
sides). A document's own ranked list is compared with every language's by the out-of-place distance: the
sum of the rank differences of the document's n-grams, ``K`` for an n-gram that the profile lacks.

Training counts every n-gram of every training document; each task adds up its own counts first, so the
shuffle carries one row per task, language and n-gram. Profiles hold ``K`` n-grams for each language and
the number of languages is checked against ``MAX_LANGUAGES`` before they go to the driver.

Defined cases: null text or text without a letter gives ``und`` with score 0; equal distances go to the
language whose code sorts first; rows with a null ``lang`` train nothing; with no training rows every
document is ``und``; repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecall.llm.common import chunks, doc_columns, ids_of, staged

K = 300
MAX_LANGUAGES = 1000
UNKNOWN = "und"


@functools.cache
def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The 1-, 2- and 3-gram codes at each place of the padded letter sequence (0: none) and the rows' offsets."""
    joined = np.insert(data, off[1:], 32)  # a separator after each row keeps rows apart
    off = off + np.arange(len(off))
    points = np.frombuffer(joined.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    at = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])[off]
    letters = _letter_table()[points]
    keep = letters != 0
    pad = np.zeros(len(keep), bool)
    pad[1:] = ~keep[1:] & keep[:-1]  # one pad after each word; the pad before it is the one of the word before
    kept = keep | pad
    seq = np.concatenate([[0], letters[kept]])
    rows = np.concatenate([[0], np.cumsum(kept)])[at] + 1
    one = seq
    b = np.concatenate([seq[1:], [0]])
    c = np.concatenate([b[1:], [0]])
    two = np.where((seq != 0) | (b != 0), ((seq << 21) | b) << 21 | 1, 0)
    three = np.where(b != 0, (seq << 42) | (b << 21) | c, 0)
    return [one, two, three], rows, rows


def _row_codes(codes: list[np.ndarray], a: int, b: int) -> np.ndarray:
    """All n-gram codes of the row whose letters and pads are at ``a:b``; the pad before its first word is at a-1."""
    if b <= a:
        return np.zeros(0, np.int64)
    one, two, three = codes
    g = np.concatenate([one[a:b], two[a - 1 : b - 1], three[a - 1 : b - 2]])
    return g[g != 0]


def _counted(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g.sort()
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    return g[first], np.diff(np.append(first, len(g)))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _count_batches(batches):
    have: dict[str, list] = {}
    for rb, data, off in chunks(batches, "text"):
        codes, rows, _ = _grams(data, off)
        langs = ids_of(rb, "lang").to_pylist()
        by: dict[str, list[int]] = {}
        for i, lang in enumerate(langs):
            by.setdefault(lang, []).append(i)
        for lang, members in by.items():
            got = _counted(np.concatenate([_row_codes(codes, rows[i], rows[i + 1]) for i in members]))
            have.setdefault(lang, []).append(got)
            if len(have[lang]) >= 8:
                have[lang] = [_merge(have[lang])]
    for lang, parts in have.items():
        code, n = _merge(parts)
        for a in range(0, len(code), 100_000):
            c, m = code[a : a + 100_000], n[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c, pa.int64()), pa.array(m, pa.int64())], ["lang", "gram", "n"])


def train_profiles(docs: DataFrame, k: int = K) -> dict[str, list[int]]:
    """Ranked n-gram codes of each language, most frequent first (ties by code), counted over all of ``docs``."""
    rows = doc_columns(docs, "text", "lang").filter("lang is not null and text is not null")
    counts = rows.mapInArrow(_count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    top = staged(counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k), "language-profiles")
    if top.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "place").collect():  # at most MAX_LANGUAGES * k rows
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def _predictor(profiles: dict[str, list[int]], k: int, passed: tuple[str, ...]):
    langs = sorted(profiles)
    tables = []
    for lang in langs:
        code = np.array(profiles[lang], np.int64)
        order = np.argsort(code)
        tables.append((code[order], order))

    def best(g: np.ndarray) -> tuple[str, float]:
        code, n = _counted(g)
        if len(code) == 0 or not langs:
            return UNKNOWN, 0.0
        code = code[np.argsort(-n, kind="stable")[:k]]
        places = np.arange(len(code))
        distance = []
        for known, rank in tables:
            at = np.minimum(np.searchsorted(known, code), len(known) - 1)
            distance.append(int(np.where(known[at] == code, np.minimum(np.abs(rank[at] - places), k), k).sum()))
        i = int(np.argmin(distance))
        return langs[i], 1.0 - distance[i] / (k * len(code))

    def run(batches):
        for rb, data, off in chunks(batches, "text"):
            codes, rows, _ = _grams(data, off)
            got = [best(_row_codes(codes, rows[i], rows[i + 1])) for i in range(rb.num_rows)]
            lang, score = pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())
            yield pa.RecordBatch.from_arrays([*(ids_of(rb, c) for c in passed), lang, score], [*passed, "lang_pred", "score"])

    return run


def identify_language(docs: DataFrame, profiles: dict[str, list[int]], k: int = K, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns with ``lang_pred`` and ``score`` (1 - distance / largest possible distance) of each row's text."""
    rows = doc_columns(docs, *dict.fromkeys([*passed, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in passed)
    return rows.mapInArrow(_predictor(profiles, k, passed), f"{schema}, lang_pred string, score double")


def with_language(docs: DataFrame, is_training: Column, k: int = K) -> DataFrame:
    """Learn from the rows of ``docs`` where ``is_training`` and predict for all of them: doc_id, lang_pred, score."""
    return identify_language(docs, train_profiles(docs.filter(is_training), k), k)
