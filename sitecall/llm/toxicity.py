"""Toxicity by compression distance.

Two zstandard dictionaries are trained on the labelled sample: one on windows of ordinary text, one on the parts
of the toxic texts that ordinary texts do not share: the runs of ``MER`` byte strings that occur in many different
contexts and at ``MIN_RATIO`` times the ordinary rate (a string counts once for each pair of 8 bytes around it, so
copies of one text count once). Runs are cut without regard to words, so stems and inflected forms count. A window of a document is compressed twice, with
the ordinary dictionary alone and with the toxic dictionary's content put before it; the bytes that the
toxic one saves are its distance. The largest, the mean and the share of windows that save at least
``HIT_BYTES`` are turned into a score by a logistic curve that is calibrated on labelled rows which the
dictionaries did not see.

Learning takes a bounded sample: the first ``TRAIN_TOXIC`` and ``TRAIN_ORDINARY`` labelled rows of at most
``TRAIN_BYTES`` bytes by a seeded hash of their id. Scoring reads every whole text.

Defined cases: null or empty text scores like a text without any saving; without a training text of both
classes every score is 0; texts too few to train on are the dictionaries themselves; equal rows score the same; other columns are ignored.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import chunks, doc_columns, ids_of

TRAIN_TOXIC = 1500
TRAIN_ORDINARY = 4500
TRAIN_BYTES = 20_000
WINDOW_WORDS = 16
HIT_BYTES = 3
BASE_BYTES = 65_536
TOXIC_BYTES = 32_768
MIN_CONTEXTS = 8
MER = 7
MIN_RATIO = 12.0
SEED = 11

_K = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Contents of the two dictionaries and the calibrated curve; ``ordinary`` is empty if nothing could be learnt."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def windows(text: bytes, words: int = WINDOW_WORDS) -> list[bytes]:
    w = text.lower().split()
    return [b" " + b" ".join(w[i : i + words]) + b" " for i in range(0, len(w), words)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        compression_level=3, strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=17, hash_log=16, chain_log=16, search_log=4, target_length=16,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_content_size=False, write_dict_id=False,
    )
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params)


def _savings(model: Model):
    plain, both = _compressor(model.ordinary), _compressor(model.toxic + model.ordinary)

    def run(text: bytes) -> list[int]:
        return [len(plain.compress(w)) - len(both.compress(w)) for w in windows(text)]

    return run


def _features(saved: list[int]) -> list[float]:
    if not saved:
        return [1.0, 0.0, 0.0, 0.0, 0.0]
    x = np.array(saved, float)
    return [1.0, float(x.max()), float(x.mean()), float((x >= HIT_BYTES).mean()), float(np.log1p(len(x)))]


def _plain(text: bytes) -> bytes:
    return b" " + b" ".join(text.lower().split()) + b" "


def _strings(plain: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(the MER-byte string that starts at each byte, a hash of it with the 8 bytes before and after it)."""
    n = max(len(plain) - MER + 1, 0)
    v = np.ndarray((len(plain) + 17,), "<u8", b"\0" * 8 + plain + b"\0" * 16, strides=(1,)).copy()
    string = v[8 : 8 + n] & np.uint64((1 << 8 * MER) - 1)
    return string, (v[:n] * _K ^ v[8 + MER : 8 + MER + n]) * _K ^ string


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted array known."""
    return known[np.searchsorted(known, x).clip(0, len(known) - 1)] == x if len(known) else np.zeros(len(x), bool)


def _contexts(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(strings in ascending order, different contexts of each), of the known strings only if given."""
    found = [(np.zeros(0, np.uint64),) * 2]
    for t in texts:
        s, c = _strings(_plain(t))
        m = _among(s, known) if known is not None else slice(None)
        found.append((s[m], c[m]))
    s, c = (np.concatenate(x) for x in zip(*found))
    return np.unique(s[np.unique(c, return_index=True)[1]], return_counts=True)


def _own_runs(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The different runs of toxic text whose strings are rare in ordinary text."""
    string, n = _contexts(toxic)
    few = min(MIN_CONTEXTS, max(2, len(toxic) // 20))
    na, nb = n.sum(), sum(map(len, ordinary))
    string, n = string[n >= few], n[n >= few]
    common = np.zeros(len(string))
    seen, m = _contexts(ordinary, string)
    common[np.searchsorted(string, seen)] = m
    marked = string[n / max(1, na) >= MIN_RATIO * (common + 1) / (na + nb)]
    runs = set()
    for t in toxic:
        plain = _plain(t)
        at = np.flatnonzero(_among(_strings(plain)[0], marked))
        new = np.flatnonzero(np.diff(at, prepend=-MER - 1) > MER)
        runs.update(plain[at[a] : at[b - 1] + MER] for a, b in zip(new, [*new[1:], len(at)]))
    return sorted(runs)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    z = x / scale
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)) * 0.1
        step = np.linalg.solve(h, z.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _dictionary(size: int, samples: list[bytes], spare: list[bytes], **how) -> bytes:
    """A dictionary trained on the samples or, if they are too few for that, the first ``spare`` texts themselves."""
    try:
        return zstandard.train_dictionary(size, samples, **how).as_bytes()
    except zstandard.ZstdError:
        return b"".join(spare)[:size]


def train(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    """Learn from labelled texts: two thirds make the dictionaries, one third calibrates."""
    none = Model(b"", b"", ())
    fit_t, cal_t = [t for i, t in enumerate(toxic) if i % 3] or toxic, toxic[::3]
    fit_o, cal_o = [t for i, t in enumerate(ordinary) if i % 3] or ordinary, ordinary[::3]
    if not any(map(windows, fit_t)) or not any(map(windows, fit_o)):
        return none
    rng = random.Random(SEED)
    base = [w for t in fit_o for w in windows(t, 4)]
    rng.shuffle(base)
    samples = _own_runs(fit_t, fit_o)
    rng.shuffle(samples)
    model_o = _dictionary(BASE_BYTES, base[:80_000], base)
    shared = set(base)
    spare = samples or [w for t in fit_t for w in windows(t, 4) if w not in shared]
    model_t = _dictionary(TOXIC_BYTES, samples, spare, d=6, k=32)
    model = Model(model_o, model_t, ())
    saved = _savings(model)
    x = np.array([_features(saved(t)) for t in [*cal_t, *cal_o]])
    y = np.array([1.0] * len(cal_t) + [0.0] * len(cal_o))
    return Model(model_o, model_t, tuple(_fit_curve(x, y).tolist()))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """(toxic, ordinary) training texts, at most TRAIN_TOXIC and TRAIN_ORDINARY of at most TRAIN_BYTES bytes."""
    marks = labels.select("doc_id", "toxic").filter("toxic is not null").dropDuplicates(["doc_id"])
    rows = doc_columns(docs, "doc_id", "text")
    sized = rows.select("doc_id", F.octet_length("text").alias("b")).filter((F.col("b") <= TRAIN_BYTES) & (F.col("b") > 0))
    known = sized.join(marks, "doc_id").select("doc_id", "toxic").distinct()
    out = []
    for toxic, most in ((1, TRAIN_TOXIC), (0, TRAIN_ORDINARY)):
        ids = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").select("doc_id").limit(most)
        picked = rows.join(F.broadcast(ids), "doc_id").filter(F.octet_length("text").between(1, TRAIN_BYTES))  # at most TRAIN_* ids
        order = F.xxhash64(F.lit(SEED), "doc_id")
        out.append([r["text"].encode() for r in picked.limit(2 * most).orderBy(order, "doc_id", "text").select("text").collect()])
    return out[0], out[1]


def _score_batches(model: Model):
    def run(batches):
        saved = _savings(model) if model.weights else None
        weights = np.array(model.weights)
        for rb, data, off in chunks(batches, "text"):
            raw = data.tobytes()
            at = off.tolist()
            if saved is None:
                score = [0.0] * rb.num_rows
            else:
                x = np.array([_features(saved(raw[a:b])) for a, b in zip(at, at[1:])])
                score = (1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))).tolist()
            yield pa.RecordBatch.from_arrays([ids_of(rb), pa.array(score, pa.float64())], ["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the toxicity score of every whole text."""
    rows = doc_columns(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_score_batches(model), f"doc_id {kind}, score double")
