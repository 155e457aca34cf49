"""Aligned base-pair counting for ungapped reads (the hot loop of A1 and A15).

Spark partitions the reads; inside each task, every Arrow batch is reduced to
partial counts per (group, position, reference base, read base) with NumPy
(one ``np.unique`` over packed integer keys), and Spark shuffles and sums the
partials.  A reference or sample holding a third of all reads only adds rows to
many tasks' partials, each bounded by groups x read length x base pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHARS = np.array([chr(i) for i in range(256)], dtype=object)
MAX_BASES_PER_CHUNK = 4_000_000  # bounds worker memory whatever the read length


def _chunks(pdf: pd.DataFrame, seq: str, max_bases: int = MAX_BASES_PER_CHUNK):
    """Consecutive slices of an Arrow batch holding at most ``max_bases`` bases (at least one read)."""
    lens = pdf[seq].fillna("").str.len().to_numpy()
    start, acc = 0, 0
    for i, n in enumerate(lens):
        if acc and acc + n > max_bases:
            yield pdf.iloc[start:i]
            start, acc = i, 0
        acc += n
    if start < len(pdf):
        yield pdf.iloc[start:]


def _batch_counts(pdf: pd.DataFrame, keys: Sequence[str], ref: str, seq: str, context: int | None = None) -> pd.DataFrame | None:
    refs = pdf[ref].to_numpy()
    seqs = pdf[seq].to_numpy()
    ok = pd.notna(refs) & pd.notna(seqs)
    if not ok.all():
        pdf, refs, seqs = pdf[ok], refs[ok], seqs[ok]
    if len(pdf) == 0:
        return None
    lens = np.fromiter((min(len(a), len(b)) for a, b in zip(refs, seqs)), dtype=np.int64, count=len(refs))
    total = int(lens.sum())
    if total == 0:
        return None
    rb = np.frombuffer("".join(a[:n] for a, n in zip(refs, lens)).encode("latin-1", "replace"), dtype=np.uint8)
    qb = np.frombuffer("".join(b[:n] for b, n in zip(seqs, lens)).encode("latin-1", "replace"), dtype=np.uint8)
    gid = pdf.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy(dtype=np.int64)
    starts = np.cumsum(lens) - lens
    pos = np.arange(total, dtype=np.int64) - np.repeat(starts, lens)  # 0-based position in the read
    width = int(lens.max()) + 1
    packed = ((np.repeat(gid, lens) * width + pos) << 16) | (rb.astype(np.int64) << 8) | qb.astype(np.int64)
    uniq, counts = np.unique(packed, return_counts=True)
    rest = uniq >> 16
    g = rest // width
    first_row = pd.Series(np.arange(len(gid))).groupby(gid).first()
    out = pdf[list(keys)].iloc[first_row.loc[g].to_numpy()].reset_index(drop=True)
    out["pos"] = (rest % width + 1).astype(np.int64)
    out["ref_base"] = _CHARS[(uniq >> 8) & 255]
    out["read_base"] = _CHARS[uniq & 255]
    out["n"] = counts.astype(np.int64)
    if context is not None:
        # reference window around each position (N-padded), from the group's first read
        pad = "N" * context
        ref_of_group = refs[first_row.to_numpy()]
        gi = g.astype(np.int64)
        p0 = rest % width
        out["context"] = [(pad + ref_of_group[a] + pad)[b: b + 2 * context + 1] for a, b in zip(gi, p0)]
    return out


def aligned_pair_partials(reads: DataFrame, keys: Sequence[str], ref: str = "ref_seq", seq: str = "seq",
                          context: int | None = None) -> DataFrame:
    """(keys..., pos (1-based), ref_base, read_base, n) per Arrow batch, not yet summed: base i of ``seq``
    aligned to base i of ``ref``.

    With ``context=k`` a ``context`` column carries the 2k+1 reference bases centred on
    ``pos`` (N-padded); the reference must be the same for all reads of a key group.
    """
    keys = list(keys)
    src = reads.select(*keys, ref, seq)
    fields = [f for f in src.schema.fields if f.name in keys]
    extra = [T.StructField("context", T.StringType())] if context is not None else []
    schema = T.StructType(
        fields + [T.StructField("pos", T.LongType()), T.StructField("ref_base", T.StringType()),
                  T.StructField("read_base", T.StringType()), T.StructField("n", T.LongType())] + extra
    )

    def run(batches):
        for batch in batches:
            for pdf in _chunks(batch, seq):
                out = _batch_counts(pdf, keys, ref, seq, context)
                if out is not None and len(out):
                    yield out[[f.name for f in schema.fields]]

    return src.mapInPandas(run, schema)


_BASE_CODE = np.full(256, 5, dtype=np.int64)  # other letters: counted in "reads" only
for _i, _b in enumerate("ACGTN"):
    _BASE_CODE[ord(_b)] = _i
    _BASE_CODE[ord(_b.lower())] = _i
_BASES = ("a", "c", "g", "t", "n")


def _slices(batch: pa.RecordBatch, seq: str, max_bases: int = MAX_BASES_PER_CHUNK):
    """``_chunks`` for Arrow: consecutive slices holding at most ``max_bases`` bases (at least one read); reads without a
    sequence are left out."""
    batch = batch.filter(batch.column(seq).is_valid())
    ends = np.cumsum(pc.utf8_length(batch.column(seq)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = done = 0
    while start < len(ends):
        stop = max(int(np.searchsorted(ends, done + max_bases, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def _letters(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all characters, one Latin-1 byte each, as other alphabets' count as ``?``; characters a string, none if null)."""
    lens = pc.fill_null(pc.utf8_length(strings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = int(lens.sum())
    if total == (pc.sum(pc.binary_length(strings)).as_py() or 0):  # ASCII: the array's own bytes
        whole = pa.concat_arrays([pc.fill_null(strings.cast(pa.large_string()), "")])
        first = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset] if len(whole) else 0
        data = whole.buffers()[2]
        return np.frombuffer(data, dtype=np.uint8)[first : first + total] if total else np.zeros(0, np.uint8), lens
    return np.frombuffer("".join(x for x in strings.to_pylist() if x).encode("latin-1", "replace"), dtype=np.uint8), lens


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's key group, each group's first row)."""
    gid, first = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for k in keys:
        found = pc.dictionary_encode(batch.column(k), null_encoding="encode")
        gid, _ = pd.factorize(gid * max(len(found.dictionary), 1) + found.indices.to_numpy(zero_copy_only=False))
    if batch.num_rows:
        first = np.empty(int(gid.max()) + 1, dtype=np.int64)
        first[gid[::-1]] = np.arange(batch.num_rows)[::-1]  # of several rows of a group the last one assigned stays
    return gid.astype(np.int64), first


class _Reads:
    """The reads of a slice as arrays: bases of all of them in a row, their qualities beside them."""

    def __init__(self, batch: pa.RecordBatch, keys: Sequence[str], seq: str, qual: str, offset: int):
        self.batch, self.keys, self.offset = batch, list(keys), offset
        letters, self.lens = _letters(batch.column(seq))
        self.code = _BASE_CODE[letters]
        self.starts = np.cumsum(self.lens) - self.lens
        self.quals, qlens = _letters(batch.column(qual))
        if not np.array_equal(qlens, self.lens):  # padded with zeros or cut to the read length (missing: no quality)
            n = np.minimum(qlens, self.lens)
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            padded = np.zeros(len(letters), dtype=np.uint8)
            padded[np.repeat(self.starts, n) + inside] = self.quals[np.repeat(np.cumsum(qlens) - qlens, n) + inside]
            self.quals = padded
        self.gid, self.first = _groups(batch, keys)

    def table(self, groups: np.ndarray, columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
        """Rows of the key groups' values and of the columns given."""
        rows = pa.array(self.first[groups])
        of = [self.batch.column(k).take(rows) for k in self.keys]
        return pa.RecordBatch.from_arrays([*of, *map(pa.array, columns.values())], [*self.keys, *columns])

    def positions(self) -> tuple[np.ndarray, dict[str, np.ndarray]] | None:
        """(group, counts) a group and position that reads cover."""
        if len(self.code) == 0:
            return None
        width, ngroups = int(self.lens.max()), len(self.first)
        cell = np.repeat(self.gid * width - self.starts, self.lens)
        cell += np.arange(len(cell))
        size = ngroups * width
        bases = np.bincount(cell * 6 + self.code, minlength=size * 6).reshape(size, 6)
        reads = bases.sum(axis=1)
        if self.quals.all():
            qn, qsum = reads, np.bincount(cell, weights=self.quals, minlength=size)
        else:
            has_q = self.quals > 0
            qn = np.bincount(cell[has_q], minlength=size)
            qsum = np.bincount(cell[has_q], weights=self.quals[has_q], minlength=size)
        used = np.nonzero(reads)[0]
        counts = {"position": used % width + 1, "reads": reads[used]} | {b: bases[used, j] for j, b in enumerate(_BASES)}
        return used // width, counts | {"q_sum": qsum[used] - self.offset * qn[used].astype(np.float64), "q_n": qn[used]}

    def histogram(self, values: np.ndarray, reads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, value, reads) of the values, not below zero, of the reads numbered ``reads``."""
        width = int(values.max(initial=0)) + 1
        found, n = np.unique(self.gid[reads] * width + values, return_counts=True)
        return found // width, found % width, n


def position_stats(reads: DataFrame, keys: Sequence[str], seq: str = "seq", qual: str = "qual", offset: int = 33) -> DataFrame:
    """Per (keys..., position): reads covering it, A/C/G/T/N counts (case-folded; other
    letters only count as covering reads), mean Phred quality.  Partial sums per
    Arrow batch, summed by Spark."""
    keys = list(keys)
    src = reads.select(*keys, seq, qual)
    fields = [f for f in src.schema.fields if f.name in keys]
    schema = T.StructType(
        fields + [T.StructField("position", T.LongType()), T.StructField("reads", T.LongType())]
        + [T.StructField(b, T.LongType()) for b in _BASES]
        + [T.StructField("q_sum", T.DoubleType()), T.StructField("q_n", T.LongType())]
    )
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            for part in _slices(batch, seq):
                r = _Reads(part, keys, seq, qual, offset)
                if (found := r.positions()) is not None:
                    yield r.table(*found).select(names)

    partial = src.mapInArrow(run, schema)
    g = partial.groupBy(*keys, "position").agg(
        F.sum("reads").alias("reads"), *[F.sum(b).alias(b) for b in _BASES],
        F.sum("q_sum").alias("_qs"), F.sum("q_n").alias("_qn"),
    )
    return g.select(*keys, "position", "reads", *_BASES, F.try_divide(F.col("_qs"), F.col("_qn").cast("double")).alias("mean_quality"))


PROFILE_COUNTS = ("reads", *_BASES, "q_n")


def _profile(r: _Reads):
    """Rows of all three tables of a slice: ``what`` is position, length or gc, ``at`` its value."""
    if (found := r.positions()) is not None:
        groups, counts = found
        yield r.table(groups, {"what": ["position"] * len(groups), "at": counts.pop("position")} | counts)
    some = np.nonzero(r.lens)[0]
    is_gc = np.concatenate([[0], np.cumsum((r.code == 1) | (r.code == 2))])
    gc = 100 * (is_gc[r.starts + r.lens] - is_gc[r.starts])[some] // r.lens[some]
    for what, values, rows in (("length", r.lens, np.arange(len(r.lens))), ("gc", gc, some)):
        groups, at, n = r.histogram(values, rows)
        none = np.zeros(len(n), dtype=np.int64)
        yield r.table(groups, {"what": [what] * len(n), "at": at, "reads": n} | {c: none for c in (*_BASES, "q_n")} | {"q_sum": none.astype(np.float64)})


def read_profile(reads: DataFrame, keys: Sequence[str], seq: str = "seq", qual: str = "qual", offset: int = 33) -> DataFrame:
    """(keys..., what, at, reads, a c g t n, mean_quality): per-position composition and quality, read lengths and
    integer GC percents of the reads, in one pass with one shuffle of partial counts."""
    keys = list(keys)
    src = reads.select(*keys, seq, qual)
    fields = [f for f in src.schema.fields if f.name in keys]
    schema = T.StructType(
        fields + [T.StructField("what", T.StringType()), T.StructField("at", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in PROFILE_COUNTS] + [T.StructField("q_sum", T.DoubleType())]
    )
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            for part in _slices(batch, seq):
                for table in _profile(_Reads(part, keys, seq, qual, offset)):
                    if table.num_rows:
                        yield table.select(names)

    partial = src.mapInArrow(run, schema)
    g = partial.groupBy(*keys, "what", "at").agg(*[F.sum(c).alias(c) for c in PROFILE_COUNTS], F.sum("q_sum").alias("q_sum"))
    return g.select(*keys, "what", "at", "reads", *_BASES, F.try_divide(F.col("q_sum"), F.col("q_n").cast("double")).alias("mean_quality"), "q_n", "q_sum")


# ---- gapped alignments -----------------------------------------------------------------------------


def _piece_counts(pdf: pd.DataFrame, keys: Sequence[str], tile: int) -> pd.DataFrame | None:
    refs, seqs = pdf["ref"].to_numpy(), pdf["seq"].to_numpy()
    lens = np.fromiter((len(a) for a in refs), dtype=np.int64, count=len(refs))
    total = int(lens.sum())
    if total == 0:
        return None
    rb = np.frombuffer(b"".join(refs), dtype=np.uint8) & 0xDF  # upper case of letters
    qb = np.frombuffer("".join(b[:n] for b, n in zip(seqs, lens)).encode("latin-1", "replace"), dtype=np.uint8) & 0xDF
    gid = pdf.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy(dtype=np.int64)
    row = np.repeat(np.arange(len(pdf)), lens)
    pos = pdf["at"].to_numpy(dtype=np.int64)[row] + np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens)
    packed = ((gid[row] * tile + pos) << 16) | (rb.astype(np.int64) << 8) | qb.astype(np.int64)
    uniq, first, counts = np.unique(packed, return_index=True, return_counts=True)
    out = pdf[list(keys)].iloc[row[first]].reset_index(drop=True)
    out["pos"] = out["tile"].to_numpy(dtype=np.int64) * tile + pos[first] + 1
    out["ref_base"] = _CHARS[(uniq >> 8) & 255]
    out["read_base"] = _CHARS[uniq & 255]
    out["n"] = counts.astype(np.int64)
    return out


def piece_partials(pieces: DataFrame, keys: Sequence[str], tile: int) -> DataFrame:
    """(keys..., pos (1-based), ref_base, read_base, n) per Arrow batch, not yet summed, in upper case.

    ``pieces``: the keys (``tile`` among them), at (0-based place in the tile), ref (bytes of the reference under the
    piece) and seq (its read bases).
    """
    keys = list(keys)
    src = pieces.select(*keys, "at", "ref", "seq")
    fields = [f for f in src.schema.fields if f.name in keys]
    schema = T.StructType(fields + [T.StructField("pos", T.LongType()), T.StructField("ref_base", T.StringType()), T.StructField("read_base", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches):
        for batch in batches:
            for pdf in _chunks(batch, "seq"):
                out = _piece_counts(pdf, keys, tile)
                if out is not None:
                    yield out[[f.name for f in schema.fields]]

    return src.mapInPandas(run, schema)


PILEUP_CELLS = ("u0", "u1", "u2", "m0", "m1", "m2")


def _pileup_batch(pdf: pd.DataFrame, keys: Sequence[str], tile: int, bases: dict[str, tuple[str, str]]) -> pa.RecordBatch | None:
    refs, seqs = pdf["ref"].to_numpy(), pdf["seq"].to_numpy()
    lens = np.fromiter((len(a) for a in refs), dtype=np.int64, count=len(refs))
    total = int(lens.sum())
    rb = np.frombuffer(b"".join(refs), dtype=np.uint8) & 0xDF  # upper case of letters
    qb = np.frombuffer("".join(b[:n] for b, n in zip(seqs, lens)).encode("latin-1", "replace"), dtype=np.uint8) & 0xDF
    row = np.repeat(np.arange(len(pdf)), lens)
    strand = pdf["strand"]
    ref_base, mut_base = (strand.map({s: ord(x[i]) for s, x in bases.items()}).fillna(0).to_numpy(dtype=np.uint8) for i in (0, 1))
    keep = rb == ref_base[row]
    inside = (np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens))[keep]
    qb, row = qb[keep], row[keep]
    if len(qb) == 0:
        return None
    group = pdf.groupby(list(keys), sort=False, dropna=False)
    gid = group.ngroup().to_numpy(dtype=np.int64)
    tier = pdf["tier"].to_numpy(dtype=np.int64)[row]
    cell = np.where(qb == ref_base[row], tier, np.where(qb == mut_base[row], 3 + tier, 6))
    uniq, at = np.unique(gid[row] * tile + pdf["at"].to_numpy(dtype=np.int64)[row] + inside, return_inverse=True)
    counts = np.bincount(at * 7 + cell, minlength=7 * len(uniq)).reshape(-1, 7)
    found, starts = np.unique(uniq // tile, return_index=True)
    offsets = pa.array(np.append(starts, len(uniq)).astype(np.int32))
    first = pd.Series(np.arange(len(gid))).groupby(gid).first()
    of = pdf[list(keys)].iloc[first.loc[found].to_numpy()]
    pos = uniq % tile + np.repeat(of["tile"].to_numpy(dtype=np.int64) * tile, np.diff(np.append(starts, len(uniq)))) + 1
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x, dtype=np.int64))) for x in (pos, *counts[:, :6].T)]
    return pa.RecordBatch.from_arrays([*(pa.array(of[k], from_pandas=True) for k in keys), *lists], [*keys, "pos", *PILEUP_CELLS])


def pileup_partials(pieces: DataFrame, tile: int, bases: dict[str, tuple[str, str]]) -> DataFrame:
    """(sample, chrom, strand, pos (1-based), u0 .. m2) per Arrow batch, not yet summed.

    ``pieces``: sample, chrom, tile, strand, tier, at (0-based place in the tile), ref (bytes of the reference under the
    piece) and seq. ``bases`` gives the unconverted and the converted base on each strand. The counts of one tile
    travel as arrays, one row a tile, and are rows only on the JVM.
    """
    keys = ["sample", "chrom", "tile", "strand"]
    src = pieces.select(*keys, "tier", "at", "ref", "seq")
    fields = [f for f in src.schema.fields if f.name in keys]
    schema = T.StructType(fields + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pos", *PILEUP_CELLS)])

    def run(batches):
        for rb in batches:
            for pdf in _chunks(rb.to_pandas(), "seq"):
                if len(pdf) and (out := _pileup_batch(pdf, keys, tile, bases)) is not None:
                    yield out

    rows = src.mapInArrow(run, schema).select("sample", "chrom", "strand", F.arrays_zip("pos", *PILEUP_CELLS).alias("a"))
    return rows.select("sample", "chrom", "strand", F.inline("a"))
