"""Per-position counts of reads against plain Python, on odd letters, qualities and keys."""

import random

import pytest

from sitecall.operators import basecount as bc

KEYS = ("sample", "clean")


def _reads():
    rnd = random.Random(7)
    word = lambda k, letters: "".join(rnd.choice(letters) for _ in range(k))
    rows = []
    for letters, quals in (("ACGTN", "56789:;<I"), ("acgtNXé漢", "5\x009é漢")):
        for _ in range(120):
            n = rnd.choice([0, 1, 7, 20])
            rows.append((rnd.choice(["s0", "s1", None]), rnd.choice([True, False, None]), word(n, letters), word(rnd.choice([n, n, 0, n + 3, max(n - 2, 0)]), quals)))
    return [*rows, ("s0", True, None, "II"), ("s0", True, "ACGT", None), ("s2", False, None, None)]


def _wanted(rows):
    want = {}
    def add(what, key, at, **counts):
        cell = want.setdefault((what, *key, at), dict.fromkeys(("reads", *"acgtn", "q_n", "q_sum"), 0))
        for c, n in counts.items():
            cell[c] += n
    for *key, seq, qual in rows:
        if seq is None:
            continue
        add("length", key, len(seq), reads=1)
        if seq:
            add("gc", key, 100 * sum(x in "GCgc" for x in seq) // len(seq), reads=1)
        for i, x in enumerate(seq):
            q = ord((qual or "")[i].encode("latin-1", "replace")) if i < len(qual or "") else 0
            add("position", key, i + 1, reads=1, **({x.lower(): 1} if x.lower() in "acgtn" else {}), q_n=int(q > 0), q_sum=q - 33 if q else 0)
    return want


@pytest.mark.parametrize("max_bases", [1, 50, 1_000_000])
def test_profile_equals_plain_counts(spark, monkeypatch, max_bases):
    rows = _reads()
    monkeypatch.setattr(bc._slices, "__defaults__", (max_bases,))
    df = spark.createDataFrame(rows, "sample string, clean boolean, seq string, qual string").coalesce(2)
    counts = ("reads", *"acgtn", "q_n", "q_sum")
    got = {(r.what, r.sample, r.clean, r.at): {c: r[c] for c in counts} for r in bc.read_profile(df, KEYS).collect()}
    want = _wanted(rows)
    assert got == want
    stats = {(r.sample, r.clean, r.position): (r.reads, r.a, r.mean_quality) for r in bc.position_stats(df, KEYS).collect()}
    assert stats == {k[1:]: (v["reads"], v["a"], v["q_sum"] / v["q_n"] if v["q_n"] else None) for k, v in want.items() if k[0] == "position"}


def test_slices_hold_at_most_so_many_bases():
    import pyarrow as pa

    seqs = ["ACGT", None, "", "A" * 30, "CC", "GG", "T"]
    parts = [p.column(0).to_pylist() for p in bc._slices(pa.RecordBatch.from_arrays([pa.array(seqs)], ["seq"]), "seq", 5)]
    assert [s for p in parts for s in p] == [s for s in seqs if s is not None]
    assert all(sum(map(len, p)) <= 5 or sum(map(bool, p)) == 1 for p in parts)


def test_reads_reach_python_as_arrow(spark):
    # as pandas strings, each read took some ten microseconds
    df = spark.createDataFrame([("s0", "ACGT", "IIII")], "sample string, seq string, qual string")
    for out in (bc.position_stats(df, ["sample"]), bc.read_profile(df, ["sample"])):
        assert "MapInArrow" in out._jdf.queryExecution().toString()
