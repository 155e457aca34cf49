"""Non-SQL queries checked against brute force on the smallest fixture."""

import math

import numpy as np
import pytest

from sitecall import fixtures as fx
from sitecall.operators import background as bg
from sitecall.operators import calling, merge
from sitecall.options import FALLBACK_PARAMS
from sitecall.plans import site_queries as sq


def _bf_gc(m):
    w = (m[4:14] + m[17:27]).upper()
    return 5 * sum(1 for ch in w if ch in "GC")


def _bf_m3(m):
    m3 = m[14:17].upper()
    return m3.replace("T", "U", 2)


def _expected(x, p):
    a, b, c, d, e = p
    level = c * np.exp(-d * (x - e) ** 2)
    return level + (1 - level) * a * np.exp(b * x)


def test_fit_background_is_a_least_squares_fit(spark, sf):
    """No parameter can be moved within its box to a clearly smaller sum of squares, and the start is no better."""
    lo, hi = np.array([0, 2, 0, 1, 0.25]), np.array([0.0005, 25, 0.3, 100, 0.8])
    pts = bg.background_points(sq._prepared(spark, sf))
    got = {(r["sample"], r["motif3"]): r for r in bg.fit_background(pts).collect()}
    groups = {k: g for k, g in pts.toPandas().groupby(["sample", "motif3"])}
    assert set(got) == set(groups)
    assert sum(r["status"] == "fit" for r in got.values()) > len(got) / 2
    for key, r in got.items():
        if r["status"] != "fit":
            assert tuple(r[c] for c in "abcde") == FALLBACK_PARAMS
            continue
        x, y = groups[key]["gc"].to_numpy(float), groups[key]["ratio"].to_numpy(float)
        loss = lambda p: float(((_expected(x, p) - y) ** 2).sum())
        p = np.array([r[c] for c in "abcde"])
        assert np.all((p >= lo - 1e-12) & (p <= hi + 1e-12))
        here = loss(p)
        for i in range(5):
            for step in (-1e-3, 1e-3):
                moved = p.copy()
                moved[i] = np.clip(p[i] + step * (hi[i] - lo[i]), lo[i], hi[i])
                assert here <= loss(moved) * 1.001 + 1e-12
        assert here <= loss(np.array([0.0001, 8.0, 0.03, 10.0, 0.4])) + 1e-12


def test_call_sites_equals_brute_force(spark, sf):
    long = merge.merge_site_counts(fx.load(spark, sf, "site_counts"), sq.PIPE_SAMPLES, sq.PIPE_REQUIRES, 3)
    called, points, params = calling.call_sites(long, ["chrom", "pos", "strand"], pool=False)
    got = {(r["sample"], r["chrom"], r["pos"], r["strand"]): r["p"] for r in called.collect()}

    rows = long.toPandas()
    par = {(r["sample"], r["motif3"]): (r["a"], r["b"]) for r in params.collect()}
    rows["m3"] = rows["motif"].map(_bf_m3)
    rows["gc"] = rows["motif"].map(_bf_gc)
    rows = rows[(rows["strand"] != ".") & ~rows["m3"].str.contains("N")]

    def pval(r):
        u, d = r["uncon"], r["depth"]
        ab = par.get((r["sample"], r["m3"]))
        ratio = u / d if d > 0 else 0.0
        if d <= 10 or ratio < 0.1 or ratio == 0:
            return 1.0
        if ab is None:
            return None
        b = max(1e-4, ab[0] * math.exp(ab[1] * (r["gc"] * 0.01)))
        if ratio <= b:
            return 1.0
        eu, ec = d * b, d * (1 - b)
        x = (u - eu) ** 2 / eu + ((d - u) - ec) ** 2 / ec
        return math.erfc(math.sqrt(x / 2))

    rows["p"] = rows.apply(pval, axis=1)
    hit = rows[rows["p"].notna() & (rows["p"] < 1)][["chrom", "pos", "strand"]].drop_duplicates()
    kept = rows.merge(hit, on=["chrom", "pos", "strand"])
    exp = {(r.sample, r.chrom, r.pos, r.strand): r.p for r in kept.itertuples()}
    assert set(got) == set(exp)
    for k, p in exp.items():
        if p is None or (isinstance(p, float) and math.isnan(p)):
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(p, rel=1e-9, abs=1e-300)
