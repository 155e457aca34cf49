"""Hand-computed tables for the semantic traps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitecall.functions import motif as fm
from sitecall.functions import stats as fs
from sitecall.operators import calling, liftover, merge, report
from sitecall.operators import reads as rd
from sitecall.operators import sites as st
from sitecall.sources import files as src


def test_histogram_edges(spark):
    rows = [(7, 10), (29, 50), (41, 50), (47, 50), (0, 1), (1, 1), (3, 2)]
    df = spark.createDataFrame([("s", u, d) for u, d in rows], "sample string, uncon long, depth long")
    h = {r["bin"]: r["count"] for r in report.ratio_histogram(df).collect()}
    edges = report.ratio_edges()
    expected = {}
    for u, d in rows:
        x = u / d
        if 0 <= x <= 1:
            b = sum(1 for e in edges[1:-1] if e <= x)
            expected[b] = expected.get(b, 0) + 1
    assert h == expected
    assert 34 in h  # 0.7 < 0.7000000000000001: bin 34, not 35
    assert sum(h.values()) == 6  # 3/2 is outside [0, 1]


def test_motif_ratio_mean_vs_pooled(spark):
    m = "A" * 15 + "A" + "A" * 15
    df = spark.createDataFrame([("s", "g", "c", 1, "+", m, 1, 2), ("s", "g", "c", 2, "+", m, 1, 10)],
                               "sample string, reftype string, chrom string, pos long, strand string, motif string, uncon long, depth long")
    a2 = report.motif_conversion(df).first()
    a9 = report.heatmap_ratio(df).first()
    assert a2["ratio"] == pytest.approx((0.5 + 0.1) / 2)
    assert a9["ratio_pct"] == pytest.approx(100 * 2 / 12)


def _sc(spark, rows):
    return spark.createDataFrame(rows, "sample string, chrom string, pos long, strand string, motif string, uncon long, depth long")


def test_merge_depth_filter_only_with_optional(spark):
    rows = [("a", "c", 1, "+", "M", 1, 2), ("b", "c", 1, "+", "M", 0, 1), ("b", "c", 2, "+", "M", 5, 9), ("o", "c", 2, "+", "M", 1, 1)]
    df = _sc(spark, rows)
    # no optional sample: no depth filter, full union of a and b
    both = merge.merge_site_counts(df, ["a", "b"], [1, 1], 3)
    assert {(r["pos"]) for r in both.collect()} == {1, 2}
    # with an optional sample: max depth over a, b >= 3 before annotating with o
    opt = merge.merge_site_counts(df, ["a", "b", "o"], [1, 1, 0], 3)
    assert sorted((r["pos"], r["sample"]) for r in opt.collect()) == [(2, "b"), (2, "o")]
    # all optional: the first sample alone is the base and is filtered alone
    allopt = merge.merge_site_counts(df, ["b", "a", "o"], [0, 0, 0], 3)
    assert sorted((r["pos"], r["sample"]) for r in allopt.collect()) == [(2, "b"), (2, "o")]


def test_merge_motif_precedence(spark):
    rows = [("x", "c", 1, "+", None, 1, 5), ("y", "c", 1, "+", "MY", 1, 5), ("z", "c", 1, "+", "MZ", 1, 5)]
    out = merge.merge_site_counts(_sc(spark, rows), ["z", "x", "y"], [0, 1, 1], 0)
    assert {r["motif"] for r in out.collect()} == {"MY"}  # x (rank 0) has none, y is next


def test_legacy_tier1_only_header_tiers12(spark, tmp_path):
    hp = tmp_path / "h.tsv"
    hp.write_text("chrom\tpos\tstrand\tmotif\tu0\tu1\tu2\tm0\tm1\tm2\nc\t5\t+\tM\t9\t1\t2\t9\t3\t4\n")
    lp = tmp_path / "l.tsv"
    lp.write_text("c\t5\t+\tM\t9\t9\t1\t3\t2\t4\n")
    h = src.scan_pileup(spark, str(hp), sample="s").first()
    lg = src.scan_pileup_legacy(spark, str(lp), sample="s").first()
    assert (h["uncon"], h["depth"]) == (3, 10)
    assert (lg["uncon"], lg["depth"]) == (1, 3)
    auto = {r["sample"]: (r["uncon"], r["depth"]) for r in src.scan_pileup_auto(spark, [str(hp), str(lp)]).collect()}
    assert auto == {"h": (3, 10), "l": (1, 3)}


def _tx(spark, rows):
    return spark.createDataFrame(rows, "gene_id string, chrom string, strand string, spans string")


def test_liftover_strand_unknown_outside_and_minus(spark):
    tx = _tx(spark, [("G", "chr1", "-", "201-210,101-110"), ("G", "chr1", "-", "201-210,101-110")])
    ex = liftover.exon_offsets(tx)
    sites = spark.createDataFrame(
        [("s", "G", 1, "+", "M", 1, 5), ("s", "G", 12, "+", "M", 1, 5), ("s", "G", 25, "+", "M", 1, 5), ("s", "U", 7, "-", "M", 1, 5)],
        "sample string, chrom string, pos long, strand string, motif string, uncon long, depth long",
    )
    out = sorted((r["chrom"], r["pos"], r["strand"], r["gene_pos"]) for r in liftover.liftover_sites(sites, ex).collect())
    # '-' strand: tx pos 1 -> genome 210, tx pos 12 -> second listed exon 110 - 1 = 109
    # duplicate gene rows fan out (two identical rows each); pos 25 is outside -> dropped; U unknown -> kept with '.'
    assert out == [("U", 7, ".", 7), ("chr1", 109, "-", 12), ("chr1", 109, "-", 12), ("chr1", 210, "-", 1), ("chr1", 210, "-", 1)]


def test_call_gates(spark):
    rows = [(1, 10, 0.01), (2, 11, 0.01), (1, 11, 0.01), (11, 110, 0.01), (11, 110, 0.1), (0, 50, 0.01), (5, 20, None)]
    df = spark.createDataFrame(rows, "uncon long, depth long, background double")
    out = df.select("uncon", "depth", fs.call_pvalue("uncon", "depth", "background").alias("p")).collect()
    p = [r["p"] for r in out]
    assert p[0] == 1.0  # depth 10 is never tested
    assert p[1] < 1.0  # depth 11, ratio 0.18
    assert p[2] == 1.0  # ratio 1/11 < 0.1
    assert p[3] < 1.0  # ratio exactly 0.1 is kept
    assert p[4] == 1.0  # ratio == background
    assert p[5] == 1.0  # uncon 0
    assert p[6] is None  # no background: cannot be tested


def test_chi2_pvalue_matches_erfc(spark):
    rows = [(u, d, b) for (u, d, b) in [(5, 20, 0.01), (50, 100, 0.02), (300, 1000, 0.001), (12, 15, 0.3)]]
    df = spark.createDataFrame(rows, "uncon long, depth long, background double")
    for r in df.select("uncon", "depth", "background", fs.chi2_stat("uncon", "depth", "background").alias("x"),
                       fs.call_pvalue("uncon", "depth", "background").alias("p")).collect():
        b = max(1e-4, r["background"])
        eu, ec = r["depth"] * b, r["depth"] * (1 - b)
        x = (r["uncon"] - eu) ** 2 / eu + ((r["depth"] - r["uncon"]) - ec) ** 2 / ec
        assert r["x"] == pytest.approx(x, rel=1e-12)
        assert r["p"] == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9, abs=1e-300)


def test_binomial_upper_tail_exact(spark):
    from fractions import Fraction

    cases = [(0, 20), (3, 20), (20, 20), (5, 19), (1, 0), (7, 40)]
    df = spark.createDataFrame(cases, "k long, n long")
    got = {(r["k"], r["n"]): r["p"] for r in df.select("k", "n", fs.group_pvalue("k", "n", 0.01).alias("p")).collect()}
    p = Fraction(1, 100)
    for k, n in cases:
        if k <= 0 or n <= 0:
            exp = 1.0
        else:
            exp = float(sum(Fraction(math.comb(n, j)) * p ** j * (1 - p) ** (n - j) for j in range(k, n + 1)))
        assert got[(k, n)] == pytest.approx(exp, rel=1e-9, abs=1e-300)
    assert got[(3, 20)] == pytest.approx(0.00100357616810012, rel=1e-9)


def test_complement_routing_missing_tag(spark):
    df = spark.createDataFrame([(0, 100, 0, None), (0, 100, 0, 1)], "flag long, qlen long, sclen long, xm long")
    s = rd.accept_reject_split(df, rd.premap_accept_se()).collect()
    assert [r["ok"] for r in s] == [False, True]


def test_fit_recovers_noiseless_parameters():
    import numpy as np

    from sitecall.operators import fit

    x = np.array([0.0, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 1.0])
    true = (0.0002, 6.0, 0.05, 20.0, 0.45)
    y = fit.ratio_model(x, true)[0]
    assert np.max(np.abs(fit.ratio_model(x, fit.fit_points(x, y))[0] - y)) < 2e-3
    # two points are enough for a stage of three parameters, and five points with two of them below the limit for a fit
    two = fit.solve_in_box(x[[1, 5]], y[[1, 5]], fit.START, fit.LEVEL, 1000)
    assert np.max(np.abs(fit.ratio_model(x[[1, 5]], two)[0] - y[[1, 5]])) < 2e-3
    few = [1, 5, 8, 11, 14]
    assert np.all((fit.fit_points(x[few], y[few]) >= fit.LOWER) & (fit.fit_points(x[few], y[few]) <= fit.UPPER))


def test_model_slopes_equal_differences():
    import numpy as np

    from sitecall.operators import fit

    x, theta, h = np.linspace(0, 1, 9), np.array([0.0003, 5.0, 0.1, 30.0, 0.5]), 1e-6
    slopes = fit.ratio_model(x, theta)[1]
    for i in range(5):
        step = np.zeros(5)
        step[i] = h * max(theta[i], 1e-3)
        differences = (fit.ratio_model(x, theta + step)[0] - fit.ratio_model(x, theta - step)[0]) / (2 * step[i])
        assert np.allclose(slopes[:, i], differences, rtol=1e-4, atol=1e-8)


def test_fit_gates(spark):
    from sitecall.operators import background as bg

    gc = [0.2, 0.3, 0.4, 0.5, 0.6]
    groups = {"few_points": [(g, g) for g in gc[:4]], "constant": [(g, 0.1) for g in gc], "narrow": [(g, 0.1 + 0.001 * (g > 0.5)) for g in gc],
              "few_gc": [(0.2 + 0.1 * (i % 2), i / 10) for i in range(5)], "fit": [(g, g / 2) for g in gc]}
    rows = [("s", name, i, ratio, g, 1) for name, points in groups.items() for i, (g, ratio) in enumerate(points)]
    got = bg.fit_gates(spark.createDataFrame(rows, "sample string, motif3 string, gc_bin int, ratio double, gc double, count long"))
    assert {r["motif3"]: (r["gate"], r["n_points"]) for r in got.collect()} == {name: (name, len(p)) for name, p in groups.items()}


def test_reads_without_alignment_are_unmapped(spark):
    cols = "sample string, run string, read_id string, reftype string, flag long, qlen long, sclen long, xm long, ns long, nc long"
    aln = spark.createDataFrame([("s", "r", "a", "genome", 0, 50, 0, 0, 0, 0), ("s", "r", "b", "genome", 4, 50, 0, 0, 40, 0)], cols)
    reads = spark.createDataFrame([("s", "r", x, "ACGT") for x in "aabc"], "sample string, run string, read_id string, seq string")
    assert {r["read_id"]: r["stage"] for r in rd.reject_cascade(aln, reads=reads).collect()} == {"a": "genome", "b": "unmapped", "c": "unmapped"}


def test_motif3_first_two_t(spark):
    m = "N" * 14 + "TTT" + "N" * 14
    r = spark.createDataFrame([(m,)], "motif string").select(fm.motif3_rna("motif", 2).alias("a"), fm.motif3_rna("motif").alias("b")).first()
    assert (r["a"], r["b"]) == ("UUT", "UUU")


def test_ratio_round2_is_numpys(spark):
    """Ties go to the even hundredth of the double quotient, as np.round has them."""
    pairs = [(u, d) for d in range(0, 201) for u in range(0, d + 1, 1 if d < 60 else 7)] + [(57, 200), (1, 200), (3, 200)]
    df = spark.createDataFrame(pairs, "u long, d long")
    want = [None if d == 0 else int(round(float(np.round(u / d, 2)) * 100)) for u, d in pairs]
    assert [r[0] for r in df.select(fm.ratio_pct2("u", "d")).collect()] == want


def test_pool_treated(spark):
    rows = [("a-p-1", "c", 1, "+", "M", 1, 2), ("a-p-2", "c", 1, "+", "M", 3, 4), ("b", "c", 1, "+", "M", 5, 6)]
    out = {r["sample"]: (r["uncon"], r["depth"]) for r in calling.pool_treated(_sc(spark, rows), ["chrom", "pos", "strand", "motif"]).collect()}
    assert out == {"a-FTO": (4, 6), "b": (5, 6)}


def test_to_wide_to_long_roundtrip(spark):
    rows = [("a", "c", 1, "+", "M", 1, 2), ("b", "c", 2, "+", "M", 3, 4)]
    w = st.to_wide(_sc(spark, rows), ["a", "b"], ["chrom", "pos", "strand"])
    lg = {(r["pos"], r["sample"]): (r["uncon"], r["depth"]) for r in st.to_long(w, ["chrom", "pos", "strand"]).collect()}
    assert lg == {(1, "a"): (1, 2), (1, "b"): (0, 0), (2, "a"): (0, 0), (2, "b"): (3, 4)}


def test_called_wide_absent_library(spark):
    rows = [("a", "c", 1, "+", "M", "AAA", 40, 5, 20, 0.01, 0.25, 0.001)]
    df = spark.createDataFrame(rows, "sample string, chrom string, pos long, strand string, motif string, motif3 string, gc_pct long, "
                                     "uncon long, depth long, background double, ratio double, p double")
    r = calling.called_wide(df, ["a", "b"], ["chrom", "pos", "strand"]).first()
    assert (r["Uncon_a"], r["Depth_a"], r["p_a"]) == (5, 20, 0.001)
    assert (r["Uncon_b"], r["Depth_b"], r["p_b"], r["Background_b"]) == (0, 0, 1.0, None)
    assert math.isnan(r["Ratio_b"]) and r["GC"] == 0.4


def test_fit_depth_window_applies_to_points_only(spark):
    from sitecall.operators import background as bg

    m = "A" * 31
    rows = [("a", "c", 1, "+", m, 50_000, 200_000), ("a", "c", 2, "+", m, 3, 20)]
    sites = calling.prepare_sites(_sc(spark, rows))
    pts = bg.background_points(sites).collect()
    assert sum(r["count"] for r in pts) == 1  # depth 200000 is not a fit point
    params = bg.fallback_background(bg.background_points(sites))
    scored = calling.score_sites(bg.attach_background(sites, params)).collect()
    assert {r["pos"] for r in scored} == {1, 2}  # ...but it is still called
    assert [r["p"] for r in scored if r["pos"] == 1][0] < 1


def test_motif_without_points_has_no_parameters(spark):
    from sitecall.operators import background as bg

    with_pts = "A" * 31
    no_pts = "C" * 14 + "GAG" + "C" * 14
    rows = [("a", "c", 1, "+", with_pts, 3, 20), ("a", "c", 2, "+", no_pts, 0, 0), ("a", "c", 3, "+", no_pts, 9, 20)]
    sites = calling.prepare_sites(_sc(spark, rows))
    params = bg.fallback_background(bg.background_points(sites.where("pos < 3")))
    scored = {r["pos"]: r for r in calling.score_sites(bg.attach_background(sites, params)).collect()}
    assert scored[1]["background"] is not None
    assert scored[3]["background"] is None and scored[3]["p"] is None


def test_read_qc_position_stats(spark):
    from sitecall.operators import reads as rdx

    df = spark.createDataFrame([("s", "R1", "ACgN", "I5+!"), ("s", "R1", "AR", "II")], "sample string, mate string, seq string, qual string")
    got = {r["position"]: r for r in rdx.read_qc(df).collect()}
    assert (got[1]["reads"], got[1]["a"], got[1]["mean_quality"]) == (2, 2, 40.0)
    assert (got[2]["reads"], got[2]["c"], got[2]["n"]) == (2, 1, 0)  # R is neither C nor N
    assert (got[3]["g"], got[4]["n"], got[4]["mean_quality"]) == (1, 1, 0.0)
