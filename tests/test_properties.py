"""Property tests (Hypothesis, few examples: each one runs Spark jobs)."""

from hypothesis import given, settings
from hypothesis import strategies as hst

from sitecall.operators import liftover, report

SETTINGS = settings(max_examples=6, deadline=None)


@SETTINGS
@given(hst.lists(hst.tuples(hst.integers(0, 60), hst.integers(0, 50)), min_size=1, max_size=40))
def test_ratio_histogram_total_equals_valid_rows(spark, pairs):
    df = spark.createDataFrame([("s", u, d) for u, d in pairs], "sample string, uncon long, depth long")
    total = sum(r["count"] for r in report.ratio_histogram(df).collect())
    assert total == sum(1 for u, d in pairs if d > 0 and u <= d)


@SETTINGS
@given(hst.lists(hst.tuples(*[hst.integers(0, 1000)] * 6), min_size=1, max_size=5))
def test_hierarchy_segments_sum_to_raw_when_unclamped(spark, rows):
    recs = []
    for i, (contam, mask, tp, gp, extra_clean, extra_raw) in enumerate(rows):
        td, gd = tp // 2, gp // 3
        clean = contam + mask + tp + gp + extra_clean
        recs.append((f"s{i}", clean + extra_raw, clean, contam, mask, tp, td, gp, gd))
    cols = "sample string, Raw long, Clean long, Contamination_Passed long, Masking_Passed long, Transcript_Passed long, Transcript_Dedup long, Genome_Passed long, Genome_Dedup long"
    df = spark.createDataFrame(recs, cols)
    for r, rec in zip(sorted(report.read_hierarchy(df).collect(), key=lambda r: r["sample"]), sorted(recs)):
        segs = r["unique_mapped"] + r["duplicates"] + r["masking"] + r["contamination"] + r["unmapped"] + r["discarded_short"]
        assert segs == rec[1]


@SETTINGS
@given(hst.integers(1, 1000), hst.sampled_from(["+", "-"]), hst.lists(hst.integers(1, 40), min_size=1, max_size=4))
def test_liftover_is_invertible_inside_exons(spark, start, strand, lens):
    spans, s = [], start
    for n in lens:
        spans.append((s, s + n - 1))
        s += n + 7
    if strand == "-":
        spans = spans[::-1]
    tx = spark.createDataFrame([("G", "c", strand, ",".join(f"{a}-{b}" for a, b in spans))], "gene_id string, chrom string, strand string, spans string")
    ex = liftover.exon_offsets(tx)
    total = sum(lens)
    sites = spark.createDataFrame([("x", "G", p, "+", "M", 1, 2) for p in range(1, total + 1)],
                                  "sample string, chrom string, pos long, strand string, motif string, uncon long, depth long")
    lifted = liftover.liftover_sites(sites, ex).collect()
    assert len(lifted) == total
    genome = {r["gene_pos"]: r["pos"] for r in lifted}
    # inverse: genome position -> transcript position through the listed spans
    inv = {}
    off = 0
    for a, b in spans:
        for g in range(a, b + 1):
            inv[g] = off + (g - a + 1) if strand == "+" else off + (b - g + 1)
        off += b - a + 1
    assert all(inv[genome[p]] == p for p in genome)
