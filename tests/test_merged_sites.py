"""The merged site table: one window over the sites, sites lifted in one pass, rows equal to a plain computation."""

import random
from collections import defaultdict

import pytest

from sitecall.operators import liftover
from sitecall.operators.merge import base_size, merge_order

LONG = "sample string, chrom string, pos long, strand string, motif string, uncon long, depth long"
LIFTED = "chrom string, pos long, strand string, gene_name string, gene_pos long, motif string, sample string, uncon long, depth long"
SAMPLES, REQUIRES = ("s0", "s1", "s2", "s3"), (0, 1, 1, 1)


def _rows():
    rng = random.Random(5)
    site = lambda: (rng.choice(["chr1", "chr2", None]), rng.choice([*range(12), None]), rng.choice("+-"))
    count = lambda: rng.choice([0, 1, 2, 5, None])
    genome = {(rng.choice([*SAMPLES, "other"]), *site()): (rng.choice(["AAA", "CCC", None]), count(), count()) for _ in range(160)}
    genes = {(*site(), rng.choice(["g1", "g2", "g10", None]), rng.choice([3, 20, None]), rng.choice(SAMPLES)): (count(), count()) for _ in range(160)}
    # one motif a lifted position, as the transcript merge has it
    lifted = [(*k[:5], f"M{k[3]}{k[4]}", k[5], *v) for k, v in genes.items()]
    return [(*k, *v) for k, v in genome.items()], lifted


def _plain(genome, lifted, min_depth):
    ordered = merge_order(SAMPLES, REQUIRES)
    rank, k = {s: i for i, (s, _) in enumerate(ordered)}, base_size(ordered)
    at, tx = defaultdict(list), defaultdict(list)
    for s, c, p, d, motif, u, n in genome:
        if s in rank:
            at[c, p, d].append((rank[s], motif, s, u, n))
    for c, p, d, gene, gp, motif, s, u, n in lifted:
        tx[c, p, d].append((gene, gp, motif, s, u, n))
    null_first = lambda x: (x is not None, x if x is not None else 0)
    name_first = lambda x: (x is not None, x or "")
    total = lambda xs: sum(x for x in xs if x is not None) if any(x is not None for x in xs) else None
    out = {}
    for site in {*at, *tx}:
        g, t = sorted(at[site], key=lambda r: r[0]), sorted(tx[site], key=lambda r: (name_first(r[0]), null_first(r[1])))
        base = [r for r in g if r[0] < k]
        if not base or max((r[4] or 0) for r in base) < 3:
            g_kept = []
        else:
            g_kept = g
        depth = total([r[-1] for r in t] + [r[-1] for r in g_kept])
        if depth is None or depth < min_depth:
            continue
        motif = t[0][2] if t else next((r[1] for r in g if r[1] is not None), None)
        firsts = {}
        for gene, gp, *_ in t:
            if gene is not None:
                firsts.setdefault(gene, gp)
        names = ";".join(firsts)
        places = ";".join(str(gp) for gp in firsts.values() if gp is not None)
        for s in {r[-3] for r in [*t, *g_kept]}:
            mine = [r for r in [*t, *g_kept] if r[-3] == s]
            out[(*site, names, places, motif, s)] = (total([r[-2] for r in mine]), total([r[-1] for r in mine]))
    return out


@pytest.mark.parametrize("min_depth", [0, 1, 5])
def test_merged_rows_equal_a_plain_computation(spark, min_depth):
    genome, lifted = _rows()
    got = liftover.merge_lifted_with_genome(
        spark.createDataFrame(lifted, LIFTED), spark.createDataFrame(genome, LONG), SAMPLES, REQUIRES, 3, min_depth).collect()
    rows = {tuple(r)[:7]: tuple(r)[7:] for r in got}
    assert len(rows) == len(got) > 50
    assert rows == _plain(genome, lifted, min_depth)


def test_merged_sites_are_sorted_and_windowed_once(spark):
    genome, lifted = _rows()
    out = liftover.merge_lifted_with_genome(spark.createDataFrame(lifted, LIFTED), spark.createDataFrame(genome, LONG), SAMPLES, REQUIRES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("- Window [") == 1 and plan.count("- Sort [") == 1 and plan.count("Exchange ") == 1


def test_sites_are_read_once_with_a_large_annotation(spark, tmp_path):
    """Unknown genes, known ones without an exon there and missing ones, in one pass over the sites."""
    sites = [("s1", g, p, "+", "m", 1, 2) for g in ("a", "b", "odd", "unknown", None) for p in (1, 5, 15, 250, None)]
    spark.createDataFrame(sites, LONG).write.parquet(f"{tmp_path}/sites")
    spans = [("a", "c1", "+", "11-20,101-110"), ("a", "c2", "-", "1-10"), ("b", "c1", "-", "1-300"), (None, "c1", "+", "1-300")]
    ex = liftover.exon_offsets(spark.createDataFrame(spans, "gene_id string, chrom string, strand string, spans string"))
    odd = ex.where("gene_name = 'b'").selectExpr(*[
        f"cast(null as {t}) as {c}" if c in ("tx_start", "tx_end") else "'odd' as gene_name" if c == "gene_name" else c for c, t in ex.dtypes])
    ex = ex.unionByName(odd)
    read = spark.read.parquet(f"{tmp_path}/sites")
    large, small = (liftover.liftover_sites(read, ex, limit, 7) for limit in (0, 1 << 26))
    assert large._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, large.collect())) == sorted(map(key, small.collect()))
    assert {r["gene_name"] for r in large.collect()} == {"a", "b", "unknown", None}
