"""Gapped alignments: CIGAR offsets, pileup and lifting against base-by-base brute force, deduplication by fragment."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitecall.functions import cigar as cg
from sitecall.operators import gapped, liftover
from sitecall.operators import reads as rd
from sitecall.sources import files

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def steps(cigar):
    """(op, query offset or None, reference offset or None) base by base."""
    q = r = 0
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        for _ in range(int(n)):
            yield op, q if op in "MIS=X" else None, r if op in "MDN=X" else None
            q += op in "MIS=X"
            r += op in "MDN=X"


def random_cigar(rng, length=30, ops="MMM=XIDS", intron=False):
    """A CIGAR that starts and ends in clips or matches, consuming ``length`` query bases."""
    parts, left = [], length
    if rng.random() < 0.3:
        parts.append((2, "H"))
    if rng.random() < 0.4:
        parts.append((3, "S"))
        left -= 3
    while left > 9:
        n = rng.randint(1, 6)
        parts.append((n, rng.choice("M=X")))
        left -= n
        op = rng.choice("IDN" if intron else "ID")
        n = rng.randint(1, 2) if op != "N" else 40
        if op == "I":
            left -= n
        parts.append((n, op))
    parts.append((left, "M"))
    return "".join(f"{n}{op}" for n, op in parts)


def test_operations_and_lengths(spark):
    rng = random.Random(1)
    cigars = [random_cigar(rng, intron=True) for _ in range(60)] + ["*", None, "10M5S3H"]
    rows = spark.createDataFrame([(c,) for c in cigars], "cigar string").withColumn("ops", cg.cigar_ops("cigar"))
    for r in rows.select("cigar", "ops", cg.ops_length("ops", cg.QUERY_OPS).alias("q"), cg.ops_length("ops", cg.REF_OPS).alias("r")).collect():
        s = list(steps(r["cigar"] or ""))
        assert (r["q"], r["r"]) == (sum(x[1] is not None for x in s), sum(x[2] is not None for x in s))
        q = p = 0
        for o in r["ops"]:
            assert (o["q"], o["r"]) == (q, p)
            q += o["len"] * (o["op"] in cg.QUERY_OPS)
            p += o["len"] * (o["op"] in cg.REF_OPS)
    for bad in ("5", "M5", "5M3Q", "5M 3D", ""):
        with pytest.raises(Exception, match="not a CIGAR"):
            spark.createDataFrame([(bad,)], "cigar string").select(cg.cigar_ops("cigar")).collect()


def test_unclipped_five_prime(spark):
    rows = [("3S10M2S", 100, False, 97), ("3S10M2S", 100, True, 111), ("1H2S5M3D5M1H", 100, False, 97), ("1H2S5M3D5M1H", 100, True, 113), ("8M", 5, True, 12)]
    df = spark.createDataFrame(rows, "cigar string, pos long, reverse boolean, want long")
    assert df.where(cg.unclipped_five_prime(cg.cigar_ops("cigar"), "pos", "reverse") != F.col("want")).count() == 0


def test_sam_tags_of_any_type(spark, tmp_path):
    lines = ["@HD\tVN:1.6", "r1\t99\tc\t7\t60\t4M\t=\t30\t27\tACGT\tIIII\tXM:Z:x:y\tNS:i:3\tNS:i:9\tRX:Z:AC\tYf:i:2\tZf:i:-1\tML:B:C,1,2",
             "r2\t4\t*\t0\t0\t*\t*\t0\t0\tACGTA\t*", "r3\t16\tc\t1\t1\t1S2M\td\t5\t0\t*\t*\tXM:i:4\tRX:Z:"]
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    got = {r["read_id"]: r for r in files.scan_alignments(spark, str(tmp_path)).collect()}
    a, b, c = got["r1"], got["r2"], got["r3"]
    assert (a["xm"], a["ns"], a["yf"], a["zf"], a["umi"], a["tags"]["XM"]["value"], a["tags"]["ML"]["type"]) == (None, 3, 2, -1, "AC", "x:y", "B")
    assert (a["mate_chrom"], a["mate_pos"], a["seq"], a["qual"], a["qlen"]) == ("c", 30, "ACGT", "IIII", 4)
    assert (b["mate_chrom"], b["mate_pos"], b["seq"], b["qual"], b["qlen"], b["ops"], b["tags"]) == (None, None, "ACGTA", None, 5, [], {})
    assert (c["strand"], c["mate_chrom"], c["mate_pos"], c["seq"], c["qlen"], c["sclen"], c["xm"], c["umi"]) == ("-", "d", 5, None, 3, 1, 4, "")


# ---- pileup --------------------------------------------------------------------------------------


def _tiles(spark, genome, tile, margin):
    rows = []
    for name, seq in genome.items():
        padded = "N" * margin + seq + "N" * (tile + margin)
        rows += [(name, None, len(seq), t, padded[t * tile : (t + 1) * tile + 2 * margin]) for t in range(-(-len(seq) // tile))]
    return spark.createDataFrame(rows, "name string, description string, length long, tile long, bases string")


@pytest.fixture(scope="module")
def aligned():
    rng = random.Random(2)
    genome = {c: "".join(rng.choice("ACGTacgtN") for _ in range(n)) for c, n in (("a", 300), ("b", 64))}
    rows = []
    for i in range(400):
        c = "a" if rng.random() < 0.8 else "b"
        x = 100 if i % 3 == 0 else rng.randint(1, len(genome[c]) - 5)  # a third of the reads on one place, some past the end
        seq = "".join(rng.choice("ACGT") for _ in range(30))
        rows.append((f"s{i % 2}", f"r{i}", c, min(x, len(genome[c])), rng.choice([0, 16, 99, 147, 83, 163, 4, 256, 1024, 2048]), random_cigar(rng, intron=True), seq, rng.choice([1, 5, 9, None]), rng.randint(0, 4)))
    return genome, rows


ALN = "sample string, read_id string, chrom string, pos long, flag long, cigar string, seq string, yf long, zf long"


def brute_pileup(genome, rows, ref, mut):
    counts = defaultdict(lambda: [0] * 6)
    for sample, _, chrom, pos, flag, cigar, seq, yf, zf in rows:
        if flag & (4 | 256 | 512 | 1024 | 2048):
            continue
        minus = bool(flag & 16) != (flag & 129 == 129)
        tier = 0 if yf is not None and yf + zf < 5 else 1 if zf <= 2 else 2
        g = genome[chrom].upper()
        for op, q, r in steps(cigar):
            if op in "M=X" and pos - 1 + r < len(g):
                x = pos - 1 + r
                a, b = (g[x], seq[q]) if not minus else (g[x].translate(COMPLEMENT), seq[q].translate(COMPLEMENT))
                if a == ref:
                    n = counts[sample, chrom, x + 1, "-" if minus else "+"]
                    n[tier] += b == ref
                    n[3 + tier] += b == mut
    out = {}
    for (s, c, p, strand), n in counts.items():
        around = ("N" * 15 + genome[c] + "N" * 15)[p - 1 : p + 30]
        motif = around if strand == "+" else around[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca"))
        out[s, c, p, strand] = (motif, *n)
    return out


@pytest.mark.parametrize("tile, margin, limit", [(16, 15, 1 << 26), (64, 20, 0), (1000, 15, 1 << 26)])
@pytest.mark.parametrize("ref, mut", [("A", "G"), ("C", "T")])
def test_pileup_equals_brute_force(spark, aligned, tile, margin, limit, ref, mut):
    genome, rows = aligned
    got = gapped.pileup_counts(spark.createDataFrame(rows, ALN).repartition(5), _tiles(spark, genome, tile, margin), ref, mut, tile=tile, margin=margin, broadcast_max_bytes=limit)
    cells = ("u0", "u1", "u2", "m0", "m1", "m2")
    got = {(r["sample"], r["chrom"], r["pos"], r["strand"]): (r["motif"], *[r[c] for c in cells]) for r in got.collect()}
    assert got == brute_pileup(genome, rows, ref, mut)


def test_a_large_reference_is_shuffled_and_counts_summed_below_one_shuffle(spark, aligned):
    genome, rows = aligned
    aln, tiles = spark.createDataFrame(rows, ALN), _tiles(spark, genome, 16, 15)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [gapped.pileup_counts(aln, tiles, tile=16, broadcast_max_bytes=n)._jdf.queryExecution().executedPlan().toString() for n in (1 << 26, 0)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("BroadcastHashJoin") == 2 and plans[0].count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" not in plans[1]
    assert all(p.index("Exchange hashpartitioning(sample") < p.index("partial_sum") < p.index("MapInArrow") for p in plans)


# ---- lifting -------------------------------------------------------------------------------------


def brute_lift(row, gene):
    """(chrom, pos, cigar, seq, qual) by each base's own genome position."""
    chrom, strand, spans = gene
    place = [x for a, b in spans for x in (range(a - 1, b) if strand == "+" else range(b - 1, a - 2, -1))]
    line = []
    for op, q, r in steps(row["cigar"]):
        at = row["pos"] - 1 + r if r is not None else None
        if at is not None and at >= len(place):
            if op != "D":
                line.append(("S", None))
        elif at is not None:
            line.append((op, place[at]))
        else:
            line.append((op, None))
    # what is inserted or clipped past the end is clipped too
    seen = 0
    fixed = []
    done = False
    for (op, g), (o, q, r) in zip(line, [s for s in steps(row["cigar"]) if not (s[2] is not None and row["pos"] - 1 + s[2] >= len(place) and s[0] == "D")]):
        seen = row["pos"] - 1 + r + 1 if r is not None else seen or row["pos"] - 1
        done = done or seen >= len(place)
        fixed.append(("S" if op == "I" and seen >= len(place) else op, g))
    if strand == "-":
        fixed = fixed[::-1]
    if not any(op in "M=X" for op, _ in fixed):
        return None
    out, prev = [], None
    for op, g in fixed:
        if g is not None and prev is not None and g - prev > 1:
            out.append([g - prev - 1, "N"])
        if out and out[-1][1] == op:
            out[-1][0] += 1
        else:
            out.append([1, op])
        prev = g if g is not None else prev
    first = min(g for _, g in fixed if g is not None)
    turn = (lambda x: x) if strand == "+" else (lambda x: x[::-1])
    return chrom, first + 1, "".join(f"{n}{o}" for n, o in out), turn(row["seq"]).translate(COMPLEMENT) if strand == "-" else row["seq"], turn(row["qual"])


@pytest.fixture(scope="module")
def genes():
    rng = random.Random(6)
    out = {}
    for i in range(12):
        cuts = sorted(rng.sample(range(1, 500), 2 * rng.randint(1, 6)))
        spans = list(zip(cuts[::2], cuts[1::2]))
        strand = rng.choice("+-")
        out[f"g{i}"] = (rng.choice("ab"), strand, spans[::-1] if strand == "-" else spans)
    giant = [(1000 * k + 1, 1000 * k + 30) for k in range(400)]  # 12,000 bases in 400 exons
    out["giant"] = ("c", "+", giant)
    out["touching"] = ("c", "-", [(51, 60), (41, 50), (11, 20)])  # no intron between the first two
    return out


@pytest.mark.parametrize("limit, width", [(1 << 26, 1000), (0, 60), (0, 1000)])
def test_lifting_equals_position_wise(spark, genes, limit, width):
    rng = random.Random(7)
    rows = []
    for i in range(500):
        name = rng.choice([*genes, "giant", "unknown"])
        size = sum(b - a + 1 for a, b in genes[name][2]) if name in genes else 100
        rows.append((f"r{i}", name, rng.randint(1, size + 5), rng.choice([0, 16, 4]), random_cigar(rng), "".join(rng.choice("ACGT") for _ in range(30)), "".join(rng.choice("ABCDE") for _ in range(30))))
    aln = spark.createDataFrame(rows, "read_id string, chrom string, pos long, flag long, cigar string, seq string, qual string")
    spans = spark.createDataFrame([(n, c, s, ",".join(f"{a}-{b}" for a, b in e)) for n, (c, s, e) in genes.items()], "gene_id string, chrom string, strand string, spans string")
    got = {r["read_id"]: r for r in gapped.lift_alignments(aln, liftover.exon_offsets(spans), limit, width).collect()}
    want = {}
    for r in aln.collect():
        if not r["flag"] & 4 and r["chrom"] in genes and (lifted := brute_lift(r, genes[r["chrom"]])):
            want[r["read_id"]] = (*lifted, r["flag"] ^ (16 if genes[r["chrom"]][1] == "-" else 0), r["chrom"])
    assert {k: (r["chrom"], r["pos"], r["cigar"], r["seq"], r["qual"], r["flag"], r["gene"]) for k, r in got.items()} == want
    assert len(want) > 200 and any("N" in w[2] for w in want.values())
    assert all(r["n_blocks"] == r["cigar"].count("N") + 1 and (r["strand"] == "-") == bool(r["flag"] & 16) for r in got.values())


def test_bins_hold_few_exons_of_a_giant_gene(spark, genes):
    spans = spark.createDataFrame([("giant", "c", "+", ",".join(f"{a}-{b}" for a, b in genes["giant"][2]))], "gene_id string, chrom string, strand string, spans string")
    bins = gapped.binned_exons(liftover.exon_offsets(spans), 60)
    assert bins.select(F.max(F.size("exons"))).first()[0] <= 4 * 6 and bins.count() >= 200


def test_sites_by_bins_equal_the_broadcast(spark, genes):
    rng = random.Random(9)
    rows = [("s", rng.choice([*genes, "giant", "unknown"]), rng.randint(1, 13_000 if i % 2 else 300), "+", "m", 1, 2) for i in range(600)]
    sites = spark.createDataFrame(rows, "sample string, chrom string, pos long, strand string, motif string, uncon long, depth long")
    spans = spark.createDataFrame([(n, c, s, ",".join(f"{a}-{b}" for a, b in e)) for n, (c, s, e) in genes.items()], "gene_id string, chrom string, strand string, spans string")
    ex = liftover.exon_offsets(spans)
    whole, binned = (Counter(map(tuple, liftover.liftover_sites(sites, ex, limit, 100).collect())) for limit in (1 << 26, 0))
    assert whole == binned and sum(whole.values()) > 200


# ---- deduplication -------------------------------------------------------------------------------

RECORD = "sample string, run string, reftype string, read_id string, chrom string, pos long, strand string, flag long, qlen long, sclen long, umi string, mapq long"


def _pair(name, a, b, umi="AC", mapq=30, run="run1"):
    """A proper pair whose 5' ends are a (forward first mate) and b (reverse second mate)."""
    return [("s", run, "genome", name, "c", a, "+", 99, 50, 0, umi, mapq), ("s", run, "genome", name, "c", b - 49, "-", 147, 50, 0, umi, mapq)]


def test_pairs_with_another_mate_start_are_no_duplicates(spark):
    rows = _pair("A", 100, 300) + _pair("B", 100, 1000) + _pair("C", 100, 300, mapq=20)
    kept, sets = rd.dedup_alignments(spark.createDataFrame(rows, RECORD))
    assert Counter(r["read_id"] for r in kept.collect()) == {"A": 2, "B": 2}
    assert sorted((r["set_size"], r["records"], r["kept_records"]) for r in sets.collect()) == [(1, 2, 2), (2, 4, 2)]
    assert rd.dedup_report(sets).first()[2:5] == (6, 2, 4)


def test_mates_stay_or_go_together(spark):
    """The better second mate of one pair must not win beside the better first mate of another."""
    a, b = _pair("A", 100, 300, mapq=10), _pair("B", 100, 300, mapq=12)
    rows = [(*a[0][:-1], 60), a[1], b[0], (*b[1][:-1], 40)]
    kept, _ = rd.dedup_alignments(spark.createDataFrame(rows, RECORD))
    assert [r["read_id"] for r in kept.collect()] == ["A", "A"]


def test_umis_runs_and_single_reads(spark):
    rows = _pair("A", 100, 300) + _pair("A", 100, 300, run="run2") + _pair("B", 100, 300, umi="GG") + [("s", "run1", "genome", n, "c", 100, "+", 0, 50, 0, "AC", 5) for n in ("x", "y")]
    kept, _ = rd.dedup_alignments(spark.createDataFrame(rows, RECORD))
    assert Counter((r["read_id"], r["run"]) for r in kept.collect()) == {("A", "run1"): 2, ("B", "run1"): 2, ("x", "run1"): 1}
