"""License scans, target resampling and the dataset manifest against brute force, and their defined results."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitecall.llm import licenses, manifest, target_sample
from sitecall.llm.positions import with_positions
from sitecall.llm.registry import load_all
from sitecall.testing import compare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("tree", "n", "idx", "node", "at", "w", "f", "up", "id", "one", "row", "same", "template", "label", "score", "rank", "leaf", "weight", "n_words", "_at", "_range", "steps")
OPERATORS = {
    "licenses": licenses.scan_licenses,
    "target": lambda d: target_sample.resample_to_target(d, d.select("text").limit(3)),
    "manifest": lambda d: manifest.manifest(d, manifest.tampered_rows()),
}


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def many(spark, odd):
    """Null ids, repeated rows, one id with several texts, and a text of more than a megabyte."""
    long = spark.createDataFrame([(90, "mit license " + "lorem ipsum dolor " * 80_000 + "GNU General Public License", "zz", "a", None)], SCHEMA)
    more = odd.unionByName(odd.limit(6)).unionByName(odd.limit(4).withColumn("doc_id", F.lit(None).cast("long")))
    return more.unionByName(odd.limit(3).withColumn("doc_id", F.lit(1).cast("long"))).unionByName(long)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(none, name):
    assert OPERATORS[name](none).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_change_nothing(odd, name):
    key = lambda df: sorted(map(str, df.collect()))
    assert key(OPERATORS[name](odd.select("*", *[F.lit("?").alias(c) for c in CLASHING]))) == key(OPERATORS[name](odd))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_has_one_result(many, name):
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(OPERATORS[name](many)) == ids(many)


@pytest.mark.parametrize("name", ["op11_license_scans", "op12_target_resampling", "op13_dataset_manifest"])
def test_query_matches_oracle(spark, sf, name):
    query = load_all()[name]
    ok, msg = compare(query.run(spark, sf), query.oracle, sf)
    assert ok, msg


# ---- license scans -------------------------------------------------------------------------------


def base_places(text):
    w = WORD.findall(lower(text))
    found = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at, labels = [i for i, _ in found], ",".join(sorted({x for _, x in found}))
    return len(w), len(found), min(at, default=None), max(at, default=None), labels


NOTICES = [
    (1, "Released under the MIT License. mit-license, MIT\tlicense! Apache\nLICENSE", "mit apache"),
    (2, "MIT  Licenses; general public licence; the general public license general public license", "gpl"),
    (3, licenses.NOTICES[10][0], "mit"),
    (4, "x y z " + licenses.NOTICES[10][0].replace("to deal in", "to gladly deal at once in") + " tail", "mit"),
    (5, "of the terms and the rights to use the software", ""),
    (6, "Alles All Rights Reserved ÄÖ", "proprietary"),
    (7, " ".join(licenses.NOTICES[12][0].split()[:12]), ""),
]


def test_licenses_against_brute_force(spark, many):
    docs = many.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t, _ in NOTICES], "doc_id long, text string"))
    got = licenses.scan_licenses(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    want = Counter((r["doc_id"], *base_places(r["text"])) for r in docs.collect())
    assert Counter(map(tuple, got)) == want


def test_notices_by_diagonals(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in NOTICES], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert {i: set(r["labels"].split(",")) - {""} for i, r in got.items()} == {i: set(x.split()) for i, _, x in NOTICES}
    assert got[3]["score"] == 1.0 and 0.75 <= got[4]["score"] < 1.0  # words put in: two diagonals, merged
    assert 0 < got[7]["score"] < 0.75 and all(0 <= r["score"] <= 1 for r in got.values())


def test_notice_repeated_beside_others_is_still_found(spark):
    notice = licenses.NOTICES[13][0]
    docs = spark.createDataFrame([(1, " ".join([notice] * 30)), (2, notice + " " + " ".join(notice.split()[5:9] * 20))], "doc_id long, text string")
    assert {r["labels"] for r in licenses.scan_licenses(docs).collect()} == {"bsd"}


# ---- target resampling ---------------------------------------------------------------------------


def brute_target(docs, target, share, min_words, buckets, seed, max_run=1):
    def feats(text):
        w = WORD.findall(lower(text))
        return len(w), [" ".join(w[i : i + k]) for k in range(1, max_run + 1) for i in range(len(w) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    src = Counter(bucket(f) for _, t in docs for f in feats(t)[1])
    tgt = Counter(bucket(f) for t in target for f in feats(t)[1])
    s_all, t_all = sum(src.values()), sum(tgt.values())
    rows = []
    for doc_id, text in docs:
        n, f = feats(text)
        total = sum(math.floor(1000 * math.log((tgt[bucket(x)] + 1) * (s_all + buckets) / ((src[bucket(x)] + 1) * (t_all + buckets)))) for x in f)
        weight = total // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    eligible = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(eligible[: share * len(eligible) // 100], 1):
        r[5] = rank
    return Counter((r[0], r[1], r[2], r[3], r[5]) for r in rows)


@pytest.mark.parametrize("share, buckets, max_run", [(10, 10_000, 1), (100, 50, 1), (50, 1000, 3), (0, 100, 1)])
def test_target_against_brute_force(odd, share, buckets, max_run):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    target = odd.filter("doc_id in (10, 11, 40)").select("text")
    got = target_sample.resample_to_target(odd, target, share=share, buckets=buckets, max_run=max_run)
    want = brute_target(docs, [r["text"] for r in target.collect()], share, 20, buckets, 2024, max_run)
    assert Counter(map(tuple, got.collect())) == want


def test_ties_at_the_cutoff(spark):
    """Ties of score go to smaller ids, null ids last; wholly repeated rows are drawn one by one, with ranks of their own."""
    text = "a b c d e f g h i j k l m n o p q r s t"
    docs = spark.createDataFrame([(7, text)] * 30 + [(None, text)] * 20 + [(7, "z " + text)] * 3, "doc_id long, text string").repartition(5)
    for share in (10, 50, 100):
        rows = target_sample.resample_to_target(docs, docs.limit(0), share=share).collect()
        ranked = sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])
        assert [r["rank"] for r in ranked] == list(range(1, share * 53 // 100 + 1))
        keys = [(-r["score"], r["doc_id"] is None, r["doc_id"]) for r in ranked]
        assert keys == sorted(keys) and all(-r["score"] >= keys[-1][0] for r in rows if not r["rank"])


def test_cut_finds_the_threshold_in_few_jobs(spark, monkeypatch):
    rows = spark.range(5000).select((F.col("id") * F.col("id") - 1_000_000).alias("up"))
    for want in (1, 2, 2500, 4999, 5000):
        assert target_sample._cut(rows, "up", want) == ((want - 1) ** 2 - 1_000_000, want - 1)


# ---- manifest ------------------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, fanout=2):
    """(root, steps of each node): a step is the list of (left, right) siblings from the leaf up."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, i in enumerate(at):
            run, k = runs[i // fanout], i % fanout
            steps[leaf].append((run[:k], run[k + 1 :]))
            at[leaf] = i // fanout
        nodes = [H(*r) for r in runs]
    return (nodes[0] if nodes else None), steps


def brute_manifest(rows, fanout=2):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: H(*map(field, (r[0], r[3], r[2], r[4] if r[4] is None else r[4] + more, r[1])))
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    parts = {x: sorted(by_lang[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in parts[x]], fanout) for x in langs}
    root, upper = tree([trees[x][0] for x in langs], fanout)
    out = []
    for lang, above in zip(langs, upper):
        subroot, steps = trees[lang]
        for r, own in zip(parts[lang], steps):
            path = own + above
            node = leaf(r, 1 if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 0 else 0)
            for left, right in path:
                node = H(*left, node, *right)
            out.append((r[0], leaf(r), subroot, root, H(*[x for a, b in path for x in a + b]), node, node == root))
    return Counter(out)


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_against_brute_force(many, fanout):
    rows = [tuple(r) for r in many.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = Counter(map(tuple, manifest.manifest(many, manifest.tampered_rows(), fanout).collect()))
    assert got == brute_manifest(rows, fanout)
    assert any(not k[-1] for k in got) and any(k[-1] for k in got)


@pytest.mark.parametrize("size", [1, 3])
def test_manifest_of_few_rows(spark, size):
    rows = [(i, f"text {i}", "ü", None, i) for i in range(size)]
    got = Counter(map(tuple, manifest.manifest(spark.createDataFrame(rows, SCHEMA), manifest.tampered_rows()).collect()))
    assert got == brute_manifest(rows)


def test_positions_count_within_trees(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("b"), F.col("id") % 7)).alias("tree"), (-F.col("id")).alias("key"))
    got = with_positions(rows, "tree", [F.col("key")], "t").collect()
    groups = defaultdict(list)
    for r in got:
        groups[r["tree"]].append(r)
    assert len(got) == 3000
    for g in groups.values():
        g.sort(key=lambda r: r["key"])
        assert [r["idx"] for r in g] == list(range(len(g))) and {r["n"] for r in g} == {len(g)}
