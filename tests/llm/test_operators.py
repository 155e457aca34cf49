"""The text operators against brute force, and their defined results for odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitecall.llm import importance, jaccard, language, merkle, mixing, packing, quality_rules, suffix, toxicity, urls
from sitecall.llm.registry import load_all
from sitecall.testing import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
OPERATORS = {
    "language": lambda d: language.with_language(d, F.lit(True)),
    "mixing": mixing.mix_sources,
    "packing": packing.pack_documents,
    "quality": quality_rules.judge_quality,
    "suffix": suffix.remove_repeats,
    "jaccard": jaccard.jaccard_components,
    "merkle": merkle.fingerprints,
    "importance": lambda d: importance.resample(d, d.select("doc_id").limit(5)),
    "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.Model(b"", b"", ())),
}


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(none, name):
    assert OPERATORS[name](none).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"packing", "language"}))
def test_extra_columns_change_nothing(odd, name):
    more = odd.select("*", *[F.lit("?").alias(c) for c in ("size", "n", "core", "zone", "score", "h", "block", "votes", "row", "kept")])
    key = lambda df: sorted(map(str, df.collect()))
    assert key(OPERATORS[name](more)) == key(OPERATORS[name](odd))


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"suffix", "jaccard"}))
def test_null_ids_and_repeated_rows(spark, odd, name):
    more = odd.unionByName(odd.limit(8)).unionByName(odd.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    assert OPERATORS[name](more).count() >= more.count()


def test_null_ids_and_repeated_rows_of_the_joins(odd):
    more = odd.unionByName(odd.limit(8)).unionByName(odd.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    assert suffix.remove_repeats(more).filter("doc_id is null and n_removed > 0").count() == 0
    assert jaccard.jaccard_components(more).filter("doc_id is null and component_id is not null").count() == 0


def brute_suffix(rows):
    seen, out = set(), {}
    for k, text in sorted(rows):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            s = b[i : i + 100]
            if s in seen:
                gone[i : i + 100] = True
            seen.add(s)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[k] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("part", [1 << 19, 700])
def test_suffix_equals_brute_force(odd, odd_rows, monkeypatch, part):
    monkeypatch.setattr(suffix, "_PART", part)  # local workers are forked after this: long texts in parts
    got = by_id(suffix.remove_repeats(odd), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_suffix([(r[0], r[1]) for r in odd_rows])


def test_suffix_keeps_texts_of_one_id_apart(spark):
    rng = np.random.default_rng(8)
    text = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    b, c = text(900), text(200)
    rows = [(1, b), (2, c), (2, c + "!" + b), (2, c + "!" + b), (2, None), (3, "short")]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), result="kept").collect()
    kept = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept"]) for r in got)
    assert [x for x in kept if x[0] != 2] == [(1, 900, 0, b), (3, 5, 0, "short")]
    two = [x for x in kept if x[0] == 2]
    assert two[0] == (2, 0, 0, "") and two[2] == two[3] and {x[1] for x in two[1:]} == {200, 1101}
    whole = "" if two[2][2] == 1100 else c  # the copy of c that goes is the one with the larger hash
    assert two[2][3] == whole + "!" and two[1][3] == ("" if whole else c)


def test_anchor_parts_do_not_change_the_runs_covered():
    data = np.frombuffer((b"abcdefghij" * 40 + bytes(range(32, 127)) * 6), np.uint8)
    _, _, _, lo, last, _ = suffix.anchors(data, np.array([0, len(data)]))
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, last)])
    assert covered.tolist() == list(range(len(data) - 99))


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {k: shingles(t) for k, t in rows}
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(sets[k]), root(k)) for k in ids}


@pytest.mark.parametrize("limits", [(32, 256, 16), (2, 4, 3)])
def test_jaccard_equals_brute_force(odd, odd_rows, monkeypatch, limits):
    for name, value in zip(("PAIR_LIMIT", "ZONE_DOCS", "PIVOTS"), limits):
        monkeypatch.setattr(jaccard, name, value)
    assert by_id(jaccard.jaccard_components(odd), "n_shingles", "component_id") == brute_components([(r[0], r[1]) for r in odd_rows])


def test_zone_join_links_exactly():
    rng = np.random.default_rng(1)
    base = np.arange(100)
    sets = [np.sort(np.where(rng.random(100) < 0.08, base + 1000 * (i + 1), base)) for i in range(30)]
    got = jaccard.join_zone(list(range(30)), [None] * 30, sets)
    up = list(range(30))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in got:
        inter = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * inter >= 80 * (200 - inter)
        up[root(a)] = root(b)
    for a in range(30):
        for b in range(a):
            inter = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * inter < 80 * (200 - inter) or root(a) == root(b)


def test_mixing_meets_targets(odd):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count()
    by, longest = {}, {}
    for r in rows:
        key = (r["source"], r["target"], r["source_size"])
        longest[key] = max(longest.get(key, 0), r["size"])
        by[key] = by.get(key, 0) + r["taken"]
        assert r["taken"] <= 3 * r["size"]
    for key, taken in by.items():
        _, target, size = key
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= longest[key] / 2 + 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(odd).collect()))


def test_targets_are_reshared():
    t = mixing.share_targets({"a": 10, "b": 100, "c": 1000, None: 0})
    assert t["a"] == 30 and t[None] == 0 and sum(t.values()) == pytest.approx(1110)
    assert t["b"] == 300 and t["c"] == pytest.approx(780)


def test_fit_lengths_hits_the_budget():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 400, 30))
        counts = rng.integers(1, 9, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        take = mixing.fit_lengths(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert abs(budget - int((take * lengths).sum())) <= lengths.max() / 2 + 1


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    many = Counter(windows)
    repeat = {j for i, x in enumerate(windows) if many[x] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat)


def test_quality_counts_equal_brute_force(spark, odd, odd_rows):
    more = [(100, "a b\na b\n\n \n a b\na b", None, None, 1), (101, "a b c d e x a b c d e", None, None, 1), (102, "\n\nx # |\n\n", None, None, 1), (103, "tail\n", None, None, 1)]
    df = quality_rules.judge_quality(odd.unionByName(spark.createDataFrame(more, odd.schema)))
    got = by_id(df, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == {r[0]: brute_counts(r[1]) for r in [*odd_rows, *more]}
    for r in df.collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_votes_are_weighed_by_accuracy():
    post, right = quality_rules.fit_votes({"b---------": 70, "--------gg": 900, "--b--bb---": 30, "-b------gg": 3, "----------": 5})
    assert post["b---------"] < 0.5 < post["--------gg"] and post["--b--bb---"] < 0.5 < post["-b------gg"] and post["----------"] == 0.5
    assert ((right >= 0.5) & (right < 1)).all()


def test_packing_is_whole_and_gapless(odd, odd_rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = {}
    for k, text, *_ in odd_rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for p in range(-(-len(ids) // 2048)):
            part = ids[2048 * p : 2048 * p + 2048]
            want[k, p] = (2048 * p, len(part), zlib.crc32(part.tobytes()))
    rows = packing.pack_documents(odd).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(v[1] for v in want.values()) / 2048) + 1


def test_word_table_equals_the_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from sitecall.llm.common import text_view
    from sitecall.llm.tokens import WordIds

    texts = ["", "It's A.B. c, d.. 'tis e,\n.f , x<|endoftext|>y THE the. İstanbul Σίσυφος.", "a b\x1cc 12,3. ño é. ,", "<|EndOfText|> <|startoftext|>"]
    path = packing.tokenizer_path()
    tok, table = Tokenizer.from_file(path), WordIds(path)
    for _ in range(2):
        ids, at = table.encode_rows(*text_view(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_crossover_keeps_every_item():
    rng = np.random.default_rng(2)
    size = rng.integers(1, 900, 300).tolist()
    a = packing._pack(range(300), size, 2048)
    b = packing._pack(rng.permutation(300).tolist(), size, 2048)
    child = packing.crossover(a, b, size, 2048, rng)
    assert sorted(i for x in child for i in x) == list(range(300)) and all(sum(size[i] for i in x) <= 2048 for x in child)


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = load_all()["op3_language_id"].run(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()


def test_language_without_letters_is_unknown(odd):
    got = by_id(language.with_language(odd, F.lit(True)), "lang_pred", "score")
    assert all(got[k] == ("und", 0.0) for k in (4, 5, 8)) and all(0 <= s <= 1 for _, s in got.values())


def test_toxicity_tells_marked_words():
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 8))) for _ in range(400)]
    plain = [" ".join(rng.choice(vocab, 80)) for _ in range(400)]
    toxic = []
    for t in [" ".join(rng.choice(vocab, 80)) for _ in range(300)]:
        w = t.split()
        for i in rng.integers(0, 80, 6):
            w[i] = rng.choice(["vermin", "wretch", "scoundrel"])
        toxic.append(" ".join(w))
    model = toxicity.train([t.encode() for t in toxic[:200]], [t.encode() for t in plain[:300]])
    saved, w = toxicity._savings(model), np.array(model.weights)
    score = lambda t: float(np.array(toxicity._features(saved(t.encode()))) @ w)
    assert np.mean([score(t) > 0 for t in toxic[200:]]) > 0.9 and np.mean([score(t) > 0 for t in plain[300:]]) < 0.1


def test_toxicity_tells_inflected_words():
    rng = np.random.default_rng(6)
    word = lambda a, b: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(a, b)))
    vocab = [word(3, 8) for _ in range(400)]
    plain = [" ".join(rng.choice(vocab, 80)) for _ in range(400)]
    toxic = []
    for t in [" ".join(rng.choice(vocab, 80)) for _ in range(300)]:
        w = t.split()
        for i in rng.integers(0, 80, 6):
            w[i] = rng.choice(["vermintz", "wretchqu", "scoundrel"]) + word(4, 7)  # hardly a form occurs twice
        toxic.append(" ".join(w))
    model = toxicity.train([t.encode() for t in toxic[:200]], [t.encode() for t in plain[:300]])
    assert model.weights
    saved, w = toxicity._savings(model), np.array(model.weights)
    score = lambda t: float(np.array(toxicity._features(saved(t.encode()))) @ w)
    assert np.mean([score(t) > 0 for t in toxic[200:]]) > 0.9 and np.mean([score(t) > 0 for t in plain[300:]]) < 0.1


def test_toxicity_learns_from_few_and_spread_out_texts():
    rng = np.random.default_rng(7)
    word = lambda letters: "".join(rng.choice(list(letters), rng.integers(4, 9)))
    toxic = [" ".join(word("qrstuvwxyz") for _ in range(30)).encode() for _ in range(30)]  # no word occurs twice
    plain = [" ".join(word("abcdefghij") for _ in range(30)).encode() for _ in range(60)]
    for n in (1, 30):
        model = toxicity.train(toxic[:n], plain[: 2 * n])
        assert model.weights and model.toxic
        saved, w = toxicity._savings(model), np.array(model.weights)
        assert float(np.array(toxicity._features(saved(toxic[0]))) @ w) != 0
    assert not toxicity.train([], plain).weights and not toxicity.train(toxic, [b" "]).weights


def test_importance_log_weight_is_the_sum_over_n_grams(spark):
    rows = [(1, "a b c"), (2, "a b c " * 200), (3, "x y z"), (4, "x y z " * 200), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(importance.resample(docs, docs.filter("doc_id = 1").select("doc_id")), "n_grams", "log_weight")
    ratio = importance.log_ratio(importance.bucket_counts(docs.filter("doc_id = 1")), importance.bucket_counts(docs))
    for k, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        bucket = importance._row_buckets(raw, np.array([0, len(raw)]))[0]
        assert got[k] == (len(bucket), pytest.approx(float(ratio[bucket].sum())))
    assert got[2][1] > 100 * got[1][1] > 0 > got[3][1] > got[4][1] / 100


def test_importance_keeps_the_top_k(odd):
    out = importance.resample(odd, odd.filter("doc_id >= 22").select("doc_id"), keep=0.5).collect()
    k = math.floor(0.5 * len(out))
    best = sorted(out, key=lambda r: (-r["key"], r["doc_id"]))[:k]
    assert {r["doc_id"] for r in out if r["kept"]} == {r["doc_id"] for r in best}


def test_merkle_equals_sql(spark, sf):
    q = load_all()["op8_document_fingerprints"]
    assert compare(q.run(spark, sf), q.oracle, sf)[0]


def test_merkle_edited_text_by_hand(odd, odd_rows):
    got = by_id(merkle.fingerprints(odd), "n_chars", "edited_sha256", "fingerprint")
    rows = sorted((r[0], r[1] or "") for r in odd_rows)
    for (k, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[k][:2] == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert got[1][2] == got[2][2] != got[3][2]


def test_urls_equal_sql(spark, sf):
    q = load_all()["op1_url_filters"]
    assert compare(q.run(spark, sf), q.oracle, sf)[0]


def test_url_rules_and_propagation(spark):
    link = '<a href="//%s/x">'
    rows = [
        (1, "http://WWW.example.com/en/a?b#c", None), (2, "https://x.example.com/en/", ""), (3, "https://example.com", ""), (4, "http://a.net/es/1", link % "b.org"), (5, None, "x"), (6, "no scheme", None),
        (7, "http://c.org/p", link % "a.net"), (8, "http://d.org/q", ""), (9, "http://notcom/es/", ""), (10, "http://a.net/fr/1", ""), (11, "http://a.net/fr/2", ""), (12, "http://a.net/es/2", ""),
    ]
    rows += [(20 + i, f"http://a.net/es/{i}", "") for i in range(20)]
    got = {r["page_id"]: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert (got[2]["rule"], got[2]["verdict"]) == ("example.com/en/", "block")
    assert (got[3]["path"], got[3]["rule"]) == ("", None) and (got[5]["host"], got[6]["host"], got[6]["verdict"]) == ("", "", "allow")
    assert (got[4]["rule"], got[9]["rule"]) == ("net/es/", None)
    assert got[7]["verdict"] == "block" and got[8]["verdict"] == "allow"  # c.org links to a blocked host


def test_url_share_does_not_depend_on_open_pages(spark):
    link = '<a href="//%s/x">'
    rows = [(i, f"http://bad.net/es/{i}", "") for i in range(100)] + [(200, "http://one.org/p", link % "bad.net"), (201, "http://far.org/p", "")]
    rows += [(300 + i, f"http://many.org/{i}", link % "bad.net") for i in range(500)]
    rows += [(900, "http://good.com/", link % "seen.org")] + [(901 + i, f"http://seen.org/{i}", "") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = lambda d: {r["host"]: r["verdict"] for r in d.filter("rule is null").collect()}
    assert verdicts(urls.judge_urls(df)) == {"one.org": "block", "many.org": "block", "far.org": "allow", "seen.org": "allow"}


def test_urls_of_odd_rows(spark):
    """Repeated rows and null ids get equal values, further columns with the operator's own names change nothing."""
    rows = [(1, "http://a.net/es/1", None), (1, "http://a.net/es/1", None), (None, "http://b.a.net/x", "<a href='//a.net/'>"), (None, "http://b.a.net/x", "<a href='//a.net/'>"), (2, None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(str, urls.judge_urls(df).collect()))
    assert len(got) == 5 and len(set(got)) == 3 and sum("block" in x for x in got) == 4
    more = df.select("*", *[F.lit("?").alias(c) for c in ("host", "path", "rule", "by_rule", "rank", "kind", "t", "d", "n", "_host")])
    assert sorted(map(str, urls.judge_urls(more).collect())) == got


def test_urls_empty(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_registered_queries():
    names = set(load_all())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
