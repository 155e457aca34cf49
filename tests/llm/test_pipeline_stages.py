"""The pipeline's stages on odd rows: columns, decisions and whole results."""

import corpus_pipeline
from pyspark.sql import functions as F


def test_stages_take_effect(spark, odd):
    docs = odd.withColumn("score", F.lit(1)).withColumn("copies", F.lit("z"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.staged(stage(spark, docs, "/none"), "stage-test")
        seen[name] = (docs, after)
        if name != "best-fit packing":
            assert after.columns == docs.columns
        docs = after
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    _, told = seen["language ID"]
    assert {4, 5, 8}.isdisjoint(ids(told)) and {1, 2, 10, 22, 40} <= set(ids(told))
    _, joined = seen["n-gram Jaccard join"]
    assert 1 in ids(joined) and {2, 3, 22, 30}.isdisjoint(ids(joined)) and {10, 11, 12} <= set(ids(joined))
    before, cut = seen["suffix-array dedup"]
    assert ids(before) == ids(cut)
    length = lambda df: df.agg(F.sum(F.length("text"))).first()[0]
    assert length(cut) < length(before)
    _, mixed = seen["mixing sources to target weights"]
    packed = seen["best-fit packing"][1]
    assert packed.filter("piece = 0").count() == mixed.count()


def test_stages_of_an_empty_table(spark, none):
    docs = none
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, "/none"), "empty-test")
        assert docs.count() == 0, name


def test_repeated_rows_and_clashing_columns(spark, odd):
    """One row of each (doc_id, text) stays, null ids included; columns with the stages' own names pass through."""
    names = ("gone", "id", "copies", "row", "h1", "h2", "r_id", "_gone", "_id", "_copies", "_again", "col", "n")
    more = odd.unionByName(odd.limit(6)).unionByName(odd.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    more = more.unionByName(odd.filter("doc_id = 10").withColumn("doc_id", F.lit(None).cast("long")))
    docs = more.select("*", *[F.lit(c).alias(c) for c in names])
    stages = dict(corpus_pipeline.STAGES)
    joined = corpus_pipeline.staged(stages["n-gram Jaccard join"](spark, docs, "/none"), "stage-test")
    assert joined.columns == docs.columns
    kept = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in joined.select("doc_id", "text").collect())
    assert len(kept) == len(set(kept))
    texts = lambda df, some: {(r["doc_id"], r["text"]) for r in df.filter(some).collect()}
    assert texts(joined, "doc_id is null") == texts(docs, "doc_id is null")
    plain = corpus_pipeline.staged(stages["n-gram Jaccard join"](spark, odd, "/none"), "stage-test")
    assert texts(joined, "doc_id < 90") == texts(plain, "doc_id < 90")
    mixed = corpus_pipeline.staged(stages["mixing sources to target weights"](spark, joined, "/none"), "stage-test")
    assert mixed.columns == docs.columns and mixed.filter(" or ".join(f"`{c}` <> '{c}'" for c in names)).count() == 0
