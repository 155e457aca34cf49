"""Corpus pipeline: language ID, n-gram Jaccard join, suffix-array dedup, source mixing, best-fit packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All stages but
the last return the columns of their input; further columns of ``documents`` pass through. ``run`` writes each
stage's result to the shared scratch folder as Parquet and reads it again.

Rows with the same doc_id are one document to the join of stage 2 and the mix of stage 4: they stay or go, and
are repeated, together; of those that also have the same text, stage 2 keeps one, null ids included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecall.llm import jaccard, language, mixing, packing, suffix
from sitecall.llm.common import staged

#: A document whose best language profile is farther than this (score is 1 - relative distance) is in none of them.
MIN_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every learnt language, go. Learns from all rows with a lang."""
    profiles = language.train_profiles(docs)
    others = [c for c in docs.columns if c != "text"]
    judged = language.identify_language(docs.select(F.struct(*others).alias("row"), "text"), profiles, passed=("row", "text"))
    kept = judged.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns])


def _without_repeats(rows: DataFrame) -> DataFrame:
    """One row of each (doc_id, text), null ids included; ``rows`` has the one column row. Only repeated rows are shuffled
    whole, after a partial aggregate in their task."""
    key = [F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("h1"), F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("h2")]
    again = rows.select(*key).groupBy("id", "h1", "h2").agg(F.count("*").alias("n")).filter("n > 1")
    again = staged(again.select(*[F.col(c).alias(f"r_{c}") for c in ("id", "h1", "h2")]), "pipeline-repeats")
    keyed = rows.select("row", *key)
    same = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("h1") == F.col("r_h1")) & (F.col("h2") == F.col("r_h2"))
    one = keyed.join(again, same, "left_semi").groupBy("id", "h1", "h2").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return keyed.join(again, same, "left_anti").select("row").unionByName(one.select("row"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents, the one with the smallest doc_id stays; of rows with the same id and text,
    null ids included, one."""
    found = jaccard.jaccard_components(docs)
    gone = staged(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "pipeline-gone")
    rows = docs.select(F.struct(*docs.columns).alias("row")).join(gone, F.col("row.doc_id") == F.col("gone"), "left_anti")
    return _without_repeats(rows).select("row.*")


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte covered by a 100-byte string that starts earlier is cut out of the texts; n_chars follows."""
    others = [c for c in docs.columns if c != "text"]
    row = docs.select("doc_id", F.struct(*others).alias("row"), "text")
    cut = suffix.remove_repeats(row, passed=("doc_id", "row"), result="kept")
    values = {c: F.col(f"row.{c}") for c in others} | {"text": F.col("kept")}
    if "n_chars" in values:
        values["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[values[c].alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents that the mix does not take go."""
    mix = mixing.mix_sources(docs).groupBy(F.col("doc_id").alias("id")).agg(F.max(F.when(F.col("size") > 0, F.col("copies")).otherwise(0)).alias("copies"))
    mix = staged(mix.filter("copies > 0"), "pipeline-mix")
    kept = docs.select(F.struct(*docs.columns).alias("row")).join(mix, F.col("row.doc_id").eqNullSafe(F.col("id")))
    return kept.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: Trained profiles, seeded choice and genetic packing cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
