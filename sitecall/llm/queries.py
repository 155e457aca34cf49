"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecall.llm import (
    importance, jaccard, language, licenses, manifest, merkle, mixing, packing, quality_rules, suffix, target_sample, toxicity, urls,
)
from sitecall.llm.common import bucket5
from sitecall.llm.registry import register, table


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank-order n-gram profiles learnt from four fifths of the documents, applied to all."""
    docs = table(spark, sf_dir, "documents")
    out = language.with_language(docs, bucket5(F.col("doc_id")) != 0)
    return out.select("doc_id", (bucket5(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


@register("op9_source_mixing")
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 5, 2, 1 by length counts and bounded-knapsack fitting."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of 2048 by a grouping genetic algorithm."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules as votes, combined by the posterior of an expectation-maximisation fit."""
    docs = table(spark, sf_dir, "documents")
    out = quality_rules.judge_quality(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior")


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression-distance scores from dictionaries trained on four fifths of the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = bucket5(F.col("doc_id")) == 0
    model = toxicity.train(*toxicity.labelled_sample(docs.filter(~held_out), table(spark, sf_dir, "labels")))
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op8_document_fingerprints", merkle.oracle_sql())
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of all documents, of an edit of each, and their likeness."""
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte covered by a 100-byte string that starts earlier is removed from all documents."""
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


@register("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of shingle sets with a Jaccard similarity of 0.8 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register("op1_url_filters", urls.oracle_sql())
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by trust and distrust propagated over host edges."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@register("op4_importance_resampling")
def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents drawn by their likeness to those labelled as good quality; ``kept`` marks the sample."""
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return importance.resample(table(spark, sf_dir, "documents"), good)


@register("op11_license_scans", licenses.oracle_sql())
def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents, by votes of word k-grams for template diagonals."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@register("op12_target_resampling", target_sample.oracle_sql())
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents drawn by their likeness to the benchmark; ranks of the drawn ones."""
    return target_sample.resample_to_target(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_dataset_manifest", manifest.oracle_sql())
def op13_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle root of all documents, each row's proof, and the root that a tampered row leads to."""
    return manifest.manifest(table(spark, sf_dir, "documents"), tampered=manifest.tampered_rows())
