"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses, in DataFrame functions only.

Leaves are the clauses of a paragraph (cut after punctuation and its blanks), a paragraph is a line, and a
section ends with every paragraph whose digest begins below 4 (about one in four), so that the branches
stay where they are when text is put in or taken out elsewhere. Node digests are md5 over the children's;
the root also covers the length. A fingerprint is ``root:body``, where the body holds the first 6 hex digits
of each leaf, leaves parted by ``,``, paragraphs ended by ``;`` and sections ended by ``|``.

Equal roots mean equal texts; differing branches locate edits (``differing_sections``); the likeness of two
fingerprints is the Dice coefficient of their sets of leaves.

Defined cases: null text is the empty text, whose tree has one empty leaf; rows with one id are ordered by a
hash of their text; a null id comes first; with a single row the next document is the row itself; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecall.llm.common import doc_columns, staged

LEAF_DIGITS = 6
MAX_BLOCKS = 4096
_CUT = "\x01"


def _tree(text: Column) -> Column:
    """array<struct<node, short>>: one entry a paragraph."""

    def paragraph(p: Column) -> Column:
        marked = F.regexp_replace(p, r"([.!?;:,|][ \t]+)", "$1" + _CUT)
        leaves = F.transform(F.split(marked, _CUT), F.md5)
        return F.struct(
            F.md5(F.array_join(leaves, "")).alias("node"),
            F.array_join(F.transform(leaves, lambda h: F.substring(h, 1, LEAF_DIGITS)), ",").alias("short"),
        )

    return F.transform(F.split(text, "\n"), paragraph)


def _fingerprint_of(tree: Column, n_chars: Column) -> Column:
    end = lambda x: F.when(x["node"] < "4", "|").otherwise(";")
    nodes = F.array_join(F.transform(tree, lambda x: F.concat(x["node"], end(x))), "")
    sections = F.array_join(F.transform(F.split(nodes, "[|]"), F.md5), "")
    body = F.array_join(F.transform(tree, lambda x: F.concat(x["short"], end(x))), "")
    return F.concat(F.md5(F.concat(sections, F.lit(":"), n_chars.cast("string"))), F.lit(":"), body)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a non-null text column."""
    tree = f"_{name}_tree"
    return df.withColumn(tree, _tree(F.col(text))).withColumn(name, _fingerprint_of(F.col(tree), F.length(text))).drop(tree)


def _leaves(fingerprint: Column) -> Column:
    body = F.substring_index(fingerprint, ":", -1)
    return F.array_remove(F.array_distinct(F.split(body, "[,;|]")), "")


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of the leaves of two fingerprints: 1 for equal texts, 0 without a common clause."""
    x, y = _leaves(a), _leaves(b)
    return F.when(a == b, 1.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def differing_sections(a: Column, b: Column) -> Column:
    """Sections of ``b`` (their leaves) that ``a`` does not have: where an edit lies."""
    cut = lambda f: F.array_remove(F.split(F.substring_index(f, ":", -1), "[|]"), "")
    return F.array_except(cut(b), cut(a))


def with_next_text(docs: DataFrame) -> DataFrame:
    """doc_id, text and the text of the next document by ascending id (after the last: the first).

    Ids are cut into blocks at approximate quantiles; each block is one window partition, and gets the first
    row of the next block as a guest.
    """
    spark = docs.sparkSession
    rows = doc_columns(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    blocks = min(MAX_BLOCKS, max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 10 * blocks).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    # ids from cuts[i - 1] up to cuts[i] make block i
    bounds = F.lit(cuts).cast("array<long>") if cuts else F.array().cast("array<long>")
    at = F.when(F.col("doc_id").isNull(), 0).otherwise(F.aggregate(bounds, F.lit(0), lambda n, c: n + F.when(c <= F.col("doc_id"), 1).otherwise(0)))
    rows = rows.withColumn("block", at).withColumn("h", F.xxhash64("text"))
    firsts = rows.groupBy("block").agg(F.min(F.struct("doc_id", "h")).alias("f")).orderBy("block").select("block", "f.doc_id", "f.h").collect()
    heads = [(firsts[i - 1]["block"], r["doc_id"], r["h"]) for i, r in enumerate(firsts)]  # at most MAX_BLOCKS rows; block -1 is the last one
    kind = dict(rows.dtypes)["doc_id"]
    guests = F.broadcast(spark.createDataFrame(heads, f"to_block int, g_id {kind}, g_h long"))
    guest = rows.join(guests, rows["doc_id"].eqNullSafe(guests["g_id"]) & (rows["h"] == guests["g_h"]))
    guest = guest.groupBy("to_block").agg(F.first("text").alias("text"))
    both = rows.select("block", F.lit(0).alias("guest"), "doc_id", "h", "text").unionByName(
        guest.select(F.col("to_block").alias("block"), F.lit(1).alias("guest"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("h"), "text")
    )
    order = Window.partitionBy("block").orderBy("guest", F.asc_nulls_first("doc_id"), "h")
    return both.withColumn("next_text", F.lead("text").over(order)).filter("guest = 0").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    rows = with_next_text(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    for text, name in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next_text", "next_fingerprint")):
        rows = with_fingerprint(rows, text, name)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def oracle_sql() -> str:
    """The same rows in DuckDB SQL."""
    def fp(text: str) -> str:
        leaves = rf"list_transform(string_split(regexp_replace(p, '([.!?;:,|][ \t]+)', '\1' || chr(1), 'g'), chr(1)), lambda s: md5(s))"
        tree = f"list_transform(string_split({text}, chr(10)), lambda p: {{'node': md5(array_to_string({leaves}, '')), 'short': array_to_string(list_transform({leaves}, lambda h: h[1:{LEAF_DIGITS}]), ',')}})"
        return tree

    def whole(tree: str, text: str) -> str:
        end = "case when x.node < '4' then '|' else ';' end"
        nodes = f"array_to_string(list_transform({tree}, lambda x: x.node || {end}), '')"
        sections = f"array_to_string(list_transform(string_split({nodes}, '|'), lambda s: md5(s)), '')"
        body = f"array_to_string(list_transform({tree}, lambda x: x.short || {end}), '')"
        return f"md5({sections} || ':' || length({text})::varchar) || ':' || {body}"

    def like(a: str, b: str) -> str:
        leaves = lambda f: f"list_filter(list_distinct(string_split_regex(string_split({f}, ':')[-1], '[,;|]')), lambda v: v <> '')"
        x, y = leaves(a), leaves(b)
        return f"case when {a} = {b} then 1.0::double else 2.0::double * len(list_intersect({x}, {y})) / (len({x}) + len({y})) end"

    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
n as (select doc_id, text, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next_text, length(text) as n_chars from d),
e as (select *, substring(text, 1, n_chars - n_chars // 2) || substring(next_text, 1, n_chars // 2) as edited from n),
t as (select *, {fp('text')} as t1, {fp('edited')} as t2, {fp('next_text')} as t3 from e),
f as (select doc_id, n_chars, edited, {whole('t1', 'text')} as f1, {whole('t2', 'edited')} as f2, {whole('t3', 'next_text')} as f3 from t)
select doc_id, n_chars::bigint as n_chars, sha256(edited) as edited_sha256, f1 as fingerprint, f2 as edited_fingerprint,
  {like('f1', 'f2')} as near_edited, {like('f1', 'f3')} as near_next from f"""
