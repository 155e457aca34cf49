"""License scans by diagonal voting, in DataFrame functions only.

Templates are phrases and notices. Every rolling word k-gram of a document is joined by its hash to the template
positions that hold the same words (k is 4, or the words of a shorter phrase down to 2; the join key is the hash of
the first two). A hit votes for the diagonal of its template: its place in the document minus its place in the
template. Votes are gathered by diagonal; neighbouring diagonals of a notice, as left by words put in or taken out,
are merged; a span is verified by the share of the template's words that its votes cover, and by its length. A
phrase of three words or less must stand word for word.

The template table is bounded by the templates given to the driver and is broadcast below ``BROADCAST_GRAMS``
rows. Only hits and one row a document are shuffled, never texts.

Defined cases: a null text is the empty text; rows with one doc_id are told apart by a hash of their text, and
rows that repeat wholly get equal values; a null doc_id is a value like any other; an empty table has no rows;
further columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecall.llm.common import doc_columns, staged

#: (phrase, label) whose places are counted.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Further phrases and public license notices: (text, label).
NOTICES = (
    ("all rights reserved", "proprietary"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("bsd license", "bsd"),
    ("mozilla public license", "mpl"),
    ("creative commons attribution", "cc"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Released under the MIT License.", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
     "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under "
     "the License is distributed on an AS IS BASIS", "apache"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
)

GRAM = 4
MIN_GRAM = 2
#: Phrases up to so many words must stand word for word.
EXACT_WORDS = 3
#: Share of a notice's words that a verified span covers.
MIN_COVER = 0.75
#: A notice's span may be so many times as long as the notice.
MAX_STRETCH = 1.5
#: Diagonals of a notice no farther apart than this share of its words are neighbours.
NEIGHBOUR = 0.25
BROADCAST_GRAMS = 200_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HEAD = "\x00"  # stands in no word


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def template_grams(phrases: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> list[tuple]:
    """(template, label, base, words, neighbour, k, place, w1, w2, w3, w4) of each k-gram, and the row of documents' heads."""
    rows: list[tuple] = [(-1, None, False, 0, 0, 0, 0, _HEAD, None, None, None)]
    for number, (text, label) in enumerate([*phrases, *notices]):
        w = [x for x in re.split(_SEPARATORS, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if x]
        if len(w) < MIN_GRAM:
            raise ValueError(f"a template needs {MIN_GRAM} words: {text!r}")
        k = min(GRAM, len(w))
        near = 0 if len(w) <= EXACT_WORDS else int(len(w) * NEIGHBOUR)
        for i in range(len(w) - k + 1):
            rows.append((number, label, number < len(phrases), len(w), near, k, i, *w[i : i + k], *[None] * (GRAM - k)))
    return rows


def _key(first: Column, second: Column) -> Column:
    return F.when(first == _HEAD, F.lit(0).cast("long")).otherwise(F.xxhash64(first, second))


def hits(docs: DataFrame, grams: list[tuple]) -> DataFrame:
    """One row a document (template -1) and one for each k-gram that stands in a template."""
    spark = docs.sparkSession
    table = spark.createDataFrame(grams, "template int, label string, base boolean, words int, near int, k int, place long, t1 string, t2 string, t3 string, t4 string")
    table = table.withColumn("t_key", _key(F.col("t1"), F.col("t2")))
    if len(grams) <= BROADCAST_GRAMS:
        table = F.broadcast(table)
    rows = doc_columns(docs, "doc_id", "text").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("same"), words(F.col("text")).alias("w"))
    # a head before the first word, so that a document without hits has a row too
    rows = rows.select("doc_id", "same", F.size("w").cast("long").alias("n_words"), F.concat(F.array(F.lit(_HEAD)), "w").alias("w1"))
    rows = rows.select("*", *[F.slice("w1", i, F.size("w1")).alias(f"w{i}") for i in range(2, GRAM + 1)])
    rows = rows.select("doc_id", "same", "n_words", F.posexplode(F.arrays_zip(*[f"w{i}" for i in range(1, GRAM + 1)])).alias("at", "g"))
    rows = rows.select("doc_id", "same", "n_words", (F.col("at").cast("long") - 1).alias("at"), _key(F.col("g.w1"), F.col("g.w2")).alias("d_key"), "g")
    alike = (F.col("d_key") == F.col("t_key")) & (F.col("g.w1") == F.col("t1"))
    for i in range(2, GRAM + 1):
        alike = alike & (F.col(f"t{i}").isNull() | (F.col(f"g.w{i}") == F.col(f"t{i}")))
    return rows.join(table, alike).drop("g", "d_key", "t_key", *[f"t{i}" for i in range(1, GRAM + 1)])


def _covered(places: Column) -> Column:
    """Words of a template that k-grams at these places cover."""
    each = F.transform(places, lambda p: F.sequence(p, p + F.col("k") - 1))
    return F.size(F.array_distinct(F.flatten(each)))


def spans(found: DataFrame) -> DataFrame:
    """Merged diagonals: doc_id, same, n_words, label, base, template, start, end, cover, verified."""
    doc = ["doc_id", "same", "n_words"]
    template = ["template", "label", "base", "words", "near", "k"]
    diagonals = found.withColumn("diagonal", F.col("at") - F.col("place")).groupBy(*doc, *template, "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("at").alias("start"), (F.max("at") + F.first("k")).alias("end"),
    )
    along = Window.partitionBy(*doc, "template").orderBy("diagonal")
    parted = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("near")
    diagonals = diagonals.withColumn("span", F.sum(F.coalesce(parted, F.lit(True)).cast("int")).over(along))
    diagonals = diagonals.withColumn("alone", _covered(F.col("places")))
    merged = diagonals.groupBy(*doc, *template, "span").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.min("start").alias("start"), F.max("end").alias("end"), F.max("alone").alias("alone"),
    )
    # a span that other votes have stretched too far counts by its best diagonal
    fits = (F.col("end") - F.col("start")) <= F.col("words") * MAX_STRETCH
    cover = F.when(fits, _covered(F.col("places"))).otherwise(F.col("alone")) / F.col("words")
    merged = merged.withColumn("cover", F.when(F.col("words") > 0, cover).otherwise(0.0))
    least = F.when(F.col("words") <= EXACT_WORDS, 1.0).otherwise(MIN_COVER)
    return merged.select(*doc, "template", "label", "base", "start", "end", "cover", ((F.col("words") > 0) & (F.col("cover") >= least)).alias("verified"))


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = BASE, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    score is the largest share of a template's words that a span covers.
    """
    found = spans(hits(docs, template_grams(phrases, notices)))
    place = F.col("verified") & F.col("base")
    listed = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    result = found.groupBy("doc_id", "same", "n_words").agg(
        F.count_if(place).alias("n_base"), F.min(F.when(place, F.col("start"))).alias("first_word"), F.max(F.when(place, F.col("start"))).alias("last_word"),
        listed(place).alias("base_labels"), listed(F.col("verified")).alias("labels"), F.max("cover").alias("score"),
    )
    # both sides of the join are shuffles of their own, so that one id with one text in very many rows can be split
    result = staged(result, "license-spans").withColumnRenamed("doc_id", "of")
    rows = doc_columns(docs, "doc_id", "text").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    joined = rows.join(result, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("same")))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def oracle_sql(phrases: Sequence[tuple[str, str]] = BASE, notices: Sequence[tuple[str, str]] = NOTICES) -> str:
    """The same rows in DuckDB SQL."""
    values = ", ".join(
        "(" + ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else str(x).lower() for x in r) + ")" for r in template_grams(phrases, notices)[1:]
    )
    covered = lambda p: f"len(list_distinct(flatten(list_transform({p}, lambda x: range(x, x + k)))))"
    return f"""
with g(template, label, base, words, near, k, place, t1, t2, t3, t4) as (values {values}),
d as materialized (select row_number() over () as rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{_SEPARATORS}'), lambda x: x <> '') as w from documents),
e as (select rid, unnest(w) as w1, unnest(range(len(w))) as i from d),
n as (select *, lead(w1) over p as w2, lead(w1, 2) over p as w3, lead(w1, 3) over p as w4 from e window p as (partition by rid order by i)),
h as (select rid, i, g.* from n join g on w1 = t1 and w2 = t2 and (t3 is null or w3 = t3) and (t4 is null or w4 = t4)),
v as (select rid, template, label, base, words, near, k, i - place as diagonal, list(distinct place) as places, min(i) as a, max(i) + k as z from h group by rid, template, label, base, words, near, k, i - place),
m as (select *, sum(case when diagonal - before <= near then 0 else 1 end) over (partition by rid, template order by diagonal) as span
  from (select *, lag(diagonal) over (partition by rid, template order by diagonal) as before from v)),
s as (select rid, label, base, words, k, min(a) as a, max(z) as z, flatten(list(places)) as places, max({covered('places')}) as alone from m group by rid, template, label, base, words, k, span),
c as (select *, (case when z - a <= words * {MAX_STRETCH}::double then {covered('places')} else alone end)::double / words as cover from s),
x as (select *, cover >= case when words <= {EXACT_WORDS} then 1.0 else {MIN_COVER} end as verified from c),
r as (select rid, count(*) filter (verified and base) as n_base, min(a) filter (verified and base) as first_word, max(a) filter (verified and base) as last_word,
  array_to_string(list_sort(list(distinct label) filter (verified and base)), ',') as base_labels, array_to_string(list_sort(list(distinct label) filter (verified)), ',') as labels, max(cover) as score from x group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score from d left join r using (rid)"""
