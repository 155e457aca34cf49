"""Target-distribution importance resampling with a cutoff found by threshold bisection.

Features are hashed to buckets; a bucket's gain compares its smoothed share in the target with its share in the
documents. The gains make one array, by which each document's features are scored in the row. The scores (mean
gain plus seeded Gumbel noise) are written once; the cutoff of the draw is then bisected on the numbers alone: a
job counts the rows at 15 thresholds between the bounds and keeps one sixteenth, first for the score, then among
the rows tied at it for doc_id, then for the written row number. Only the drawn rows are sorted, dealt to ranges.

Defined cases: a null or empty text has no features, weight 0 and is never drawn; ties of score go to the smaller
doc_id, null ids last, then to the earlier written row; repeated rows are drawn one by one; an empty target leaves
the gains to the documents' counts alone; an empty table has no rows; doc_id must be a whole number; further
columns are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecall.llm.common import doc_columns, staged
from sitecall.llm.positions import with_positions

BUCKETS = 10_000
SCALE = 1000
SEED = 2024
MIN_WORDS = 20
SHARE = 10  # percent of the documents with MIN_WORDS or more
MAX_RUN = 1  # features are runs of 1 to so many words
_PROBES = 15
_LAST = (1 << 63) - 1
#: Separators between words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """array<string>: lower-cased (A-Z only) words of a text; none of a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def features(found: Column, max_run: int = MAX_RUN) -> Column:
    """Runs of 1 to ``max_run`` consecutive words, joined by one space."""

    def of(k: int) -> Column:
        starts = F.when(F.size(found) >= k, F.sequence(F.lit(1), F.size(found) - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(found, i, k), " "))

    return F.concat(found, *[of(k) for k in range(2, max_run + 1)]) if max_run > 1 else found


def bucket(feature: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> list[int]:
    """Features of all texts by bucket: one row a bucket, whatever the table's size."""
    each = texts.select(words(F.col("text")).alias("w")).select(F.explode(features(F.col("w"), max_run)).alias("f"))
    counts = [0] * buckets
    for r in each.groupBy(bucket(F.col("f"), buckets).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["b"]] = r["n"]
    return counts


def gains(source: list[int], target: list[int]) -> list[int]:
    """Floored scaled log ratio of the smoothed shares, by bucket."""
    size, s_all, t_all = len(source), sum(source), sum(target)
    ratio = lambda s, t: float((t + 1) * (s_all + size)) / float((s + 1) * (t_all + size))
    return [math.floor(SCALE * math.log(ratio(s, t))) for s, t in zip(source, target)]


def scored(docs: DataFrame, gain: list[int], seed: int = SEED, max_run: int = MAX_RUN) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")  # folded to one constant array
    rows = doc_columns(docs, "doc_id", "text").select("doc_id", words(F.col("text")).alias("w"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), features(F.col("w"), max_run).alias("f"))
    total = F.aggregate("f", F.lit(0).cast("long"), lambda acc, x: acc + F.element_at(table, bucket(x, len(gain)) + 1))
    rows = rows.select("doc_id", "n_words", F.size("f").cast("long").alias("n_features"), total.alias("total"))
    # whole-number division that goes down
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0).cast("long"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-float(SCALE) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + noise)


def _cut(rows: DataFrame, key: str, want: int) -> tuple[int, int]:
    """(smallest c with ``want`` rows or more at key <= c, rows with key < c); 0 < want <= rows."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0  # rows under the lower bound
    while low < high:
        step = max(1, (high - low + _PROBES) // (_PROBES + 1))
        probes = list(range(low, high, step))[:_PROBES]
        counts = rows.agg(*[F.count_if(F.col(key) <= p).alias(f"c{i}") for i, p in enumerate(probes)]).first()
        for p, n in zip(probes, counts):
            if n >= want:
                high = p
                break
            low, below = p + 1, n
    return low, below


def drawn(rows: DataFrame, want: int) -> Column:
    """Condition on ``rows`` (columns up, id, at: smaller goes first) that holds for exactly ``want`` of them."""
    taken, tied, left = F.lit(False), F.lit(True), want
    for key in ("up", "id", "at"):
        cut, below = _cut(rows.filter(tied), key, left)
        taken, tied, left = taken | (tied & (F.col(key) < cut)), tied & (F.col(key) == cut), left - below
        if rows.filter(tied).count() == left:
            return taken | tied
    return taken | tied


def resample_to_target(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED, max_run: int = MAX_RUN) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row; rank (from 1) is null for rows that are not drawn.

    ``target`` has a column text. Of the rows with ``min_words`` words, ``share`` percent are drawn.
    """
    gain = gains(bucket_counts(docs, buckets, max_run), bucket_counts(target, buckets, max_run))
    rows = scored(docs, gain, seed, max_run).withColumn("at", F.monotonically_increasing_id())
    rows = staged(rows, "target-scores")
    out = ["doc_id", "n_features", "weight", "score"]
    rows = rows.select(*out, "n_words", "at", (-F.col("score")).alias("up"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"))
    long_enough = F.col("n_words") >= min_words
    want = share * rows.filter(long_enough).count() // 100
    if want == 0:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    took = long_enough & drawn(rows.filter(long_enough), want)
    chosen = rows.filter(took).select(*out, "up", "id", "at", F.lit("").alias("one"))
    ranked = with_positions(chosen, "one", [F.col("up"), F.col("id"), F.col("at")], "target-ranks")
    rest = rows.filter(~took).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, (F.col("idx") + 1).alias("rank")).unionByName(rest)


def oracle_sql() -> str:
    """The same rows in DuckDB SQL; crc32 from its bits, once for each distinct word."""
    found = lambda t: f"select {t}, list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w"
    byte = "list_transform(range(strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::bigint)"
    shift = "list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::bigint)), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {byte}), lambda a, b: {shift}), 4294967295)"
    return f"""
with d as materialized (select row_number() over () as rid, * from ({found('doc_id')} from documents)),
b as ({found('item_id')} from benchmark),
f as materialized (select rid, unnest(w) as f from d),
g as (select unnest(w) as f from b),
v as materialized (select f, {crc} % {BUCKETS} as b from (select f from f union select f from g)),
s as (select b, count(*) as s from f join v using (f) group by b),
t as (select b, count(*) as t from g join v using (f) group by b),
sizes as (select (select count(*) from f)::double as ss, (select count(*) from g)::double as tt),
gain as materialized (select k.b, floor({SCALE} * ln((coalesce(t, 0) + 1)::double * (ss + {BUCKETS}) / ((coalesce(s, 0) + 1)::double * (tt + {BUCKETS})))) as gain
  from (select distinct b from v) k left join s using (b) left join t using (b) cross join sizes),
w as (select rid, floor(sum(gain) / count(*)) as weight from f join v using (f) join gain using (b) group by rid),
h as (select rid, doc_id, len(w)::bigint as n_features, ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double as h from d),
sc as (select rid, doc_id, n_features, coalesce(weight, 0)::bigint as weight,
  (coalesce(weight, 0) + floor(-{SCALE}::double * ln(-ln((h + 0.5::double) / 4294967296::double))))::bigint as score from h left join w using (rid)),
r as (select rid, row_number() over (order by score desc, doc_id nulls last) as rank, count(*) over () as n from sc where n_features >= {MIN_WORDS})
select doc_id, n_features, weight, score, case when rank <= {SHARE} * n // 100 then rank end as rank from sc left join r using (rid)"""
