"""Union + one aggregate equals the literal full/left join chain on random tables."""

import random

import duckdb
import pytest

from sitecall.operators import merge
from sitecall.plans import sqltext as q


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_join_chain(spark, seed):
    rnd = random.Random(seed)
    samples = ["a", "b", "c", "d"]
    requires = [rnd.choice([0, 1]) for _ in samples]
    rows = []
    for s in samples:
        for pos in rnd.sample(range(60), 25):
            strand = rnd.choice("+-")
            d = rnd.randint(1, 8)
            motif = None if rnd.random() < 0.1 else f"M{s}{pos % 3}"
            rows.append((s, "c" + str(pos % 2), pos, strand, motif, rnd.randint(0, d), d))
    # unique keys per sample
    seen, uniq = set(), []
    for r in rows:
        k = (r[0], r[1], r[2], r[3])
        if k not in seen:
            seen.add(k)
            uniq.append(r)
    df = spark.createDataFrame(uniq, "sample string, chrom string, pos long, strand string, motif string, uncon long, depth long")
    ordered = merge.merge_order(samples, requires)
    got = merge.merged_wide(merge.merge_site_counts(df, samples, requires, 3), [s for s, _ in ordered]).toPandas()
    con = duckdb.connect()
    con.register("src", df.toPandas())
    ctes, out = q.merge_chain("src", ordered, 3)
    sql = "with " + ", ".join(f"{a} as ({b})" for a, b in ctes) + f" select * from {out}"
    exp = con.execute(sql).fetchdf()
    cols = sorted(exp.columns)
    a = sorted(map(tuple, got[cols].astype(str).values.tolist()))
    b = sorted(map(tuple, exp[cols].astype(str).values.tolist()))
    assert a == b
