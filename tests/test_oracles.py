"""Every registered query against its DuckDB oracle on the smallest scale factor
(the driver runs the same comparison at sf0.01)."""

import pytest

from sitecall.plans.registry import load_all
from sitecall.testing import compare

REG = load_all()
WITH_ORACLE = sorted(n for n, q in REG.items() if q.oracle)
WITHOUT_ORACLE = sorted(n for n, q in REG.items() if not q.oracle)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_query_matches_oracle(spark, sf, name):
    ok, msg = compare(REG[name].run(spark, sf), REG[name].oracle, sf)
    assert ok, msg


@pytest.mark.parametrize("name", WITHOUT_ORACLE)
def test_query_without_oracle_runs(spark, sf, name):
    df = REG[name].run(spark, sf)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert {"sample", "chrom", "pos", "strand", "p"} <= set(df.columns)
    assert set(e.oracle_sql()) <= set(e.queries())
