"""Physical-plan checks: the scale properties the operators promise."""

import re

import pytest

from sitecall import fixtures as fx
from sitecall.operators import calling, merge, pileup, reads as rd
from sitecall.plans import site_queries as sq
from sitecall.plans.registry import load_all


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan))


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(load_all()))
def test_no_cross_or_nested_loop_joins(spark, sf, name):
    plan = _plan(load_all()[name].run(spark, sf))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_merge_is_one_shuffle_and_pivot_reuses_it(spark, sf, static_plans):
    long = merge.merge_site_counts(fx.load(spark, sf, "site_counts"), sq.PIPE_SAMPLES, sq.PIPE_REQUIRES, 3)
    assert _shuffles(_plan(long)) == 1
    wide = merge.merged_wide(long, ["s1", "s2", "s3", "s0"])
    plan = _plan(wide)
    assert _shuffles(plan) == 1
    assert "SortAggregate" not in plan  # fixed-width buffers: code-generated hash aggregate


def test_hot_key_aggregates_are_partial(spark, sf, static_plans):
    kept, sets = rd.dedup_alignments(fx.load(spark, sf, "alignments"))
    assert "partial_min" in _plan(kept)
    assert "partial_count" in _plan(sets)
    probes = fx.load(spark, sf, "probe_reads")
    for counts in (pileup.spike_counts(probes), pileup.pileup_counts(probes)):
        plan = _plan(counts)
        assert _shuffles(plan) == 1
        assert plan.index("Exchange") < plan.index("partial_sum") < plan.index("MapInPandas")  # summed below the shuffle


def test_filters_reach_the_scan(spark, sf, static_plans):
    plan = _plan(load_all()["binom_pvalue"].run(spark, sf))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "strand" in scan and "DataFilters" in scan


def test_statistics_stay_on_the_jvm(spark, sf, static_plans):
    for name in ("chi2_pvalue", "any_sample_significant"):
        plan = _plan(load_all()[name].run(spark, sf))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name


def test_calling_shuffles_sites_once(spark, sf):
    """The checkpointed sites keep their partitioning by site also under adaptive execution: none above the checkpoint."""
    called, _, _ = calling.call_sites(fx.load(spark, sf, "site_counts"), sq.KEYS, pool=True)
    called.write.format("noop").mode("overwrite").save()
    plan = _plan(called)
    assert "Window" in plan and _shuffles(plan) == 0


def test_binomial_tail_runs_after_its_gates(spark, sf, static_plans):
    plan = _plan(load_all()["binom_pvalue"].run(spark, sf))
    assert "ArrowEvalPython" in plan and "java_method" not in plan
    assert plan.index("ArrowEvalPython") < plan.rindex("depth") and "Filter" in plan[plan.index("ArrowEvalPython"):]
