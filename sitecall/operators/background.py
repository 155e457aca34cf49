"""GC/motif background: fit points (A6), model fit per library x motif (U3), lookup.

A6 is one hash aggregate with map-side partial aggregation: any number of
sites collapses to at most (libraries x 3-mers x 15 GC bins) rows before the
shuffle, so a hot library or motif cannot skew it.  U3 runs per
(sample, motif3) group on those <= 15 points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecall.functions.motif import gc_bin_pct, has_n, ratio_pct2
from sitecall.functions.stats import background_rate
from sitecall.operators import fit as fitlib
from sitecall.operators.joins import bounded_broadcast
from sitecall.options import FALLBACK_PARAMS, FIT_DEPTH_MAX, GC_HIGH, GC_LOW

POINT_KEYS = ("sample", "motif3", "gc_bin")
PARAM_SCHEMA = (
    "sample string, motif3 string, a double, b double, c double, d double, e double, "
    "status string, n_points bigint"
)


def background_points(sites: DataFrame, depth_max: int = FIT_DEPTH_MAX) -> DataFrame:
    """(sample, motif3, gc_pct, uncon, depth) -> fit points per (sample, motif3, gc_bin).

    ratio = round(uncon/depth, 2); per bin: count-weighted mean ratio and mean
    GC over sites with 1 <= depth < depth_max and no N in the 3-mer.  Sums are
    integers (hundredths / percent), so the means are exact.
    """
    d = F.col("depth")
    pts = sites.where(~has_n("motif3") & (d >= 1) & (d < depth_max)).select(
        "sample", "motif3",
        gc_bin_pct("gc_pct", GC_LOW, GC_HIGH).alias("gc_bin"),
        F.col("gc_pct"),
        ratio_pct2("uncon", "depth").alias("r2"),
    )
    return pts.groupBy(*POINT_KEYS).agg(
        (F.sum("r2") / (F.count(F.lit(1)) * F.lit(100.0))).alias("ratio"),
        (F.sum("gc_pct") / (F.count(F.lit(1)) * F.lit(100.0))).alias("gc"),
        F.count(F.lit(1)).alias("count"),
    )


# A group is fitted with at least 5 points at 3 GC values whose ratios spread by 1e-10 and by 5 % of their mean.
MIN_POINTS, MIN_GC_VALUES, MIN_SPREAD, MIN_RELATIVE_SPREAD = 5, 3, 1e-10, 0.05


def gated_points(points: DataFrame) -> DataFrame:
    """Fit points with their group's ``n_points`` and ``gate``: ``fit``, or why it takes the fallback parameters."""
    w = Window.partitionBy("sample", "motif3")
    n, mean = F.count(F.lit(1)).over(w), F.avg("ratio").over(w)
    spread = F.max("ratio").over(w) - F.min("ratio").over(w)
    gate = (
        F.when(n < MIN_POINTS, "few_points")
        .when(spread < MIN_SPREAD, "constant")
        .when((mean > 0) & (F.try_divide(spread, mean) < MIN_RELATIVE_SPREAD), "narrow")
        .when(F.size(F.collect_set("gc").over(w)) < MIN_GC_VALUES, "few_gc")
        .otherwise("fit")
    )
    return points.withColumn("n_points", n).withColumn("gate", gate)


def fit_gates(points: DataFrame) -> DataFrame:
    """(sample, motif3, n_points, gate): which groups are fitted, and why the others are not."""
    return gated_points(points).select("sample", "motif3", "n_points", "gate").distinct()


def _fit_group(pdf: pd.DataFrame, fallback: Sequence[float] = FALLBACK_PARAMS) -> pd.DataFrame:
    pdf = pdf.sort_values("gc", kind="mergesort")
    status, params = pdf["gate"].iloc[0], tuple(fallback)
    if status == "fit":
        try:
            params = tuple(fitlib.fit_points(pdf["gc"].to_numpy(float), pdf["ratio"].to_numpy(float)).tolist())
        except (fitlib.FitError, np.linalg.LinAlgError):
            status = "not_converged"
    a, b, c, d, e = params
    return pd.DataFrame(
        {
            "sample": [pdf["sample"].iloc[0]],
            "motif3": [pdf["motif3"].iloc[0]],
            "a": [a], "b": [b], "c": [c], "d": [d], "e": [e],
            "status": [status],
            "n_points": [len(pdf)],
        }
    )


def fit_background(points: DataFrame, fallback: Sequence[float] = FALLBACK_PARAMS) -> DataFrame:
    """One parameter row per (sample, motif3) that has points; ``status`` is ``fit``, the gate or ``not_converged``,
    whose rows have the ``fallback`` parameters."""
    return gated_points(points).groupBy("sample", "motif3").applyInPandas(lambda pdf: _fit_group(pdf, fallback), PARAM_SCHEMA)


def fallback_background(points: DataFrame, fallback: Sequence[float] = FALLBACK_PARAMS) -> DataFrame:
    """Fallback parameters for every (sample, motif3) with points (no fitting)."""
    a, b, c, d, e = fallback
    return points.select("sample", "motif3").distinct().select(
        "sample", "motif3", F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c"),
        F.lit(d).alias("d"), F.lit(e).alias("e"), F.lit("fallback").alias("status"),
        F.lit(0).cast("bigint").alias("n_points"),
    )


def attach_background(sites: DataFrame, params: DataFrame, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """J5 + F6: background = a * exp(b * gc) for the site's (sample, motif3); null if unfitted.

    ``params`` has one row per (sample, 3-mer): bounded by libraries x 3-mers,
    checked before it is broadcast.
    """
    p, _ = bounded_broadcast(params.select("sample", "motif3", "a", "b"), broadcast_max_rows)
    return sites.join(p, on=["sample", "motif3"], how="left").withColumn(
        "background", background_rate("a", "b", F.col("gc_pct") * F.lit(0.01))
    ).drop("a", "b")
