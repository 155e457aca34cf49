"""Exact positions of rows in a global order, without a window over all rows.

The rows are dealt to ranges of the order, sorted there and written with ``monotonically_increasing_id``, which
holds the range's number and the place in it; the places of all earlier ranges are summed over one row a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecall.llm.common import staged


def with_positions(rows: DataFrame, tree: str, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``idx`` (from 0, by ``order`` within each value of the non-null column ``tree``) and ``n`` (its rows).

    ``rows`` should be a staged table, as the ranges are found by a sample of it, and ``order`` should end in a
    unique column, so that no range holds more than its share whatever ties there are.
    """
    dealt = rows.repartitionByRange(F.col(tree), *order).sortWithinPartitions(F.col(tree), *order)
    dealt = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    # one row for each range and tree in it: at most as many as ranges and trees together
    runs = dealt.groupBy(F.col(tree).alias("_tree"), F.col("_range").alias("_run")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    of_tree = Window.partitionBy("_tree")
    before = of_tree.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_tree", "_run", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(of_tree).alias("n"))
    runs = staged(runs, name + "-runs")
    found = dealt.join(runs, (F.col(tree) == F.col("_tree")) & (F.col("_range") == F.col("_run")))
    return found.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("idx"), "n")
