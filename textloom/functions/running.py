"""Running sums over any number of rows of a key, without a task that holds all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.lineage import cut
from textloom.registry import fresh


def before(df: DataFrame, keys: list[str], order: list, size: Column, name: str) -> DataFrame:
    """Adds the sum of ``size`` over the rows of the key before each row, in the given order, as ``name``.

    Rows are cut into ranges of (keys, order); sums within a range and sums of whole ranges (one row a range and key) are added up.
    """
    part, size_col, whole = fresh(df, "range_no"), fresh(df, "range_size"), fresh(df, "range_sum")
    placed = df.withColumn(size_col, size).repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id())
    placed = cut(placed)  # the ranges are sampled: written once, so that both uses see the same
    first = Window.unboundedPreceding
    local = F.sum(size_col).over(Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(first, -1))
    sums = placed.groupBy(*keys, part).agg(F.sum(size_col).alias(whole))
    prior = F.sum(whole).over(Window.partitionBy(*keys).orderBy(part).rowsBetween(first, -1))
    names = {k: fresh(df, f"{k}_of_range") for k in [*keys, part]}
    ranges = sums.select(*[F.col(f"`{k}`").alias(v) for k, v in names.items()], F.coalesce(prior, F.lit(0)).alias(whole))
    same = placed[part].eqNullSafe(ranges[names[part]])
    for k in keys:
        same &= placed[k].eqNullSafe(ranges[names[k]])
    both = placed.withColumn(name, F.coalesce(local, F.lit(0))).join(ranges, same)
    return both.withColumn(name, F.col(name) + F.col(whole)).drop(part, size_col, whole, *names.values())
