"""Rankings, pivots and spreads for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, by: list[str], n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows per group with ``rank``; ``order`` must be total.

    The rank filter prunes to ``n`` rows per group in every map task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def movers(changes: DataFrame, by: list[str], n: int, rate_floor: float = 0.10) -> DataFrame:
    """The ``n`` strongest risers and fallers per group."""
    kept = changes.where((F.greatest("rate_base", "rate_target") >= rate_floor) & (F.col("direction") != "flat"))
    return top_rows(kept, [*by, "direction"], n, F.desc(F.abs("diff")), "key")


def arrows(changes: DataFrame, points: float = 0.03, floor: float = 0.04) -> DataFrame:
    """Keys of a share worth showing, with an arrow where they moved."""
    shown = changes.where(F.greatest("rate_base", "rate_target") >= floor)
    return shown.withColumn("arrow", F.when(F.col("diff") >= points, "up").when(F.col("diff") <= -points, "down").otherwise("level"))


def spread(rates: DataFrame, key: str, across: str, value: str, groups: int, least: int, n: int) -> DataFrame:
    """Keys by the difference of their highest and lowest share over ``groups`` groups.

    A group without the key counts as 0; keys in fewer than ``least`` groups
    are left out.
    """
    sums = rates.groupBy(key).agg(F.max(value).alias("high"), F.min(value).alias("low"), F.countDistinct(across).alias("present"))
    low = F.when(F.col("present") < groups, F.lit(0.0)).otherwise(F.col("low"))
    out = sums.where(F.col("present") >= least).withColumn("low", low).withColumn("spread", F.round(F.col("high") - F.col("low"), 6))
    return out.orderBy(F.desc("spread"), key).limit(n)


def matrix(rates: DataFrame, key: str, across: str, value: str, columns: list[str]) -> DataFrame:
    """Keys against fixed columns, in per cent to one digit."""
    out = rates.groupBy(key).pivot(across, columns).agg(F.first(F.round(F.lit(100.0) * F.col(value), 1)))
    return out.fillna(0.0)


def top_labels(facts: DataFrame, by: str, label: str, value: str, n: int) -> DataFrame:
    """Per group the ``n`` labels of highest value over all cells, joined."""
    best = facts.groupBy(by, label).agg(F.max(value).alias(value))
    top = top_rows(best, [by], n, F.desc(value), F.desc(label))
    listed = F.array_sort(F.collect_list(F.struct("rank", label)))
    return top.groupBy(by).agg(F.array_join(F.transform(listed, lambda s: s[label]), ", ").alias("top_labels"))


def size_histogram(groups: DataFrame, by: str) -> DataFrame:
    """How many groups have how many members."""
    return groups.groupBy(by).agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("groups"))
