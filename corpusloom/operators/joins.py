"""Joins of a table with itself that no hot key can stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key up to which they meet in one task.
HOT = 5_000


def met_pairs(df: DataFrame, key: str, item: str, *carried: str, hot: int = HOT) -> DataFrame:
    """``(a, b, a_<c>, b_<c>...)`` with ``a < b``: items that share a key, as often as they share one.

    A key of one row meets nobody and goes first.  One of more than ``hot`` rows
    is cut into salts on one side and repeated on the other, so that its pairs
    spread over the tasks; ``df`` is read twice and should be written or cheap.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    salted = df.select(key, item, *carried).join(sizes.select(key, F.ceil(F.col("_n") / F.lit(hot)).cast("int").alias("_salts")), key)
    one = salted.select(key, F.col(item).alias("a"), *(F.col(c).alias(f"a_{c}") for c in carried), F.pmod(F.xxhash64(item), "_salts").cast("int").alias("_salt"))
    other = salted.select(key, F.col(item).alias("b"), *(F.col(c).alias(f"b_{c}") for c in carried), F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    return one.join(other, [key, "_salt"]).where(F.col("a") < F.col("b")).drop(key, "_salt")
