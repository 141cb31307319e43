"""Dense row numbers over a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import written


def numbered(df: DataFrame, *order: str | Column, name: str = "number") -> DataFrame:
    """``df`` with ``name``: 0, 1, ... in the given order.

    Rows sort within ranges of the order; only the sizes of the ranges come
    together.  The order should leave no ties between different rows.  ``df`` is
    written first, as finding the ranges reads it once more.
    """
    ranged = written(df, "rows").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(ranged.withColumn("_m", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_m", 33)
    starts, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in parts.groupBy(part).count().collect()):
        starts.append((p, total))
        total += n
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts or [(0, 0)], "_p long, _s long"))
    row = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_s")
    return parts.withColumn("_p", part).join(offsets, "_p").withColumn(name, row).drop("_m", "_p", "_s")
