"""Top N items of every group (problem 1).

Score bands from the top: the rows are cut by score into a few bands, which are
written once; a band is processed only for groups that the bands above have not
filled.  Within a band
a group's boundary is settled by exact ranking (score descending, item
ascending in code point order), so equal scores give the same items on every
run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import written

#: A list of filled groups up to this many bytes is sent to the executors whole; a longer one is joined.
BROADCAST_BYTES = 32 << 20

#: Grid of score quantiles that band edges are taken from.
GRID = [k / 50 for k in range(51)]


def band_edges(rows: DataFrame, n: int, growth: float = 2.5, most: int = 4) -> list[float]:
    """Descending score edges: the first band holds about twice the rows that
    filling every group takes, each further band ``growth`` times more; the rest
    is the last band.  The edges steer the work only, never the result."""
    size, groups, grid = rows.agg(
        F.count(F.lit(1)), F.approx_count_distinct("_g", 0.1), F.percentile_approx("_s", GRID, 1000)
    ).first()
    if not size:
        return []
    share, edges = 2.0 * n * groups / size, set()
    while share < 0.9 and len(edges) < most - 1:
        edges.add(grid[int((1 - share) * (len(GRID) - 1))])
        share *= growth
    return sorted(edges, reverse=True)


def _ranked(candidates: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct items of each group, with rank and number kept.

    The rank filter prunes to ``n`` rows of a group in every map task before
    the shuffle, so a huge group reaches its task as a few rows per map task.
    """
    best = candidates.groupBy("_g", "_i").agg(F.max("_s").alias("_s"))
    order = Window.partitionBy("_g").orderBy(F.desc("_s"), F.asc("_i"))
    top = best.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n)
    return top.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_g")))


def top_per_group(df: DataFrame, group: str, item: str, score: str, n: int = 10) -> DataFrame:
    """``(group, item, score, rank)``: per group the ``n`` items of highest score.

    An item's score in a group is its highest over all rows there.  Rows with
    a null group, null item, or a score that is null or NaN don't count; of
    equal scores the smaller item (code points) comes first; repeated rows
    change nothing; groups with fewer items come out whole; an empty table
    gives no rows; other columns are ignored.

    The table is read twice, for the band edges and to write the bands; each
    band is then read once.
    """
    rows = df.select(F.col(group).alias("_g"), F.col(item).alias("_i"), F.col(score).cast("double").alias("_s")).where(
        F.col("_g").isNotNull() & F.col("_i").isNotNull() & F.col("_s").isNotNull() & ~F.isnan("_s")
    )
    edges = band_edges(rows, n)
    number = F.lit(len(edges))
    for k, edge in reversed(list(enumerate(edges))):
        number = F.when(F.col("_s") >= edge, k).otherwise(number)
    bands = written(rows.withColumn("band", number), "bands", by=["band"]) if edges else rows.withColumn("band", number)
    done: list[DataFrame] = []  # ranked rows of filled groups, per band
    filled: list[DataFrame] = []  # names of those groups, one row each
    carried: DataFrame | None = None
    for k in range(len(edges) + 1):
        band = bands.where(F.col("band") == k).drop("band")
        for groups in filled:
            band = band.join(groups, "_g", "left_anti")
        if carried is not None:
            band = band.unionByName(carried)
        top = _ranked(band, n)
        if k == len(edges):
            done.append(top)
            break
        top = written(top, f"band{k}")
        names = top.where(F.col("_r") == n).select("_g")
        size = names.agg(F.sum(F.octet_length(F.col("_g").cast("string")) + 16)).first()[0] or 0
        filled.append(F.broadcast(names) if size <= BROADCAST_BYTES else names)
        done.append(top.where(F.col("_n") >= n))
        carried = top.where(F.col("_n") < n).select("_g", "_i", "_s")
    out = reduce(DataFrame.unionByName, (x.select("_g", "_i", "_s", "_r") for x in done))
    return out.select(F.col("_g").alias(group), F.col("_i").alias(item), F.col("_s").alias(score), F.col("_r").alias("rank"))
