"""Items that stand together in a basket far more often than chance (problem 2).

Baskets become arrays of dense item numbers.  Items that are too rare, or so
frequent that no partner can reach the ratio asked for, are left out first.
Every pair of a basket then becomes one packed 64-bit code (group, smaller
item, larger item).  Baskets of a group lie together, so map tasks sort their
codes and write short run-length counted runs; the shuffle brings equal codes
together, Spark's external sort merges the runs (spilling as it needs), and one
pass over the sorted codes adds up the runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import tasks, written

#: A dictionary up to this many rows is sent to the executors whole.
BROADCAST_ROWS = 1_000_000
#: Items of a basket that one task expands against as many others.
BLOCK = 2_048
#: Codes a map task holds before it writes a sorted run.
RUN = 4_000_000


def numbered(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """``(value, number)`` of the distinct values, dense from 0 in value order.

    Sorted by ranges, so no task sees all values; only the number of values of
    each range comes to the driver.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).alias("value")).distinct()
    parts = written(
        values.repartitionByRange("value").sortWithinPartitions("value").withColumn("mark", F.monotonically_increasing_id()),
        f"numbered-{column}",
    )
    part = F.shiftright("mark", 33).cast("int")
    sizes = sorted((p, n) for p, n in parts.groupBy(part).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    offsets = spark.createDataFrame(starts or [(0, 0)], "part int, start bigint")
    within = F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    table = parts.withColumn("part", part).join(F.broadcast(offsets), "part")
    return table.select("value", (within + F.col("start")).alias("number")), total


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _runs(codes: np.ndarray, highs: np.ndarray | None) -> pd.DataFrame:
    if highs is None:
        lows, counts = np.unique(codes, return_counts=True)
        return pd.DataFrame({"hi": np.zeros(len(lows), dtype=np.int64), "lo": lows, "n": counts})
    order = np.lexsort((codes, highs))
    codes, highs = codes[order], highs[order]
    heads = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (highs[1:] != highs[:-1])]) if len(codes) else np.array([], int)
    counts = np.diff(np.r_[heads, len(codes)])
    return pd.DataFrame({"hi": highs[heads], "lo": codes[heads], "n": counts})


def _pair_places(size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(size, 1)


def _expand(item_bits: int, wide: bool, kept: np.ndarray | None):
    """Batches of ``(g, left, right)`` to sorted runs of pair codes.

    ``right`` empty: all pairs within ``left``; else only those across the two.
    ``kept``: sorted codes (group, item) of the items that count; None: all do.
    """
    low_bits = 2 * item_bits

    def counted(group: np.ndarray, items: np.ndarray) -> np.ndarray:
        if kept is None:
            return np.ones(len(items), dtype=bool)
        codes = (group << item_bits) | items
        at = np.minimum(np.searchsorted(kept, codes), len(kept) - 1)
        return kept[at] == codes if len(kept) else np.zeros(len(items), dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: list[np.ndarray] = []
        highs: list[np.ndarray] = []
        held = 0

        def keep(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            nonlocal held
            low = (a << item_bits) | b
            codes.append((low if wide else (group << low_bits) | low).ravel())
            if wide:
                highs.append(np.broadcast_to(group, low.shape).ravel())
            held += codes[-1].size

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = _runs(np.concatenate(codes), np.concatenate(highs) if wide else None)
            codes.clear()
            highs.clear()
            held = 0
            return pa.RecordBatch.from_pandas(out, preserve_index=False)

        for batch in batches:
            g, left, right = batch.column("g"), batch.column("left"), batch.column("right")
            across = np.flatnonzero(np.diff(right.offsets.to_numpy()))
            group = g.to_numpy().astype(np.int64)
            whole = np.setdiff1d(np.arange(len(group)), across)
            sizes = np.diff(left.offsets.to_numpy())[whole]
            rows = np.repeat(whole, sizes)
            items = (left.take(pa.array(whole)) if len(across) else left).flatten().to_numpy().astype(np.int64)
            good = counted(group[rows], items)
            rows, items = rows[good], items[good]
            order = np.lexsort((items, rows))
            rows, items = rows[order], items[order]
            heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.array([], dtype=int)
            sizes = np.diff(np.r_[heads, len(rows)])
            for size in np.unique(sizes[sizes > 1]):
                i, j = _pair_places(int(size))
                picked = heads[sizes == size]
                step = max(1, RUN // len(i))
                for s in range(0, len(picked), step):
                    part = picked[s : s + step]
                    keep(group[rows[part]][:, None], items[part[:, None] + i], items[part[:, None] + j])
                    if held >= RUN:
                        yield flush()
            for k in across:
                sides = [np.asarray(x[int(k)].values.to_numpy(), dtype=np.int64) for x in (left, right)]
                a, b = (x[counted(np.full(len(x), group[k]), x)] for x in sides)
                keep(np.full((1, 1), group[k]), np.minimum(a[:, None], b), np.maximum(a[:, None], b))
                if held >= RUN:
                    yield flush()
        if held:
            yield flush()

    return run


def _merge_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Run-length count over sorted codes; a code cut by a batch end is carried on."""
    carry: tuple[int, int, int] | None = None
    for batch in batches:
        hi, lo, n = (batch[c].to_numpy(np.int64) for c in ("hi", "lo", "n"))
        if not len(lo):
            continue
        heads = np.flatnonzero(np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        sums = np.add.reduceat(n, heads)
        hi, lo = hi[heads], lo[heads]
        if carry is not None:
            if carry[0] == hi[0] and carry[1] == lo[0]:
                sums[0] += carry[2]
            else:
                yield pd.DataFrame({"hi": [carry[0]], "lo": [carry[1]], "n": [carry[2]]})
        carry = (int(hi[-1]), int(lo[-1]), int(sums[-1]))
        yield pd.DataFrame({"hi": hi[:-1], "lo": lo[:-1], "n": sums[:-1]})
    if carry is not None:
        yield pd.DataFrame({"hi": [carry[0]], "lo": [carry[1]], "n": [carry[2]]})


def _baskets(coded: DataFrame, n_items: int, block: int) -> tuple[DataFrame, DataFrame | None]:
    """``(g, h, left)``, a basket a row, and ``(g, b, part, parts, left)`` of the baskets cut into parts.

    Copies of a row fall together in the map tasks.  A basket of more than
    ``block`` rows is cut by item number into parts before it is collected;
    with no more items than that in all, none can be so large.
    """
    light = coded
    heavy = None
    if n_items > block:
        coded = written(coded, "coded")
        large = written(
            coded.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
            .select("g", "b", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("parts")),
            "large",
        )
        many = large.count()
        light = coded.join(_maybe_broadcast(large.select("g", "b"), many), ["g", "b"], "left_anti") if many else coded
        if many:
            heavy = written(
                coded.join(_maybe_broadcast(large, many), ["g", "b"]).withColumn("part", F.pmod("i", F.col("parts")).cast("int"))
                .groupBy("g", "b", "part", "parts").agg(F.collect_set("i").alias("left")),
                "parts",
            )
    whole = light.groupBy("g", "b").agg(F.collect_set("i").alias("left")).select("g", F.xxhash64("b").alias("h"), "left")
    return written(whole, "baskets"), heavy


def _units(light: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """``(g, h, left, right)``: whole baskets, parts of large ones, and pairs of such parts.

    Pairs of parts meet under the second part's number, so one basket spreads.
    """
    # Empty, as null arrays are written to Arrow many times slower.
    nothing = F.array().cast("array<bigint>").alias("right")
    units = light.select("g", "h", "left", nothing)
    if heavy is None:
        return units
    single = heavy.select("g", F.xxhash64("b", "part").alias("h"), "left", nothing)
    ahead = heavy.where(F.col("part") < F.col("parts") - 1).select(
        "g", "b", "left", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("part")
    )
    cross = ahead.join(heavy.select("g", "b", "part", F.col("left").alias("right")), ["g", "b", "part"]).select(
        "g", F.xxhash64("b", "part", F.element_at("left", 1)).alias("h"), "left", "right"
    )
    return units.unionByName(single).unionByName(cross)


def pair_counts(
    df: DataFrame, group: str, basket: str, item: str, least: int = 1, times: int = 0, block: int = BLOCK
) -> DataFrame:
    """``(group, item_a, item_b, n, n_a, n_b, n_ab)`` for pairs with ``n_ab >= least`` (and the ratio).

    Per group: ``n`` distinct baskets, ``n_a`` and ``n_b`` baskets with the
    item, ``n_ab`` with both; ``item_a < item_b`` in code point order.  Rows
    with a null in one of the three columns don't count, repeated rows count
    once, an empty table gives no rows, other columns are ignored.

    Items in fewer than ``least`` baskets are left out before pairs are made.
    ``times``: only pairs with ``n_ab * n >= times * n_a * n_b``;
    since ``n_ab`` is at most the smaller count, an item with ``times * n_a > n``
    has none and is left out as well.

    The table is read twice: for the values and their sizes, and for the baskets.
    """
    spark = df.sparkSession
    rows = df.select(F.col(group).alias("gv"), F.col(basket).alias("b"), F.col(item).alias("iv")).where(
        F.col("gv").isNotNull() & F.col("b").isNotNull() & F.col("iv").isNotNull()
    )
    names = written(rows.select("gv", "iv").distinct(), "names")
    items, n_items = numbered(names, "iv")
    groups, n_groups = numbered(names, "gv")
    item_bits = max(1, n_items.bit_length())
    wide = 2 * item_bits + max(1, n_groups.bit_length()) > 63
    coded = (
        rows.join(_maybe_broadcast(items.select(F.col("value").alias("iv"), F.col("number").alias("i")), n_items), "iv")
        .join(_maybe_broadcast(groups.select(F.col("value").alias("gv"), F.col("number").alias("g")), n_groups), "gv")
        .select("g", "b", "i")
    )
    light, heavy = _baskets(coded, n_items, block)
    single = light.select("g", F.explode("left").alias("i"))
    totals = light.select("g")
    if heavy is not None:
        single = single.unionByName(heavy.select("g", F.explode("left").alias("i")))
        totals = totals.unionByName(heavy.select("g", "b").distinct().select("g"))
    totals = written(totals.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "totals")
    single = single.groupBy("g", "i").agg(F.count(F.lit(1)).alias("n_i")).where(F.col("n_i") >= least).join(
        _maybe_broadcast(totals, n_groups), "g"
    )
    if times:
        single = single.where(F.lit(times).cast("decimal(19,0)") * F.col("n_i") <= F.col("n"))
    single = written(single, "singles")
    n_single = single.count()

    units = _units(light, heavy)
    kept = None
    if n_single <= BROADCAST_ROWS and not wide:
        codes = np.array([r[0] for r in single.select(F.shiftleft("g", item_bits).bitwiseOR(F.col("i"))).collect()], dtype=np.int64)
        shared = spark.sparkContext.broadcast(np.sort(codes))
        # Baskets of a group together, hot groups over several tasks.
        units = units.repartitionByRange(tasks(spark), "g", "h")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _expand(item_bits, wide, shared.value)(batches)
    else:
        run = _expand(item_bits, wide, None)
        units = _pruned(units, single).repartitionByRange(tasks(spark), "g", "h")
    runs = units.select("g", "left", "right").mapInArrow(run, "hi long, lo long, n long")
    mask = (1 << item_bits) - 1
    counted = (
        runs.repartition("hi", "lo").sortWithinPartitions("hi", "lo").mapInPandas(_merge_runs, "hi long, lo long, n long")
        .where(F.col("n") >= least)
        .select(
            (F.col("hi") if wide else F.shiftright("lo", 2 * item_bits)).alias("g"),
            F.shiftright("lo", item_bits).bitwiseAND(F.lit(mask)).alias("a"),
            F.col("lo").bitwiseAND(F.lit(mask)).alias("b"),
            F.col("n").alias("n_ab"),
        )
    )
    counts = _maybe_broadcast(single, n_single)
    return _named(
        counted.join(counts.select("g", F.col("i").alias("a"), F.col("n_i").alias("n_a"), "n"), ["g", "a"])
        .join(counts.select("g", F.col("i").alias("b"), F.col("n_i").alias("n_b")), ["g", "b"]),
        group, _maybe_broadcast(items, n_items), _maybe_broadcast(groups, n_groups), times,
    )


def _pruned(units: DataFrame, single: DataFrame) -> DataFrame:
    """``units`` with only the items of ``single``, by a join: for more of them than a worker holds."""
    numbered_units = written(units.withColumn("u", F.expr("uuid()")), "units")
    sides = []
    for side in ("left", "right"):
        kept = (
            numbered_units.select("g", "h", "u", F.explode(side).alias("i")).join(single.select("g", "i"), ["g", "i"])
            .groupBy("g", "h", "u").agg(F.collect_list("i").alias(side))
        )
        sides.append(kept)
    paired = numbered_units.select("g", "h", "u", (F.size("right") > 0).alias("cross")).join(sides[0], ["g", "h", "u"])
    out = paired.join(sides[1], ["g", "h", "u"], "left")
    return out.where(~F.col("cross") | F.col("right").isNotNull()).select(
        "g", "h", "left", F.coalesce("right", F.array().cast("array<bigint>")).alias("right")
    )


def _named(counted: DataFrame, group: str, items: DataFrame, groups: DataFrame, times: int) -> DataFrame:
    """Numbers back to values, after the ratio has thinned the pairs out."""
    if times:
        n, a, b, ab = (F.col(c).cast("decimal(19,0)") for c in ("n", "n_a", "n_b", "n_ab"))
        counted = counted.where(ab * n >= F.lit(times).cast("decimal(10,0)") * a * b)
    return (
        counted.join(groups.select(F.col("value").alias("gv"), F.col("number").alias("g")), "g")
        .join(items.select(F.col("value").alias("item_a"), F.col("number").alias("a")), "a")
        .join(items.select(F.col("value").alias("item_b"), F.col("number").alias("b")), "b")
        .select(F.col("gv").alias(group), "item_a", "item_b", "n", "n_a", "n_b", "n_ab")
    )


def with_association(pairs: DataFrame) -> DataFrame:
    """Adds ``lift`` and ``odds_ratio`` (0.5 added to each cell, so no cell is empty)."""
    n, a, b, ab = (F.col(c) for c in ("n", "n_a", "n_b", "n_ab"))
    half = F.lit(0.5)
    odds = ((ab + half) * (n - a - b + ab + half)) / ((a - ab + half) * (b - ab + half))
    return pairs.withColumns({"lift": ab * n / (a.cast("double") * b), "odds_ratio": odds})


def associated_pairs(
    df: DataFrame, group: str, basket: str, item: str, least: int = 5, times: int = 3, block: int = BLOCK
) -> DataFrame:
    """Pairs with ``n_ab >= least`` and ``n_ab * n >= times * n_a * n_b`` (exact, in decimals)."""
    return with_association(pair_counts(df, group, basket, item, least, times, block))
