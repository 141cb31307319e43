"""Fact table and its statistics per cell ``(year, occupation)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.functions.text import join_key

CELL = ["year", "occupation"]
BOILERPLATE = "cat_generic_field_reference"
REQUIREMENT_RANK = {"required": 3, "preferred": 2, "unclear": 1}


def in_scope(df: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of the cells that ``scope(year, occupation)`` lists."""
    return df.join(scope.select(*CELL).distinct(), CELL, "left_semi")


def ad_counts(posting: DataFrame, ok_only: bool = False) -> DataFrame:
    """``n_ads`` of every cell (A1); ``ok_only`` keeps ads whose status is ok or missing."""
    rows = posting.where(F.coalesce("status", F.lit("ok")) == "ok") if ok_only else posting
    return rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_ads"))


def bridge_with_aliases(bridge: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(key, concept_id)``: the bridge, and aliases for keys it lacks."""
    return bridge.select("key", "concept_id").unionByName(
        aliases.join(bridge, "key", "left_anti").select("key", "concept_id")
    )


def matched_mentions(mentions: DataFrame, bridge: DataFrame, form: str = "form") -> DataFrame:
    """Mentions with ``key`` and ``concept_id``; unmatched ones keep a null."""
    return mentions.withColumn("key", join_key(F.col(form))).join(bridge.select("key", "concept_id"), "key", "left")


def requirement_rank(c: Column) -> Column:
    rank = F.lit(0)
    for name, value in REQUIREMENT_RANK.items():
        rank = F.when(c == name, value).otherwise(rank)
    return rank


def posting_concepts(mentions: DataFrame, requirement: str | None = None) -> DataFrame:
    """One row per cell, posting and concept with ``n_mentions`` (A2).

    With ``requirement`` the strongest of the mentions; of equal rank the
    alphabetically first stands, so row order doesn't matter.
    """
    aggregates = [F.count(F.lit(1)).alias("n_mentions")]
    if requirement:
        best = F.max_by(requirement, F.struct(requirement_rank(F.col(requirement)), F.col(requirement)))
        aggregates.append(F.coalesce(best, F.lit("")).alias("requirement"))
    return mentions.groupBy(*CELL, "posting_id", "concept_id").agg(*aggregates)


def with_dims(facts: DataFrame, dims: DataFrame) -> DataFrame:
    """Label, type, category and held of each concept, empty where unknown."""
    wide = facts.join(dims, "concept_id", "left")
    return wide.withColumns({
        c: F.coalesce(c, F.lit("")) for c in ("concept_label", "concept_type", "primary_category")
    } | {"held": F.coalesce("held", F.lit(False))})


def coverage(matched: DataFrame, by: list[str]) -> DataFrame:
    """Mentions, matched mentions and their percentage (A3)."""
    n, hit = F.count(F.lit(1)), F.count("concept_id")
    return matched.groupBy(*by).agg(
        n.alias("mentions"), hit.alias("matched"), F.round(F.lit(100.0) * hit / n, 2).alias("coverage_pct")
    )


def top_unmatched(matched: DataFrame, by: list[str], most: int = 15) -> DataFrame:
    """The most frequent keys without a concept; of equal counts the first key (A3)."""
    counts = matched.where(F.col("concept_id").isNull()).groupBy(*by, "key").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*by).orderBy(F.desc("n"), "key")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def grain_keys(facts: DataFrame, facets: DataFrame | None = None, grains: tuple[str, ...] = ("concept", "category", "type", "facet")) -> DataFrame:
    """Facts once per posting and grain key.

    The concept grain is the facts themselves, already distinct, and goes to
    its count without a shuffle.  The other grains fan in: each fact gives its
    keys at all of them at once, and these are made distinct together.
    ``facets`` is a dimension; its values per concept are joined as one list.
    """
    base = [*CELL, "posting_id"]
    empty = F.lit("")
    columns = {"category": "primary_category", "type": "concept_type"}
    fan_in = [F.struct(F.lit(g).alias("grain"), empty.alias("facet_id"), F.col(c).alias("key"), F.col(c).alias("label")) for g, c in columns.items() if g in grains]
    keys = F.array(*fan_in)
    wide = facts
    if "facet" in grains and facets is not None:
        value = F.struct(F.lit("facet").alias("grain"), "facet_id", F.col("value").alias("key"), F.col("value").alias("label"))
        lists = facets.where(F.col("value") != "none").groupBy("concept_id").agg(F.collect_set(value).alias("_values"))
        wide = facts.join(lists, "concept_id", "left")
        values = F.coalesce("_values", F.array().cast("array<struct<grain:string,facet_id:string,key:string,label:string>>"))
        keys = F.concat(keys, values) if fan_in else values
        fan_in.append(value)
    parts = []
    if "concept" in grains:
        parts.append(facts.select(*base, F.lit("concept").alias("grain"), empty.alias("facet_id"), F.col("concept_id").alias("key"), F.col("concept_label").alias("label")))
    if fan_in:
        parts.append(wide.select(*base, F.explode(keys).alias("k")).select(*base, "k.*").where(F.col("key") != "").distinct())
    return reduce(DataFrame.unionByName, parts)


def penetration(facts: DataFrame, ads: DataFrame, facets: DataFrame | None = None, grains: tuple[str, ...] = ("concept", "category", "type", "facet")) -> DataFrame:
    """Share of a cell's ads that name each key, with Wilson bounds."""
    keys = grain_keys(facts, facets, grains)
    held = facts.groupBy("concept_id").agg(F.max("held").alias("is_held")).where("is_held")
    hits = keys.groupBy(*CELL, "grain", "facet_id", "key", "label").agg(F.count(F.lit(1)).alias("hits"))
    joined = hits.join(ads, CELL).join(
        held.select(F.lit("concept").alias("grain"), F.col("concept_id").alias("key"), "is_held"), ["grain", "key"], "left"
    )
    low, high = stats.wilson(F.col("hits"), F.col("n_ads"))
    return joined.select(
        *CELL, "grain", "facet_id", "key", "label", "n_ads", "hits",
        F.round(stats.share(F.col("hits"), F.col("n_ads")), 6).alias("rate"),
        F.round(low, 6).alias("wilson_low"), F.round(high, 6).alias("wilson_high"),
        F.coalesce("is_held", F.lit(False)).cast("int").alias("is_held"),
        ((F.col("grain") == "category") & (F.col("key") == BOILERPLATE)).cast("int").alias("is_boilerplate"),
    )


def change_tests(rates: DataFrame, ads: DataFrame, base: str, target: str, alpha_z: float = stats.Z95) -> DataFrame:
    """Two-proportion test of every key between two years.

    Conditional sums instead of a full outer join; a key or cell absent in one
    year has 0 hits there.  Significance is read off |z|, so it doesn't depend
    on the approximation of p.
    """
    key = ["occupation", "grain", "facet_id", "key", "label"]
    two = rates.where(F.col("year").isin(base, target))
    hits = two.groupBy(*key).agg(
        *(F.coalesce(F.max(F.when(F.col("year") == y, F.col("hits"))), F.lit(0)).alias(f"h{i}") for i, y in enumerate((base, target)))
    )
    sizes = ads.where(F.col("year").isin(base, target)).groupBy("occupation").agg(
        *(F.coalesce(F.max(F.when(F.col("year") == y, F.col("n_ads"))), F.lit(0)).alias(f"n{i}") for i, y in enumerate((base, target)))
    )
    h1, n1, h2, n2 = (F.col(c) for c in ("h0", "n0", "h1", "n1"))
    diff, z, p = stats.two_proportions(h1, n1, h2, n2)
    return (
        hits.join(sizes, "occupation")
        .select(*key, n1.alias("n_base"), h1.alias("hits_base"), n2.alias("n_target"), h2.alias("hits_target"),
                F.round(stats.share(h1, n1), 6).alias("rate_base"), F.round(stats.share(h2, n2), 6).alias("rate_target"),
                F.round(diff, 6).alias("diff"), F.round(z, 4).alias("z"), F.round(p, 4).alias("p_value"),
                F.coalesce(F.abs(z) > alpha_z, F.lit(False)).cast("int").alias("significant"),
                F.when(diff > 0, "up").when(diff < 0, "down").otherwise("flat").alias("direction"))
    )


def view_rates(rows: DataFrame, ads: DataFrame, key: str) -> DataFrame:
    """Store view: share of the ads of ``ads`` that name ``key``.

    ``ads`` decides the denominator: the occurrences themselves (ads without a
    skill vanish) or another table (the grouped view uses the normed ads).
    """
    total = ads.groupBy(*CELL).agg(F.countDistinct("posting_id").alias("n_total"))
    hits = rows.groupBy(*CELL, key).agg(F.countDistinct("posting_id").alias("n_ads"))
    return hits.join(total, CELL).select(
        *CELL, key, "n_ads", "n_total", F.round(F.lit(1.0) * F.col("n_ads") / F.col("n_total"), 4).alias("rate")
    )


def record_stats(facts: DataFrame, posting: DataFrame) -> DataFrame:
    """Skills per ad: mean, upper median, most, and ads without any.

    The median is read off the histogram of sizes, a few rows per cell.
    """
    sizes = (
        posting.select(*CELL, "posting_id").join(facts.groupBy(*CELL, "posting_id").agg(F.count(F.lit(1)).alias("k")), [*CELL, "posting_id"], "left")
        .withColumn("k", F.coalesce("k", F.lit(0)))
    )
    steps = sizes.groupBy(*CELL, "k").agg(F.count(F.lit(1)).alias("c"))
    by_size = Window.partitionBy(*CELL).orderBy("k")
    all_rows = Window.partitionBy(*CELL)
    run = steps.withColumn("upto", F.sum("c").over(by_size)).withColumn("n", F.sum("c").over(all_rows))
    middle = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("k")))
    return run.groupBy(*CELL).agg(
        F.sum("c").alias("n_ads"), F.round(F.sum(F.col("k") * F.col("c")) / F.sum("c"), 4).alias("mean_skills"),
        middle.alias("median_skills"), F.max("k").alias("max_skills"),
        F.coalesce(F.max(F.when(F.col("k") == 0, F.col("c"))), F.lit(0)).alias("zero_skill_ads"),
    )
