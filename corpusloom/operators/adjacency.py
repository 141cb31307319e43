"""Co-occurrence of concepts within ads, the graph made of it, and replacements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.operators.cells import BOILERPLATE, CELL
from corpusloom.operators.numbering import numbered

GRAPH_LIFT, HUB_SUPPORT, HUB_LIFT = 1.3, 0.60, 1.05
GRAPH_PERCENT, GRAPH_LEAST = 3, 3
ANALYSIS_PERCENT, ANALYSIS_LEAST = 5, 5
#: Concepts of an ad whose pairs are made at once.
BLOCK = 512


def countable(facts: DataFrame) -> DataFrame:
    """Facts that take part in co-occurrence: neither held nor boilerplate."""
    return facts.where(~F.col("held") & (F.col("primary_category") != BOILERPLATE))


def singles(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*CELL, "concept_id").agg(F.count(F.lit(1)).alias("count"))


def joint_counts(facts: DataFrame, ads: DataFrame, prune: bool = True, block: int = BLOCK) -> DataFrame:
    """Pairs ``concept_a < concept_b`` with joint and single counts.

    ``prune``: concepts too rare for either floor are left out before pairs are
    made.  A pair is no more frequent than its rarer concept, so pairs that
    reach a floor are all there; those below may be missing.

    Each concept of a cell gets a number in name order, so a pair is two longs
    until it is counted.  An ad of more than ``block`` concepts is cut into
    blocks and gives its pairs block by block.
    """
    single = singles(facts).join(ads, CELL)
    if prune:
        n = F.col("n_ads")
        least = F.least(
            stats.floor_of(n, GRAPH_PERCENT, GRAPH_LEAST), stats.floor_of(n, ANALYSIS_PERCENT, ANALYSIS_LEAST)
        )
        single = single.where(F.col("count") >= least)
    single = numbered(single, *CELL, "concept_id", name="s")
    kept = facts.select(*CELL, "posting_id", "concept_id").join(single.select(*CELL, "concept_id", "s"), [*CELL, "concept_id"])
    # Baskets as arrays: one shuffle by ad, pairs are made within the row.
    baskets = kept.groupBy(*CELL, "posting_id").agg(F.array_sort(F.collect_set("s")).alias("c")).where(F.size("c") > 1).select("c")
    parts = f"sequence(1, size(c), {block})"
    units = baskets.select(F.explode(F.expr(
        f"flatten(transform({parts}, i -> transform(filter({parts}, j -> j >= i), j -> struct(slice(c, i, {block}) AS x, slice(c, j, {block}) AS y, i = j AS same))))"
    )).alias("u")).select("u.*")
    pairs = units.select(F.explode(F.expr(
        "flatten(transform(x, (a, k) -> transform(if(same, slice(y, k + 2, size(y)), y), b -> struct(a, b))))"
    )).alias("p")).select("p.a", "p.b")
    joint = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("count_ab"))
    a = single.select(*CELL, F.col("s").alias("a"), F.col("concept_id").alias("concept_a"), F.col("count").alias("count_a"), "n_ads")
    b = single.select(F.col("s").alias("b"), F.col("concept_id").alias("concept_b"), F.col("count").alias("count_b"))
    return joint.join(a, "a").join(b, "b").select(*CELL, "concept_a", "concept_b", "count_ab", "count_a", "n_ads", "count_b")


def measured(pairs: DataFrame) -> DataFrame:
    """Support, confidence, lift and mean confidence (A10); exact ones with a ``_``."""
    ab, a, b, n = (F.col(c) for c in ("count_ab", "count_a", "count_b", "n_ads"))
    return pairs.withColumns({
        "_lift": stats.lift(ab, a, b, n), "_geo": stats.geo_confidence(ab, a, b),
        "support_a": F.round(a / n, 6), "support_b": F.round(b / n, 6), "support_ab": F.round(ab / n, 6),
        "conf_ab": F.round(ab / a, 6), "conf_ba": F.round(ab / b, 6),
    }).withColumns({"lift": stats.half_up(F.col("_lift"), 4), "geo_mean_conf": F.round("_geo", 6)})


def flagged(pairs: DataFrame, graph_year: str) -> DataFrame:
    """Pairs that pass the graph or the analysis floor (A11), on unrounded lift."""
    ab, a, b, n, lift = (F.col(c) for c in ("count_ab", "count_a", "count_b", "n_ads", "_lift"))
    hub = (F.greatest(a, b) / n >= HUB_SUPPORT) & (lift > HUB_LIFT)
    graph = (F.col("year") == graph_year) & (ab >= stats.floor_of(n, GRAPH_PERCENT, GRAPH_LEAST)) & ((lift > GRAPH_LIFT) | hub)
    analysis = (ab >= stats.floor_of(n, ANALYSIS_PERCENT, ANALYSIS_LEAST)) & (a >= ANALYSIS_LEAST) & (b >= ANALYSIS_LEAST) & (lift > 1)
    both = measured_if_needed(pairs).withColumns({"passes_graph": graph.cast("int"), "passes_analysis": analysis.cast("int")})
    return both.where((F.col("passes_graph") == 1) | (F.col("passes_analysis") == 1))


def measured_if_needed(pairs: DataFrame) -> DataFrame:
    return pairs if "_lift" in pairs.columns else measured(pairs)


def graph_nodes(facts: DataFrame, ads: DataFrame, graph_year: str) -> DataFrame:
    """Concepts of the graph year that reach the graph floor (A9): a population, not the edges' ends."""
    n = F.col("n_ads")
    return (
        singles(facts.where(F.col("year") == graph_year)).join(ads, CELL)
        .where(F.col("count") >= stats.floor_of(n, GRAPH_PERCENT, GRAPH_LEAST))
        .withColumn("support", F.round(F.col("count") / n, 6))
    )


def both_ways(edges: DataFrame, a: str, b: str, *keep: str) -> DataFrame:
    """Undirected edges as two directed ones: ``source, target`` and the kept columns."""
    return edges.select(*keep, F.col(a).alias("source"), F.col(b).alias("target")).unionByName(
        edges.select(*keep, F.col(b).alias("source"), F.col(a).alias("target"))
    )


def degrees(nodes: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """Edges at each node, 0 where none."""
    ends = both_ways(edges, "concept_a", "concept_b", *by)
    counts = ends.groupBy(*by, F.col("source").alias("concept_id")).agg(F.count(F.lit(1)).alias("degree"))
    return nodes.join(counts, [*by, "concept_id"], "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def replacement_anchors(
    changes: DataFrame, edges: DataFrame, base: str, target: str, occupations: list[str] | None = None,
    rate_floor: float = 0.10, z_least: float = stats.Z95,
) -> DataFrame:
    """Concepts X that fell and Y that rose around a common neighbour C.

    C is a neighbour of X in the base year and of Y in the target year; X's tie
    to C weakened and Y's grew.  A missing tie weighs 0.
    """
    moved = changes.where((F.col("grain") == "concept") & (F.abs("z") > z_least))
    if occupations is not None:
        moved = moved.where(F.col("occupation").isin(occupations))
    cols = ("key", "label", "rate_base", "rate_target", "diff", "p_value")
    x = moved.where((F.col("direction") == "down") & (F.col("rate_base") >= rate_floor)).select("occupation", *(F.col(c).alias(f"x_{c}") for c in cols))
    y = moved.where((F.col("direction") == "up") & (F.col("rate_target") >= rate_floor)).select("occupation", *(F.col(c).alias(f"y_{c}") for c in cols))
    ties = both_ways(edges.where(F.col("passes_analysis") == 1), "concept_a", "concept_b", "year", "occupation", "geo_mean_conf")

    def tie(year: str, end: str, name: str) -> DataFrame:
        return ties.where(F.col("year") == year).select("occupation", F.col("source").alias(end), F.col("target").alias("c"), F.col("geo_mean_conf").alias(name))

    pairs = (
        x.join(tie(base, "x_key", "xc_base"), ["occupation", "x_key"])
        .join(y.join(tie(target, "y_key", "yc_target"), ["occupation", "y_key"]), ["occupation", "c"])
        .where((F.col("x_key") != F.col("y_key")) & (F.col("c") != F.col("x_key")) & (F.col("c") != F.col("y_key")))
        .join(tie(target, "x_key", "xc_target"), ["occupation", "x_key", "c"], "left")
        .join(tie(base, "y_key", "yc_base"), ["occupation", "y_key", "c"], "left")
        .fillna(0.0, ["xc_target", "yc_base"])
        .where((F.col("xc_target") < F.col("xc_base")) & (F.col("yc_target") > F.col("yc_base")))
    )
    score = (
        F.col("x_rate_base") - F.col("x_rate_target") + F.col("y_rate_target") - F.col("y_rate_base")
        + F.col("yc_target") - F.col("yc_base") + F.col("xc_base") - F.col("xc_target")
    )
    return pairs.withColumn("score", F.round(score, 4))


def replacement_candidates(anchors: DataFrame) -> DataFrame:
    """One row per occupation, X and Y with its anchors counted and the best named.

    Of equal scores the anchor that sorts first leads.
    """
    key = ["occupation", "x_key", "y_key"]
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "c")
    # Three leaders per pair suffice for the names, so nothing unbounded is collected.
    lead = anchors.withColumn("r", F.row_number().over(order)).where(F.col("r") <= 3)
    names = lead.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "c"))), lambda s: s["c"]), "; ").alias("top_anchors"))
    sums = anchors.groupBy(*key).agg(F.count(F.lit(1)).alias("n_anchors"), F.max("score").alias("best_score"))
    return sums.join(names, key)


def export_nodes(nodes: DataFrame, edges: DataFrame, dims: DataFrame, facets: DataFrame, rates: DataFrame, default_value: str = "ai_independent") -> DataFrame:
    """Node rows of the export (G12): population and edge ends, with defaults.

    ``rates``: concept penetration of the graph year.
    """
    ends = both_ways(edges, "concept_a", "concept_b", "occupation").select("occupation", F.col("source").alias("concept_id"))
    every = nodes.select("occupation", "concept_id").unionByName(ends).distinct()
    lists = (
        facets.where(F.col("value") != "none").groupBy("concept_id").agg(
            F.min(F.when(F.col("facet_id") == "relatedness", F.col("value"))).alias("relatedness"),
            F.array_sort(F.collect_set(F.when(F.col("facet_id") == "wave", F.col("value")))).alias("wave"),
        )
    )
    share = rates.where(F.col("grain") == "concept").select("occupation", F.col("key").alias("concept_id"), "hits", "rate", "wilson_low", "wilson_high")
    out = degrees(every, edges, ["occupation"]).join(dims, "concept_id", "left").join(lists, "concept_id", "left").join(share, ["occupation", "concept_id"], "left")
    zero = F.lit(0.0)
    return out.select(
        "occupation", "concept_id", F.coalesce("concept_label", F.lit("")).alias("label"),
        F.coalesce("concept_type", F.lit("")).alias("type"), F.coalesce("primary_category", F.lit("")).alias("category"),
        F.coalesce("relatedness", F.lit(default_value)).alias("relatedness"),
        F.array_join(F.coalesce("wave", F.array().cast("array<string>")), "|").alias("wave"),
        F.coalesce("hits", F.lit(0)).alias("count"), stats.half_up(F.coalesce("rate", zero), 4).alias("penetration"),
        stats.half_up(F.coalesce("wilson_low", zero), 4).alias("ci_low"), stats.half_up(F.coalesce("wilson_high", zero), 4).alias("ci_high"), "degree",
    )


def export_edges(edges: DataFrame) -> DataFrame:
    return edges.select("occupation", F.col("concept_a").alias("source"), F.col("concept_b").alias("target"), F.col("geo_mean_conf").alias("weight"), "lift")


def export_index(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes and edges per occupation."""
    n = nodes.groupBy("occupation").agg(F.count(F.lit(1)).alias("nodes"))
    e = edges.groupBy("occupation").agg(F.count(F.lit(1)).alias("edges"))
    return n.join(e, "occupation", "left").withColumn("edges", F.coalesce("edges", F.lit(0)))
