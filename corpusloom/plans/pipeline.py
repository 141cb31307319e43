"""The whole run: mentions to penetration, change tests, adjacency and graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import adjacency, cells
from corpusloom.runtime import written


@dataclass(frozen=True)
class Results:
    facts: DataFrame
    coverage: DataFrame
    penetration: DataFrame
    changes: DataFrame
    edges: DataFrame
    nodes: DataFrame
    replacements: DataFrame


def run(posting: DataFrame, mentions: DataFrame, bridge: DataFrame, dims: DataFrame, facets: DataFrame, base: str, target: str) -> Results:
    """All statistics from one fact table, which is written once and read by every branch.

    ``mentions(year, occupation, posting_id, form[, requirement])``.
    """
    matched = cells.matched_mentions(mentions, bridge)
    requirement = "requirement" if "requirement" in mentions.columns else None
    facts = written(cells.with_dims(cells.posting_concepts(matched.where(F.col("concept_id").isNotNull()), requirement), dims), "facts")
    ads = written(cells.ad_counts(posting), "ads")
    rates = written(cells.penetration(facts, ads, facets), "rates")
    changes = cells.change_tests(rates, ads, base, target)
    used = adjacency.countable(facts)
    edges = written(adjacency.flagged(adjacency.measured(adjacency.joint_counts(used, ads)), target).drop("_lift", "_geo"), "edges")
    anchors = adjacency.replacement_anchors(changes, edges, base, target)
    return Results(
        facts, cells.coverage(matched, cells.CELL), rates, changes, edges,
        adjacency.graph_nodes(used, ads, target), adjacency.replacement_candidates(anchors),
    )
