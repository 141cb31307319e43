"""Statistics, cells and adjacency on worked rows."""

import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.operators import adjacency, cells


def values(spark, row, schema, *columns):
    return spark.createDataFrame([row], schema).select(*(c.alias(f"x{i}") for i, c in enumerate(columns))).first()


def test_wilson(spark):
    h, n = F.col("h"), F.col("n")
    assert tuple(values(spark, (0, 0), "h long, n long", stats.share(h, n), *stats.wilson(h, n))) == (0.0, 0.0, 0.0)
    for hits, total in ((0, 10), (3, 10), (10, 10), (1, 500)):
        p, low, high = values(spark, (hits, total), "h long, n long", stats.share(h, n), *stats.wilson(h, n))
        assert 0 <= low <= p + 1e-12 and p <= high + 1e-12 and high <= 1


def test_erfc(spark):
    for x in (0.0, 0.3, 1.0, 2.5, 5.0):
        assert values(spark, (x,), "x double", stats.erfc(F.col("x")))[0] == pytest.approx(math.erfc(x), abs=2e-7)


def test_two_proportions(spark):
    c = [F.col(x) for x in "abcd"]
    assert tuple(values(spark, (0, 10, 0, 20), "a long, b long, c long, d long", *stats.two_proportions(*c))) == (0.0, None, None)
    assert tuple(values(spark, (1, 0, 2, 20), "a long, b long, c long, d long", *stats.two_proportions(*c))) == (None, None, None)
    diff, z, p = values(spark, (10, 100, 30, 100), "a long, b long, c long, d long", *stats.two_proportions(*c))
    assert diff == pytest.approx(0.2) and z == pytest.approx(3.5355, abs=1e-3) and p == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-6)


def test_floors_and_drift(spark):
    n = F.col("n")
    assert tuple(values(spark, (500,), "n long", stats.floor_of(n, 3, 3), stats.floor_of(n, 5, 5))) == (15, 25)
    got = [values(spark, (d,), "d double", stats.drift_limit(F.col("d")))[0] for d in (0.01, 0.10, 0.50)]
    assert got == pytest.approx([0.02, 0.12, 0.40])


FACT = "year string, occupation string, posting_id string, concept_id string, concept_label string, concept_type string, primary_category string, held boolean"


def facts(spark, rows):
    return spark.createDataFrame([("2026", "o", p, c, c, "tool", "cat_a", False) for p, c in rows], FACT)


def test_hub_rule(spark):
    # c_hub in 60 of 100 ads, lift 1.06 with x: passes the graph through the hub rule only.
    rows = [(f"p{i}", "hub") for i in range(60)] + [(f"p{i}", "x") for i in range(7)] + [(f"p{i}", "x") for i in range(60, 64)]
    ads = spark.createDataFrame([("2026", "o", 100)], "year string, occupation string, n_ads long")
    row = adjacency.flagged(adjacency.measured(adjacency.joint_counts(facts(spark, rows), ads)), "2026").first()
    assert row["count_ab"] == 7 and row["lift"] == pytest.approx(1.0606, abs=1e-4) and row["passes_graph"] == 1


def test_penetration_counts_ads_without_concepts(spark):
    ads = spark.createDataFrame([("2026", "o", 4)], "year string, occupation string, n_ads long")
    rows = {(r["grain"], r["key"]): r["rate"] for r in cells.penetration(facts(spark, [("p1", "a"), ("p2", "a"), ("p2", "b")]), ads).collect()}
    assert rows[("concept", "a")] == 0.5 and rows[("category", "cat_a")] == 0.5 and rows[("concept", "b")] == 0.25


def test_requirement_is_the_strongest(spark):
    df = spark.createDataFrame([("y", "o", "p", "c", r) for r in ("unclear", "required", "preferred", None)], "year string, occupation string, posting_id string, concept_id string, requirement string")
    row = cells.posting_concepts(df, "requirement").first()
    assert row["requirement"] == "required" and row["n_mentions"] == 4


def test_export_defaults(spark):
    nodes = spark.createDataFrame([("o", "c")], "occupation string, concept_id string")
    edges = spark.createDataFrame([], "occupation string, concept_a string, concept_b string")
    dims = spark.createDataFrame([], "concept_id string, concept_label string, concept_type string, primary_category string, held boolean")
    facets = spark.createDataFrame([], "concept_id string, facet_id string, value string")
    rates = spark.createDataFrame([], "grain string, occupation string, key string, hits long, rate double, wilson_low double, wilson_high double")
    row = adjacency.export_nodes(nodes, edges, dims, facets, rates).first()
    assert row["relatedness"] == "ai_independent" and row["degree"] == 0 and row["penetration"] == 0.0 and row["wave"] == ""
