"""Votes, decisions, evidence and checks on worked rows."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import govern

RUN = "c string, run int, type string, abstain boolean, held_reason string, confidence double"


def vote(spark, *types, abstain=(False, False, False), why=(None, None, None)):
    rows = [("x", i, t, a, w, 0.5) for i, (t, a, w) in enumerate(zip(types, abstain, why))]
    return govern.type_votes(spark.createDataFrame(rows, RUN), "c").first()


def test_type_votes(spark):
    row = vote(spark, "tool", "tool", "method")
    assert (row["type"], row["stable"], row["source"]) == ("tool", False, "model")
    row = vote(spark, "tool", "method", "practice")
    assert (row["type"], row["abstain"], row["held_reason"]) == ("", True, "type_tie")
    row = vote(spark, "tool", None, None)
    assert (row["type"], row["held_reason"], row["source"], row["confidence"], row["run_variants"]) == ("", "insufficient_evidence", "model_unresolved", 0.0, "tool")
    assert vote(spark, "tool", "method", "tool")["run_variants"] == "tool/method/tool"
    row = vote(spark, "tool", "tool", "tool", abstain=(True, True, False), why=("ambiguous", "ambiguous", None))
    assert (row["held_reason"], row["source"], row["stable"]) == ("ambiguous", "model_held", True)


def test_category_votes(spark):
    rows = [("x", 1, ["a", "b"], "a", False), ("x", 2, ["b", "a"], "b", False), ("x", 3, ["c"], "b", False), ("y", 1, [], None, True), ("y", 2, [], None, True), ("y", 3, ["a"], "a", False)]
    got = {r["c"]: r for r in govern.category_votes(spark.createDataFrame(rows, "c string, run int, categories array<string>, primary string, unassigned boolean"), "c").collect()}
    assert got["x"]["categories"] == "b|a" and got["x"]["primary_category"] == "b" and not got["x"]["stable"]
    assert got["y"]["unassigned"] and got["y"]["categories"] == "" and got["y"]["run_variants"] == "UNASSIGNED | UNASSIGNED | a"


def test_pair_key_has_no_order(spark):
    df = spark.createDataFrame([("b", "a"), ("a", "b")], "x string, y string")
    assert df.select(govern.pair_key(F.col("x"), F.col("y"))).distinct().count() == 1
    assert df.select(govern.edge_key(F.col("x"), F.col("y"))).distinct().count() == 2


def test_no_model_over_a_person(spark):
    schema = "parent string, child string, verdict string, by string"
    old = spark.createDataFrame([("p", "c", "reject", "human"), ("p", "d", "reject", "model")], schema)
    new = spark.createDataFrame([("p", "c", "rollup", "model"), ("p", "d", "rollup", "model")], schema)
    got = {r["child"]: r["verdict"] for r in govern.upserted(old, new, ["parent", "child"]).collect()}
    assert got == {"c": "reject", "d": "rollup"}


def test_partition_check(spark):
    inputs = spark.createDataFrame([("g", "a"), ("g", "b")], "group_id string, form string")
    members = spark.createDataFrame([("g", "L", "a"), ("g", "M", "a"), ("g", "", "z")], "group_id string, label string, form string")
    got = {(r["form"], r["problem"]) for r in govern.partition_problems(members, inputs).collect()}
    assert got == {("b", "missing"), ("z", "invented"), ("a", "in two concepts"), ("z", "empty label")}
    rows = [("g", "L", "a", "product_and_technology"), ("g", "L", "b", "product_and_technology"), ("g", "M", None, "no_vendor")]
    members = spark.createDataFrame(rows, "group_id string, label string, form string, vendor_relation string")
    assert {(r["form"], r["problem"]) for r in govern.partition_problems(members, inputs).collect()} == {("L", "merged product and technology"), ("M", "no members")}
    row = govern.partition_ledger(members, inputs).first()
    assert (row["status"], row["reason"], row["forms"]) == ("failed", "no members", "M")
    assert govern.partition_ledger(members.where("label = 'L'").drop("vendor_relation"), inputs).first()["status"] == "ok"


def test_retries_and_transport():
    calls = []

    def call():
        calls.append(1)
        if len(calls) == 1:
            raise ValueError
        return len(calls)

    assert govern.with_retries(call, lambda n: n >= 3, 3, lambda n: 0) == 3
    assert govern.with_retries(call, lambda n: False, 2, lambda n: 0) == 5
    assert govern.transport(199, 200) == "standard" and govern.transport(200, 200) == "batch"
    with pytest.raises(ValueError):
        govern.same_version("a", "b")


def test_corrections_must_meet_one_row(spark):
    values = spark.createDataFrame([("f", "c", "v", "m", "model")], "facet_id string, concept_id string, value string, model string, by string")
    good = spark.createDataFrame([("f", "c", "w")], "facet_id string, concept_id string, value string")
    row = govern.corrected(values, good).first()
    assert (row["value"], row["by"], row["model"]) == ("w", "human", "")
    with pytest.raises(ValueError):
        govern.corrected(values, spark.createDataFrame([("f", "lost", "w")], good.schema))


def test_evidence(spark):
    rows = [("Data Ops", "ops", "We do “data ops” daily. data ops!"), ("none", "ops", "some OPS"), ("", "zzz", "text")]
    df = spark.createDataFrame(rows, "e string, n string, d string")
    assert [r["evidence_match"] for r in govern.evidence_tiers(df, "e", "n", "d").collect()] == ["span", "name", None]


def test_records_of_both_shapes(spark):
    lines = ['{"id":"1","skills":["a","b"]}', '{"id":"2","status":"ok","skills":[{"skill":"c"}]}', '{"id":"3","status":"truncated","skills":[]}', '{"id":"4","skills":["x"],"extraction_error":true}', "broken"]
    df = spark.createDataFrame([(x,) for x in lines], "raw string")
    assert {(r["id"], tuple(r["skills"])) for r in govern.skill_records(df, "raw").collect()} == {("1", ("a", "b")), ("2", ("c",))}
    assert govern.skill_records(df, "raw", ok_only=False).count() == 4


def test_chunks_and_samples(spark):
    df = spark.range(1000).repartition(7)
    sizes = [r["count"] for r in govern.chunked(df, 40, "id").groupBy("chunk").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) == 40
    pick = lambda: sorted(r["id"] for r in govern.seeded_sample(df.withColumn("s", F.col("id") % 2), ["s"], ["id"], 5, 7).collect())
    assert pick() == pick() and len(pick()) == 10


def test_latest_takes_whole_rows(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, None), ("j", 5, "z")], "k string, seq int, v string")
    assert {(r["k"], r["seq"], r["v"]) for r in govern.latest(df, ["k"], "seq").collect()} == {("k", 2, None), ("j", 5, "z")}
