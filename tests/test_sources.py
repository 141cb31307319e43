"""Readers, writers, policy and the streaming path."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom import runtime
from corpusloom.operators import cells
from corpusloom.plans import pipeline
from corpusloom.queries.policies import SOUND, changed
from corpusloom.sources import files, policy
from corpusloom.streaming import ingest


def test_ads_know_their_cell(spark, tmp_path):
    folder = tmp_path / "2026"
    folder.mkdir()
    (folder / "data_analyst.jsonl").write_text('{"id":"1","job_title":"A","description":"d"}\n\n{"id":"2","job_title":"B","description":"e"}\n')
    rows = files.read_ads(spark, str(tmp_path)).collect()
    assert {(r["id"], r["year"], r["occupation"]) for r in rows} == {("1", "2026", "data_analyst"), ("2", "2026", "data_analyst")}


def test_dim_last_row_wins(spark, tmp_path):
    path = tmp_path / "dim.csv"
    path.write_text("k,v\na, x \nb,\na,y\n")
    assert {r["k"]: r["v"] for r in files.read_dim(spark, str(path), "k", "v").collect()} == {"a": "y", "b": ""}


def test_graph_files(spark, tmp_path):
    nodes = spark.createDataFrame([("o", "a", 1)], "occupation string, concept_id string, count int")
    edges = spark.createDataFrame([("o", "a", "b", 0.5)], "occupation string, source string, target string, weight double")
    files.write_graphs(nodes, edges, str(tmp_path / "g"))
    doc = json.loads(spark.read.text(str(tmp_path / "g")).first()["value"])
    assert doc["nodes"] == [{"concept_id": "a", "count": 1}] and doc["edges"][0]["target"] == "b"


def test_broken_ads_are_not_lost(spark, tmp_path):
    folder = tmp_path / "2026"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"id":"1"}\n{broken\n{"job_title":"no id"}\n')
    with pytest.raises(Exception, match="no ad with an id"):
        files.read_ads(spark, str(tmp_path)).collect()
    kept = files.read_ads(spark, str(tmp_path), broken="keep").collect()
    assert {r["broken"] for r in kept} == {None, "{broken", '{"job_title":"no id"}'} and len(kept) == 3
    with pytest.raises(ValueError):
        files.read_ads(spark, str(tmp_path), broken="drop")


def test_batch_state_survives(spark, tmp_path):
    path = str(tmp_path / "s")
    state = files.BatchState(spark, path)
    state.submitted("b1", {"x": "y"})
    state.submitted("b2", {})
    assert files.BatchState(spark, path).open() == ["b1", "b2"]
    state.saved("b1")
    assert files.BatchState(spark, path).open() == ["b2"]
    assert {r["name"]: r["ids"] for r in state.state().collect()} == {"b1": {"x": "y"}, "b2": {}}


def test_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "shared_folder", lambda _: f"file://{tmp_path}/shared")
    assert runtime.written(spark.range(3)).count() == 3
    assert list((tmp_path / "shared").rglob("*.parquet"))
    runtime.forget(spark)
    assert not list((tmp_path / "shared").rglob("*.parquet"))


def test_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.shared_folder(Session())


def test_vector_cache_checks_shape(spark, tmp_path):
    df = spark.createDataFrame([("f", [1.0, 2.0])], "form string, vector array<double>")
    with pytest.raises(ValueError):
        files.append_vectors(df, str(tmp_path / "v"), "r1", 3)
    files.append_vectors(df, str(tmp_path / "v"), "r1", 2)
    assert spark.read.parquet(str(tmp_path / "v")).first()["revision"] == "r1"


def test_config_needs_a_version(tmp_path):
    (tmp_path / "c.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        files.load_config(tmp_path / "c.json")
    (tmp_path / "c.toml").write_text('version = "1"\n')
    assert files.load_config(tmp_path / "c.toml")["version"] == "1"
    (tmp_path / "c.yml").write_text("version: 2.1\nrules: {a: b}\n")
    assert files.load_config(tmp_path / "c.yml") == {"version": 2.1, "rules": {"a": "b"}}
    assert files.content_hash({"a": 1, "b": 2}) == files.content_hash({"b": 2, "a": 1})
    assert files.versions_hash({"b": "2", "a": "1"}) == files.versions_hash({"a": "1", "b": "2"}) != files.versions_hash({"a": "2", "b": "1"})


def test_heat_table():
    page = files.heat_table([("a<b", [0.0, 10.0])], ["x", "y"])
    assert "a&lt;b" in page and "#ffffff" in page and "#b22234" in page


def test_policy(tmp_path):
    p = policy.ResolverPolicy(SOUND)
    assert [p.allowed_drift(x) for x in (0.01, 0.10, 0.50)] == pytest.approx([0.02, 0.12, 0.4])
    assert p.within("rollup_edges", 10) and not p.within("rollup_edges", 91)
    assert p.unknown_occupations({"a", "b"}) == {"b"} and p["review.must_read"] == "union"
    with pytest.raises(policy.InvalidPolicy, match="level1.version is missing"):
        policy.ResolverPolicy(changed(SOUND, "level1.version", drop=True))
    with pytest.raises(policy.InvalidPolicy):
        p["no.such.key"]
    (tmp_path / "p.yml").write_text(json.dumps(SOUND))
    assert policy.read_policy(tmp_path / "p.yml").stamp() == {"policy_version": "1", "policy_hash": files.file_hash(tmp_path / "p.yml")}


def test_whole_run(spark):
    posting = spark.createDataFrame([("2021", "o", f"p{i}", "ok") for i in range(10)] + [("2026", "o", f"q{i}", "ok") for i in range(10)], "year string, occupation string, posting_id string, status string")
    rows = [("2021", "o", f"p{i}", " A ") for i in range(8)] + [("2026", "o", f"q{i}", s) for i in range(6) for s in ("a", "B")] + [("2026", "o", "q9", "unknown")]
    mentions = spark.createDataFrame(rows, "year string, occupation string, posting_id string, form string")
    bridge = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, concept_id string")
    dims = spark.createDataFrame([("A", "A", "tool", "cat_x", False), ("B", "B", "tool", "cat_x", False)], "concept_id string, concept_label string, concept_type string, primary_category string, held boolean")
    facets = spark.createDataFrame([("A", "wave", "first")], "concept_id string, facet_id string, value string")
    out = pipeline.run(posting, mentions, bridge, dims, facets, "2021", "2026")
    assert {r["year"]: r["coverage_pct"] for r in out.coverage.collect()} == {"2021": 100.0, "2026": 92.31}
    assert out.penetration.where("grain = 'concept' AND key = 'A' AND year = '2021'").first()["rate"] == 0.8
    assert out.edges.where("year = '2026'").first()["count_ab"] == 6
    assert out.replacements.count() == 0


def test_stream_into_facts(spark, tmp_path):
    source, facts = tmp_path / "in", tmp_path / "facts"
    schema = "year string, occupation string, posting_id string, form string, at timestamp"
    rows = spark.createDataFrame([("2026", "o", "p1", "A"), ("2026", "o", "p1", "A"), ("2026", "o", "p2", "x")], "year string, occupation string, posting_id string, form string")
    rows.withColumn("at", F.lit("2026-01-01 00:00:00").cast("timestamp")).write.parquet(str(source))
    stream = spark.readStream.schema(schema).parquet(str(source))
    seen = []
    once = ingest.new_mentions(stream, ["posting_id", "form"], "at")
    bridge = spark.createDataFrame([("a", "A")], "key string, concept_id string")
    query = ingest.into_facts(once, bridge, str(facts), str(tmp_path / "cp"), lambda c: seen.extend(c.collect()))
    query.awaitTermination(120)
    got = spark.read.parquet(str(facts)).collect()
    assert [(r["posting_id"], r["concept_id"], r["n_mentions"]) for r in got] == [("p1", "A", 1)]
    assert [r["occupation"] for r in seen] == ["o"]


def test_late_second_batch(spark, tmp_path):
    source, facts, kept = (str(tmp_path / name) for name in ("in", "facts", "mentions"))
    schema = "year string, occupation string, posting_id string, form string, at timestamp"
    bridge = spark.createDataFrame([("a", "A"), ("aa", "A"), ("b", "B")], "key string, concept_id string")

    def send(rows):
        day = F.col("at").cast("timestamp").alias("at")
        spark.createDataFrame(rows, "year string, occupation string, posting_id string, form string, at string").select("year", "occupation", "posting_id", "form", day).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = ingest.into_facts(stream, bridge, facts, str(tmp_path / "cp"), key=["posting_id", "form"], mentions=kept)
        query.awaitTermination(120)
        assert query.exception() is None

    send([("2026", "o", "p1", "A", "2026-06-01 00:00:00"), ("2026", "o", "p1", "A", "2026-06-01 00:00:00"), ("2026", "o", "p3", None, "2026-06-01 00:00:00")])
    send([("2026", "o", "p1", "AA", "2026-06-02 00:00:00"), ("2026", "o", "p1", "A", "2026-06-02 00:00:00"), ("2026", "o", "p2", "B", "2026-01-01 00:00:00"), ("2026", "o", "p3", None, "2026-06-01 00:00:00")])
    merged = ingest.merged_facts(spark.read.parquet(facts)).collect()
    assert {(r["posting_id"], r["concept_id"], r["n_mentions"]) for r in merged} == {("p1", "A", 2), ("p2", "B", 1)} and len(merged) == 2
    counts = ingest.windowed_counts(spark.read.parquet(kept), "at", ["year"]).collect()
    assert sorted(r["n"] for r in counts) == [1, 1, 2]


def test_view_denominators_differ(spark):
    rows = spark.createDataFrame([("y", "o", "p1", "a")], "year string, occupation string, posting_id string, g string")
    ads = spark.createDataFrame([("y", "o", "p1"), ("y", "o", "p2")], "year string, occupation string, posting_id string")
    assert cells.view_rates(rows, rows, "g").first()["rate"] == 1.0
    assert cells.view_rates(rows, ads, "g").first()["rate"] == 0.5
