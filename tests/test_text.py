"""Documented examples and edge cases of the string layer."""

import hypothesis.strategies as st
import pytest
from hypothesis import given
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import resolve

ACRONYMS = {"nlp": "natural language processing"}


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given_", "wanted"),
    [
        ("Large Language Models (LLMs)", "large language models"), ("NLP", "natural language processing"),
        (" Data  Ops​ ", "data ops"), ("“A” – B…", '"a" - b...'), ("", ""), ("(x)", ""),
    ],
)
def test_level1(spark, given_, wanted):
    assert one(spark, text.level1(F.col("s"), ACRONYMS), s=given_) == wanted


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    for f in (text.join_key, text.strip_parenthesis, text.evidence_flatten, text.token_key, text.concept_id):
        assert df.select(f(F.col("s")).alias("x")).first()["x"] is None


def test_plurals(spark):
    assert one(spark, text.plural_forms(F.col("s")), s="data library") == ["data librarys", "data libraries"]
    assert one(spark, text.plural_forms(F.col("s")), s="box") == ["boxs", "boxes"]
    assert one(spark, text.plural_forms(F.col("s")), s="relay") == ["relays"]


def test_concept_id_ignores_case_and_blanks(spark):
    ids = {one(spark, text.concept_id(F.col("s")), s=s) for s in ("Data  Ops", "data ops", " DATA OPS ")}
    assert len(ids) == 1 and ids.pop().startswith("cpt_")


def test_sanitised_ids_do_not_collide(spark):
    from corpusloom.operators.govern import unique_ids

    rows = unique_ids(spark.createDataFrame([("a b",), ("a_b",), ("a/b",), ("c" * 80,)], "i string"), "i").collect()
    assert len({r["custom_id"] for r in rows}) == 4
    assert all(len(r["custom_id"]) <= 64 for r in rows)


def test_map_version_is_order_free():
    assert text.map_version("v1", {"a": "b", "c": "d"}) == text.map_version("v1", {"c": "d", "a": "b"})
    assert text.map_version("v1", {"a": "b"}) != text.map_version("v1", {"a": "c"})


RULES = resolve.Rules(
    exact={
        "orthography": {"k-nn": "k nearest"}, "alias": {"k nearest": "k-nearest neighbours", "etl pipelines": "etl"},
        "vendor_prefix": {"apache spark": "spark"},
    },
    suffixes=frozenset({"tools", "suite"}), protected=frozenset({"data tools", "r"}),
    blocked_results=frozenset({"ai"}), blocked_endings=("-driven",), version="t",
)


@pytest.mark.parametrize(
    ("form", "wanted", "method"),
    [
        ("etl pipelines", "etl", "alias"), ("k-nn", "k-nearest neighbours", "orthography+alias"), ("ai tools", "ai tools", "unchanged"),
        ("data tools", "data tools", "protected"), ("apache spark", "spark", "vendor_prefix"), ("azure sql", "azure sql", "unchanged"),
        ("etl tools suite", "etl", "empty_suffix:suite+empty_suffix:tools"), ("ai-driven tools", "ai-driven tools", "unchanged"),
    ],
)
def test_rule_engine(form, wanted, method):
    assert RULES.normalise(form) == (wanted, method, True)


@given(st.lists(st.sampled_from(["etl", "tools", "suite", "ai", "k-nn", "data", "spark", "apache"]), min_size=1, max_size=5))
def test_rule_engine_is_idempotent(words):
    once = RULES.normalise(" ".join(words))[0]
    assert RULES.normalise(once)[0] == once


def test_rules_refuse_conflicts_and_circles():
    with pytest.raises(resolve.RuleError):
        resolve.Rules(exact={"a": {"x": "y"}, "b": {"x": "z"}})
    with pytest.raises(resolve.RuleError):
        resolve.Rules(exact={"a": {"x": "y", "y": "x"}})


def test_suffix_column_equals_engine(spark):
    forms = ["etl tools", "ai tools", "tools", "ai-driven suite", "a b c", ""]
    df = spark.createDataFrame([(f,) for f in forms], "form string")
    got = {r["form"]: r["x"] for r in df.withColumn("x", resolve.suffix_stripped(F.col("form"), RULES)).collect()}
    for f in forms:
        assert got[f] == (RULES.without_suffix(f) or (f,))[0]


def test_token_set_ratio():
    assert resolve.token_set_ratio("data science", "science data") == 100
    assert resolve.token_set_ratio("data", "data science") == 100
    assert resolve.token_set_ratio("abc", "xyz") == 0
    assert resolve.token_set_ratio("", "x") == 0


words_ = st.lists(st.text("abc", min_size=1, max_size=4), min_size=1, max_size=4).map(" ".join)


@given(words_, words_)
def test_token_set_ratio_is_symmetric(a, b):
    x = resolve.token_set_ratio(a, b)
    assert 0 <= x <= 100 and x == resolve.token_set_ratio(b, a)
    assert resolve.token_set_ratio(a, a) == 100


@given(st.text("ab", max_size=8), st.text("ab", max_size=8))
def test_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert resolve._longest_common(a, b) == table[-1][-1]


def test_families(spark):
    counts = spark.createDataFrame(
        [("algorithms and data structures", 2), ("data structures and algorithms", 5), ("rapid", 3), ("rapids", 9), ("api", 4), ("apis", 1)], "form string, count long"
    )
    a = {r["form"]: r["canonical"] for r in resolve.token_set_families(counts).collect()}
    assert a == {"algorithms and data structures": "data structures and algorithms", "data structures and algorithms": "data structures and algorithms"}
    caps = spark.createDataFrame([("rapids",)], "form string")
    b = {r["form"]: r["canonical"] for r in resolve.plural_families(counts, caps).collect()}
    assert b == {"api": "api", "apis": "api"}


def test_rollup_two_parents_and_demotion(spark):
    counts = spark.createDataFrame([("azure", 5), ("sql", 9), ("azure sql", 2), ("data pipelines", 3), ("ai pipelines", 1)], "form string, count long")
    pairs = resolve.token_pairs(counts, ["data"]).withColumnsRenamed({"parent": "a", "child": "b"})
    rows = resolve.judged_edges(pairs, counts, ["data"], ["tools"]).collect()
    kept = {(r["parent"], r["child"]) for r in rows if r["reason"] is None}
    assert kept == {("azure", "azure sql"), ("sql", "azure sql")}
    assert {(r["parent"], r["child"]) for r in rows if r["reason"] == "stopword-only subset -> related"} == {("data pipelines", "ai pipelines")}
