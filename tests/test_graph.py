"""Components, splitting, closure, neighbours, duplicates against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import components as g
from corpusloom.operators import duplicates


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    nodes = list(range(80))
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(60, 79)]
    df = spark.createDataFrame(edges, "a long, b long")
    alone = spark.createDataFrame([(n,) for n in nodes], "node long")
    got = {r["node"]: r["component"] for r in g.components(df, "a", "b", alone).collect()}
    assert got == {r["node"]: r["component"] for r in g.components(df, "a", "b", alone, local_edges=0).collect()}
    assert got == union_find(nodes, edges)


def test_components_of_nothing(spark):
    assert g.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("local_edges", [1_000, 5])
def test_split_oversized(spark, local_edges):
    rng = random.Random(2)
    edges = [(a, b, round(rng.uniform(0.3, 0.8), 2)) for a in range(24) for b in range(a + 1, 24) if rng.random() < 0.25]
    df = spark.createDataFrame(edges, "a long, b long, similarity double")
    labels = g.threshold_components(df, 0.3)
    rows = g.split_oversized(df, labels, 0.3, most=5, step=0.1, local_edges=local_edges).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["piece"], []).append(r)
    assert len(rows) == len({r["node"] for r in rows}) == labels.count()
    for piece, members in sizes.items():
        assert len(members) <= 5
        ids, t = {r["node"] for r in members}, members[0]["threshold"]
        inner = [(a, b) for a, b, s in edges if a in ids and b in ids and s >= t]
        assert len(set(union_find(ids, inner).values())) == 1


def test_closure_and_circle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "c")], "parent string, child string")
    got = {(r["ancestor"], r["descendant"]): r["depth"] for r in g.closure(edges).collect()}
    assert got == {("a", "b"): 1, ("b", "c"): 1, ("c", "d"): 1, ("a", "c"): 1, ("b", "d"): 2, ("a", "d"): 2}
    with pytest.raises(ValueError):
        g.closure(spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string"))


def test_nearest_in_blocks(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(50, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "i long, v array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    want = set()
    for i in range(50):
        for j in sorted((j for j in range(50) if j != i), key=lambda j: (-sims[i, j], j))[:3]:
            want.add((min(i, j), max(i, j)))
    assert {(r["a"], r["b"]) for r in g.nearest(df, "i", "v", 3, block=20).collect()} == want


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(40)) for _ in range(12)]
    docs = []
    for text in base:
        docs.append(text)
        words = text.split()
        words[rng.randrange(40)] = "zz1"
        docs.append(" ".join(words))
        docs.append(text.upper())
        words[3] = words[20] = words[33] = "yy"
        docs.append(" ".join(words))
    docs += ["", "short one", None]
    df = spark.createDataFrame(list(enumerate(docs)), "i long, t string")
    sets = {i: _shingles(t) for i, t in enumerate(docs) if t is not None}
    links = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    got = {r["i"]: r["class_id"] for r in duplicates.near_classes(df, "i", "t").collect()}
    assert got == union_find(sorted(sets), links)


def _shingles(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_drift(spark):
    before = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "x")], "parent string, child string")
    after = spark.createDataFrame([("p", "b"), ("p", "c"), ("r", "x")], "parent string, child string")
    row = g.drift(before, after).collect()
    assert len(row) == 1 and row[0]["drift"] == pytest.approx(0.6667) and (row[0]["lost"], row[0]["won"]) == (1, 1)


def test_long_chains_settle_in_rounds(spark):
    df = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 900)], "a long, b long")
    got = {r["node"]: r["component"] for r in g.components(df, "a", "b", local_edges=0).collect()}
    assert got == {k: 0 for k in range(301)} | {900: 900}


def test_large_ads_give_the_same_pairs(spark):
    from corpusloom.operators import adjacency

    facts = spark.createDataFrame([("y", "o", f"p{p}", f"c{c:02}") for p in range(4) for c in range(3 + 9 * p)], "year string, occupation string, posting_id string, concept_id string")
    ads = spark.createDataFrame([("y", "o", 4)], "year string, occupation string, n_ads long")
    whole, cut = ({tuple(r) for r in adjacency.joint_counts(facts, ads, False, block=b).collect()} for b in (512, 4))
    assert whole == cut and len(whole) == 30 * 29 // 2


def test_first_word_pairs_against_brute_force(spark):
    import itertools
    import random

    from corpusloom.operators import resolve

    rng = random.Random(3)
    forms = sorted({" ".join(rng.choice("data date dates model models modeling tool tools big ops a".split()) for _ in range(rng.randrange(1, 5))) for _ in range(120)})
    df = spark.createDataFrame([(f, 2) for f in forms], "form string, count long")
    scores = {(a, b): resolve.token_set_ratio(a, b) for a, b in itertools.combinations(forms, 2) if a.split()[0] == b.split()[0]}
    for hot in (5_000, 7):
        got = {(r["a"], r["b"]): round(r["score"], 6) for r in resolve.first_word_pairs(df, 80, hot=hot).collect()}
        assert got == {k: round(v, 6) for k, v in scores.items() if v >= 80}


def test_numbers_without_gaps(spark):
    from corpusloom.operators.numbering import numbered

    got = {r["id"]: r["number"] for r in numbered(spark.range(500).repartition(5), F.desc("id")).collect()}
    assert got == {k: 499 - k for k in range(500)}
    assert numbered(spark.range(0), "id").count() == 0


def test_probed_neighbours_recall(spark):
    rng = np.random.default_rng(5)
    heads = rng.normal(size=(30, 24))
    rows = [(k, [float(x) for x in heads[k % 30] + 0.5 * rng.normal(size=24)]) for k in range(1500)]
    df = spark.createDataFrame([*rows, (None, [0.0] * 24), (9_999, None)], "id long, v array<double>")
    exact = {(r["a"], r["b"]) for r in g.nearest(df, "id", "v", 10).collect()}
    found = {(r["a"], r["b"]): r["similarity"] for r in g.nearest_probed(df, "id", "v", 10).collect()}
    assert len(exact & set(found)) / len(exact) >= 0.9
    # With every list asked and lists cut into blocks it is exact.
    every = {(r["a"], r["b"]) for r in g.nearest_probed(df.limit(300), "id", "v", 5, lists=6, probes=6, block=16).collect()}
    assert every == {(r["a"], r["b"]) for r in g.nearest(df.limit(300), "id", "v", 5).collect()}
    assert g.nearest_probed(df.limit(0), "id", "v", 5).count() == 0
