"""Graphs as edge tables: components, thresholds, closure, neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.numbering import numbered
from corpusloom.runtime import written

#: Edges up to which a component is split within one task.
LOCAL_EDGES = 200_000


def components(
    edges: DataFrame, a: str, b: str, nodes: DataFrame | None = None, most_rounds: int = 60, local_edges: int = LOCAL_EDGES
) -> DataFrame:
    """``(node, component)`` with the smallest node as the component's name (G1).

    A graph of up to ``local_edges`` edges is joined up in one task.  For a
    larger one each round takes the smallest label among a node's neighbours,
    then the label of that label, so long chains halve; a round is one table
    in the shared folder, and rounds end when no label changes.
    ``nodes(node)`` adds isolated nodes.
    """
    links = written(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).distinct(), "links")
    ends = links.select(F.col("x").alias("node")).unionByName(links.select(F.col("y").alias("node")))
    links = links.where(F.col("x") != F.col("y"))
    if links.count() <= local_edges:
        joined = _joined_up(links)
        if nodes is not None:
            ends = ends.unionByName(nodes.select("node"))
        alone = ends.distinct().join(joined.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
        return joined.unionByName(alone)
    if nodes is not None:
        ends = ends.unionByName(nodes.select("node"))
    both = written(links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = written(ends.distinct().withColumn("component", F.col("node")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels.withColumnsRenamed({"node": "y", "component": "l"}), "y").groupBy(F.col("x").alias("node")).agg(F.min("l").alias("l"))
        lower = labels.join(near, "node", "left").select("node", F.col("component").alias("old"), F.least("component", F.coalesce("l", "component")).alias("mid"))
        # The label of the label, as of the round before: it lies in the same component and is no larger.
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        new = written(lower.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where(F.col("old") != F.col("component")).isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _joined_up(links: DataFrame) -> DataFrame:
    """Components of a small graph in one task."""
    kind = dict(links.dtypes)["x"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for x, y in zip(batch["x"], batch["y"]):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        yield pd.DataFrame([(x, root(x)) for x in list(parent)], columns=["node", "component"], dtype=object)

    return written(links.coalesce(1).mapInPandas(run, f"node {kind}, component {kind}"), "labels")


def nearest(vectors: DataFrame, row_id: str, vector: str, k: int, block: int = 4096) -> DataFrame:
    """``(a, b, similarity)``, ``a < b``: b among the k nearest of a or a among those of b.

    Brute force, as the operator asks for: every vector against all others.
    Vectors lie in blocks; a task multiplies two blocks and hands on the best k
    per row only, so no pair outside them is ever a row.  Of equal similarity
    (6 digits) the smaller id comes first.  For many vectors see ``nearest_probed``.
    """
    rows = vectors.select(F.col(row_id).alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    parts = max(1, -(-rows.count() // block))
    blocks = written(_blocks(rows.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")), ["g"]), "blocks")
    # Pairs of block numbers, not of rows.
    left = blocks.select(F.col("g").alias("gl"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("g"))
    work = left.join(blocks, "g").withColumnRenamed("m", "right").join(blocks.withColumnsRenamed({"g": "gl", "m": "left"}), "gl")
    return _links(_best(work, dict(vectors.dtypes)[row_id], k, max(parts, 1) ** 2 if parts < 64 else 4096))


def nearest_probed(
    vectors: DataFrame, row_id: str, vector: str, k: int, lists: int | None = None, probes: int = 24, sample: int = 20_000, block: int = 4096, seed: int = 7
) -> DataFrame:
    """The links of ``nearest``, found among the lists that each vector is nearest to; not all of them.

    ``lists`` centres (default: about the root of the number of vectors) are
    fitted on ``sample`` vectors at most, picked by hash; every vector is filed
    under its nearest centre and compared with those of its ``probes`` nearest
    ones, so the work grows with ``n ** 1.5``.  Long lists are cut into blocks,
    nothing is left out of one.  Recall against brute force: 0.96 on the 2,000
    test vectors of sf0.1, which have no clusters; 0.9 or more is tested.
    """
    rows = written(vectors.select(F.col(row_id).alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()), "vectors")
    size = rows.count()
    if not size:
        return nearest(vectors, row_id, vector, k, block)
    lists = min(lists or max(1, round(size**0.5)), size)
    picked = rows.orderBy(F.xxhash64("id", F.lit(seed))).limit(sample).select("v").collect()
    centres = rows.sparkSession.sparkContext.broadcast(_centres(_unit(picked), lists, seed))
    asked = min(probes, lists)
    kind = dict(vectors.dtypes)[row_id]

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = np.argsort(-(_unit([{"v": v} for v in batch["v"]]) @ centres.value.T), axis=1, kind="stable")[:, :asked]
            yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "near": list(near.astype(np.int32))})

    filed = written(rows.mapInPandas(file, f"id {kind}, v {dict(vectors.dtypes)[vector]}, near array<int>"), "filed")
    base = filed.select("id", "v", F.element_at("near", 1).alias("list"))
    parts = base.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts"))
    cut = base.join(F.broadcast(parts), "list").withColumn("g", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    kept = written(_blocks(cut, ["list", "g"]), "blocks").withColumnRenamed("m", "right")
    asking = filed.select("id", "v", F.explode("near").alias("list"))
    shares = asking.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("shares"))
    queries = _blocks(asking.join(F.broadcast(shares), "list").withColumn("q", F.pmod(F.xxhash64("id"), "shares").cast("int")), ["list", "q"])
    work = queries.withColumnRenamed("m", "left").join(kept, "list")
    return _links(_best(work, kind, k, min(4096, 4 * lists)))


def _centres(unit: np.ndarray, lists: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of ``lists`` clusters of unit vectors, by rounds of nearest centre and mean."""
    rng = np.random.default_rng(seed)
    centres = unit[rng.choice(len(unit), size=min(lists, len(unit)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        filled = np.linalg.norm(sums, axis=1) > 0
        centres[filled] = sums[filled] / np.linalg.norm(sums[filled], axis=1, keepdims=True)
    return centres


def _blocks(rows: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., m)``: the rows of a block as one list; callers bound its length."""
    return rows.groupBy(*by).agg(F.collect_list(F.struct("id", "v")).alias("m"))


def _best(work: DataFrame, kind: str, k: int, tasks: int) -> DataFrame:
    """``(id, other, s)``: the best k of ``right`` for each row of ``left``, per pair of blocks."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left_rows, right_rows in zip(batch["left"], batch["right"]):
                ids = np.array([r["id"] for r in left_rows])
                others = np.array([r["id"] for r in right_rows])
                sims = np.round(_unit(left_rows) @ _unit(right_rows).T, 6)
                sims[ids[:, None] == others[None, :]] = -np.inf
                keep = np.lexsort((np.broadcast_to(others, sims.shape), -sims), axis=1)[:, :k]
                near = np.take_along_axis(sims, keep, 1)
                out = pd.DataFrame({"id": np.repeat(ids, keep.shape[1]), "other": others[keep].ravel(), "s": near.ravel()})
                yield out[np.isfinite(out["s"])]

    found = work.repartition(tasks).select("left", "right").mapInPandas(best, f"id {kind}, other {kind}, s double")
    order = Window.partitionBy("id").orderBy(F.desc("s"), "other")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def _links(top: DataFrame) -> DataFrame:
    return top.groupBy(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).agg(F.max("s").alias("similarity"))


def _unit(rows: list) -> np.ndarray:
    m = np.array([r["v"] for r in rows], dtype=np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def threshold_components(edges: DataFrame, threshold: float, nodes: DataFrame | None = None) -> DataFrame:
    return components(edges.where(F.col("similarity") >= threshold), "a", "b", nodes)


def _pieces(ids: list, edges: list[tuple], level: int, most: int, step: float, base: float, ceiling: float) -> list[tuple[list, float]]:
    """Pieces of one component and the threshold that made each, by raising it step by step."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    threshold = round(base + level * step, 4)
    kept = [e for e in edges if e[2] >= threshold]
    for a, b, _ in kept:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups: dict = {}
    for i in ids:
        groups.setdefault(root(i), []).append(i)
    if threshold > ceiling and any(len(g) > most for g in groups.values()):
        raise ValueError(f"a group of more than {most} holds together beyond similarity {ceiling}")
    out = []
    for head, members in groups.items():
        if len(members) <= most:
            out.append((members, threshold))
        else:
            inner = [e for e in kept if root(e[0]) == head]
            out += _pieces(members, inner, level + 1, most, step, base, ceiling)
    return out


def split_oversized(
    edges: DataFrame, labels: DataFrame, base: float, most: int = 8, step: float = 0.01, ceiling: float = 0.99, local_edges: int = LOCAL_EDGES
) -> DataFrame:
    """``(node, piece, threshold)``: components of at most ``most`` nodes.

    An oversized component falls apart by raising the threshold step by step.
    Components with up to ``local_edges`` edges do so within a task; larger
    ones are first cut in whole rounds over the cluster.
    """
    inner = edges.where(F.col("similarity") >= base).join(labels.withColumnsRenamed({"node": "a"}), "a")
    done: list[DataFrame] = []
    level = 0
    while True:
        sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
        links = inner.groupBy("component").agg(F.count(F.lit(1)).alias("e"))
        sized = written(sizes.join(links, "component", "left").fillna(0, ["e"]), "sizes")
        small = sized.where(F.col("n") <= most).select("component")
        done.append(labels.join(small, "component", "left_semi").select("node", F.col("component").alias("piece"), F.lit(round(base + level * step, 4)).alias("threshold")))
        local = sized.where((F.col("n") > most) & (F.col("e") <= local_edges)).select("component")
        done.append(_local_split(inner.join(local, "component", "left_semi"), labels, level, base, most, step, ceiling))
        large = sized.where((F.col("n") > most) & (F.col("e") > local_edges)).select("component")
        if large.isEmpty():
            break
        level += 1
        threshold = round(base + level * step, 4)
        if threshold > ceiling:
            raise ValueError(f"a group of more than {most} holds together beyond similarity {ceiling}")
        nodes = labels.join(large, "component", "left_semi").select("node")
        cut = inner.join(large, "component", "left_semi").where(F.col("similarity") >= threshold).select("a", "b", "similarity")
        labels = components(cut, "a", "b", nodes)
        inner = cut.join(labels.withColumnsRenamed({"node": "a"}), "a")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _local_split(inner: DataFrame, labels: DataFrame, level: int, base: float, most: int, step: float, ceiling: float) -> DataFrame:
    kind = dict(labels.dtypes)["node"]

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        edges = list(zip(pdf["a"], pdf["b"], pdf["similarity"]))
        ids = sorted(set(pdf["a"]) | set(pdf["b"]))
        pieces = _pieces(ids, edges, level + 1, most, step, base, ceiling)
        rows = [(node, min(members), threshold) for members, threshold in pieces for node in members]
        return pd.DataFrame(rows, columns=["node", "piece", "threshold"])

    return inner.groupBy("component").applyInPandas(split, f"node {kind}, piece {kind}, threshold double")


def group_similarity(groups: DataFrame, vectors: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``(node, similarity_within_group)``: mean cosine to the other members, 1 alone.

    The sum of a member's cosines is its product with the sum of the group's
    unit vectors, so no pairs are made.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = vectors.select(F.col(row_id).alias("node"), F.col(vector).cast("array<double>").alias("v")).withColumn("v", F.transform("v", lambda x: x / norm))
    held = groups.join(unit, "node")
    sums = (
        held.select("piece", F.posexplode("v").alias("i", "x")).groupBy("piece", "i").agg(F.sum("x").alias("x"))
        .groupBy("piece").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("t"))
    )
    sizes = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    dot = F.aggregate(F.zip_with("v", "t", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    mean = F.when(F.col("n") == 1, F.lit(1.0)).otherwise((dot - 1) / (F.col("n") - 1))
    return held.join(sums, "piece").join(sizes, "piece").select("node", "piece", F.round(mean, 4).alias("similarity_within_group"))


def ordered_groups(groups: DataFrame, weights: DataFrame) -> DataFrame:
    """Dense group numbers from 0, by total mentions falling, then first member."""
    joined = groups.join(weights, "node")
    totals = joined.groupBy("piece").agg(F.sum("weight").alias("total"), F.min("node").alias("first"), F.count(F.lit(1)).alias("size"))
    return numbered(totals, F.desc("total"), "first", name="group_id")


def closure(edges: DataFrame, most_depth: int = 20) -> DataFrame:
    """``(ancestor, descendant, depth)``: all chains of a DAG, the shortest depth each.

    Paths double each round (new pairs meet all known ones), so rounds grow
    with the logarithm of the depth; a circle is refused.
    """
    paths = written(edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant"), F.lit(1).alias("depth")).distinct(), "paths")
    fresh = paths
    for _ in range(most_depth):
        longer = (
            fresh.withColumnsRenamed({"descendant": "via", "depth": "d1"})
            .join(paths.withColumnsRenamed({"ancestor": "via", "depth": "d2"}), "via")
            .groupBy("ancestor", "descendant").agg(F.min(F.col("d1") + F.col("d2")).alias("depth"))
        )
        fresh = written(longer.join(paths.select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti"), "longer")
        if not fresh.where(F.col("ancestor") == F.col("descendant")).isEmpty():
            raise ValueError("the edges hold a circle")
        if fresh.isEmpty():
            return paths
        paths = written(paths.unionByName(fresh), "paths")
    raise ValueError(f"chains longer than 2^{most_depth}")


def dag_shape(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Parents, children, share of children with several parents, nodes below depth 2."""
    kids = edges.groupBy("child").agg(F.count(F.lit(1)).alias("p"))
    deep = paths.where(F.col("depth") > 2).agg(F.countDistinct("descendant").alias("deep_nodes"))
    return (
        edges.agg(F.countDistinct("parent").alias("parents"), F.count(F.lit(1)).alias("edges"))
        .crossJoin(kids.agg(F.count(F.lit(1)).alias("children"), F.round(F.avg((F.col("p") > 1).cast("double")), 4).alias("multi_parent_rate")))
        .crossJoin(deep)
    )


def family_counts(paths: DataFrame, facts: DataFrame) -> DataFrame:
    """Distinct postings that name a concept or any of its descendants."""
    parents = paths.select("ancestor").distinct()
    members = paths.select("ancestor", F.col("descendant").alias("concept_id")).unionByName(parents.select("ancestor", F.col("ancestor").alias("concept_id")))
    return facts.join(members, "concept_id").select("ancestor", "posting_id").distinct().groupBy("ancestor").agg(F.count(F.lit(1)).alias("postings"))


def scatter(edges: DataFrame, residual: DataFrame) -> DataFrame:
    """Children of a parent outside its largest group.

    ``residual(parent, child, token)``: what each child says beyond its parent.
    Children that share a token belong together, transitively.
    """
    child = F.concat(F.col("parent"), F.lit("\x1f c\x1f"), F.col("child"))
    token = F.concat(F.col("parent"), F.lit("\x1f t\x1f"), F.col("token"))
    links = residual.select(child.alias("x"), token.alias("y"))
    nodes = edges.select(child.alias("node"))
    labels = components(links, "x", "y", nodes)
    named = edges.select("parent", child.alias("node")).join(labels, "node")
    sizes = named.groupBy("parent", "component").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("parent").agg(
        F.sum("n").alias("n_children"), F.count(F.lit(1)).alias("n_groups"), F.max("n").alias("largest_group"),
        (F.sum("n") - F.max("n")).alias("outside"), F.round(1 - F.max("n") / F.sum("n"), 4).alias("scatter_rate"),
    )


def must_read(scatters: DataFrame, reach: DataFrame, k: int = 30) -> DataFrame:
    """Parents at the head of either ranking: by scatter or by reach."""
    by_scatter, by_reach = Window.orderBy(F.desc("outside"), "parent"), Window.orderBy(F.desc("postings"), "parent")
    s = scatters.orderBy(F.desc("outside"), "parent").limit(k).withColumn("scatter_rank", F.row_number().over(by_scatter)).select("parent", "scatter_rank")
    r = reach.orderBy(F.desc("postings"), "parent").limit(k).withColumn("closure_rank", F.row_number().over(by_reach)).select("parent", "closure_rank")
    return s.join(r, "parent", "full_outer")


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changed child edges per parent that both runs know."""
    shared = before.select("parent").distinct().join(after.select("parent").distinct(), "parent", "left_semi")
    old, new = (x.join(shared, "parent", "left_semi").select("parent", "child").distinct() for x in (before, after))
    both = old.withColumn("o", F.lit(1)).join(new.withColumn("n", F.lit(1)), ["parent", "child"], "full_outer")
    lost, won = F.count_if(F.col("n").isNull()), F.count_if(F.col("o").isNull())
    return both.groupBy("parent").agg(
        F.count("o").alias("before"), F.count("n").alias("after"), lost.alias("lost"), won.alias("won"),
        F.round((lost + won) / F.count(F.lit(1)), 4).alias("drift"),
    )
