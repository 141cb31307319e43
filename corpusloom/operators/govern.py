"""Verdicts, votes, ledgers and checks around model-made rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TypeVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators.numbering import numbered

HELD_REASONS = ("insufficient_evidence", "ambiguous", "out_of_scope")
#: Who overrides whom: a person's verdict is never replaced by a model's.
AUTHORITY = {"human": 1, "model": 0}


# --- ledgers, resuming, chunks, samples -------------------------------------------------


def latest(df: DataFrame, key: list[str], *order: str | Column) -> DataFrame:
    """The last row of every key (S3, S8); ``order`` must leave no tie between different rows.

    One aggregate with map-side combine; a hot key doesn't gather in a task.
    """
    rest = [c for c in df.columns if c not in key]
    row = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(row.alias("_last")).select(*key, *(F.col("_last")[c].alias(c) for c in rest))


def pending(records: DataFrame, results: DataFrame, row_id: str, ok: Column) -> DataFrame:
    """Records without an ok result."""
    return records.join(results.where(ok).select(row_id).distinct(), row_id, "left_anti")


def missing_keys(wanted: DataFrame, cache: DataFrame, key: str, revision: str | None = None) -> DataFrame:
    """Distinct keys not yet in an insert-only cache (S7); ``revision``: of this model revision."""
    held = cache if revision is None else cache.where(F.col("revision") == revision)
    return wanted.select(key).distinct().join(held.select(key), key, "left_anti")


def embedded(forms: DataFrame, key: str, encode: Callable[[list[str]], np.ndarray], dimension: int) -> DataFrame:
    """``(key, vector)`` of distinct forms by a hook that turns a list of texts into rows of numbers.

    The hook runs in the workers, a batch at a time; another shape than
    ``(forms, dimension)`` is refused.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch[key].tolist()
            vectors = np.asarray(encode(texts), dtype=np.float32)
            if vectors.shape != (len(texts), dimension):
                raise ValueError(f"the encoder gave {vectors.shape}, not {(len(texts), dimension)}")
            yield pd.DataFrame({key: texts, "vector": list(vectors)})

    return forms.select(key).distinct().mapInPandas(run, f"{key} string, vector array<float>")


def vectors_for(wanted: DataFrame, cache: DataFrame, key: str, revision: str) -> DataFrame:
    """``wanted`` with the cached vector of a revision; a form without one is refused."""
    held = cache.where(F.col("revision") == revision).select(key, "vector")
    lost = wanted.select(key).join(held, key, "left_anti").limit(3).collect()
    if lost:
        raise KeyError(f"not in the cache: {[r[0] for r in lost]}")
    return wanted.join(held, key)


def chunked(df: DataFrame, size: int, *order: str | Column) -> DataFrame:
    """``df`` with ``chunk``: consecutive runs of ``size`` rows in the given order (L3)."""
    return numbered(df, *order, name="_row").withColumn("chunk", F.floor(F.col("_row") / size)).drop("_row")


def seeded_sample(df: DataFrame, by: list[str], row_id: list[str], n: int, seed: int) -> DataFrame:
    """``n`` rows of every stratum, the same ones on every run.

    Rows are drawn by a hash of seed and id; the rank filter prunes per task.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in row_id)))
    order = Window.partitionBy(*by).orderBy("_d", *row_id)
    return df.withColumn("_d", draw).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_d", "_r")


# --- extraction results -----------------------------------------------------------------


def skill_records(lines: DataFrame, raw: str, ok_only: bool = True) -> DataFrame:
    """``(id, status, skills)`` of JSON records in either shape.

    Skills are names, or objects with a ``skill`` field; a line that is no JSON
    is skipped; ``ok_only`` drops failed records.
    """
    new = F.from_json(raw, "id string, status string, extraction_error boolean, skills array<struct<skill:string>>")
    old = F.from_json(raw, "id string, status string, extraction_error boolean, skills array<string>")
    parsed = lines.withColumns({"n": new, "o": old}).where(F.col("n.id").isNotNull() | F.col("o.id").isNotNull())
    names = F.when(F.get_json_object(raw, "$.skills[0].skill").isNotNull(), F.transform("n.skills", lambda s: s["skill"])).otherwise(F.col("o.skills"))
    out = parsed.select(
        F.coalesce("o.id", "n.id").alias("id"), F.coalesce("o.status", "n.status", F.lit("ok")).alias("status"),
        F.coalesce("o.extraction_error", "n.extraction_error", F.lit(False)).alias("failed"), F.coalesce(names, F.array().cast("array<string>")).alias("skills"),
    )
    return out.where((F.col("status") == "ok") & ~F.col("failed")).drop("failed") if ok_only else out.drop("failed")


def status_of(answer: str, stop: str) -> Column:
    """Outcome of a model call: ok, truncated, no_tool_use or api_error (M1)."""
    return F.when(F.col(answer).isNull() & F.col(stop).isNull(), "api_error").when(F.col(stop) == "max_tokens", "truncated").when(F.col(answer).isNull(), "no_tool_use").otherwise("ok")


def kept_items(items: DataFrame, kinds: list[str]) -> DataFrame:
    """Items with a name and a known kind; ``degree`` is dropped."""
    named = items.where(F.col("skill").isNotNull() & (text.ws_trim(F.col("skill")) != "") & F.col("type").isin(kinds))
    return named.withColumn("requirement", F.coalesce("requirement", F.lit("unclear")))


def evidence_tiers(df: DataFrame, evidence: str, name: str, description: str) -> DataFrame:
    """``evidence_match``: the span stands in the text, else the name does, else null."""
    body = text.evidence_flatten(F.col(description))
    flat = {c: text.evidence_flatten(F.col(c)) for c in (evidence, name)}
    hit = {c: (flat[c] != "") & F.contains(body, flat[c]) for c in flat}
    return df.withColumn("evidence_match", F.when(hit[evidence], "span").when(hit[name], "name"))


def first_of_each(df: DataFrame, by: list[str], key: Column, position: str) -> DataFrame:
    """The first row per record and key."""
    order = Window.partitionBy(*by, "_k").orderBy(position)
    return df.withColumn("_k", key).withColumn("_r", F.row_number().over(order)).where(F.col("_r") == 1).drop("_k", "_r")


def unique_ids(df: DataFrame, raw: str) -> DataFrame:
    """``custom_id``: the cleaned id; further ids of one cleaned form get 59 characters and a number."""
    safe = text.sanitised_id(F.col(raw))
    order = Window.partitionBy("_safe").orderBy(raw)
    numbered = df.withColumn("_safe", safe).withColumn("_r", F.row_number().over(order) - 1)
    other = F.concat(F.substring("_safe", 1, 59), F.lit("_"), F.lpad(F.col("_r").cast("string"), 4, "0"))
    return numbered.withColumn("custom_id", F.when(F.col("_r") == 0, F.col("_safe")).otherwise(other)).drop("_safe", "_r")


# --- votes --------------------------------------------------------------------------------


def _variants(value: Column, sign: str) -> Column:
    """What the runs said, in their order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", value.alias("v")))), lambda x: x["v"]), sign)


def type_votes(runs: DataFrame, key: str, enough: int = 2, allowed: list[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Majority over runs ``(key, run, type, abstain, held_reason, confidence)``.

    Only runs with a type of ``allowed`` count (None: any type).  Fewer than
    ``enough`` of them leave the key unresolved; two abstentions hold it; else a
    type with two votes wins; else it is held as a tie.  Of equal counts the
    value of the earlier run leads.  ``keys``: what was asked for, so that keys
    without any answer come out as well.
    """
    asked = (runs if keys is None else keys).select(key).distinct()
    valid = runs.where(F.col("type").isNotNull() if allowed is None else F.col("type").isin(allowed))
    per_type = valid.groupBy(key, "type").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("first"))
    top = per_type.groupBy(key).agg(
        F.max_by("type", F.struct("n", -F.col("first"))).alias("top"), F.max("n").alias("votes"), F.count(F.lit(1)).alias("kinds")
    )
    held = valid.where(F.col("abstain") & F.col("held_reason").isin(*HELD_REASONS)).groupBy(key, "held_reason").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("first"))
    why = held.groupBy(key).agg(F.max_by("held_reason", F.struct("n", -F.col("first"))).alias("why"))
    sums = valid.groupBy(key).agg(
        F.count(F.lit(1)).alias("valid"), F.count_if("abstain").alias("abstained"),
        F.round(F.avg(F.coalesce("confidence", F.lit(0.0))), 3).alias("mean"), _variants(F.col("type"), "/").alias("said"),
    )
    few = F.coalesce("valid", F.lit(0)) < enough
    off = F.col("abstained") >= enough
    won = ~few & ~off & (F.col("votes") >= enough)
    agreed = ~few & (F.col("kinds") == 1)
    # The statuses of a typed concept.
    return asked.join(sums, key, "left").join(top, key, "left").join(why, key, "left").select(
        key, F.when(won, F.col("top")).otherwise("").alias("type"), F.when(few, 0.0).otherwise(F.col("mean")).alias("confidence"), (~won).alias("abstain"),
        F.when(few, "insufficient_evidence").when(won, "").when(off, F.coalesce("why", F.lit("type_tie"))).otherwise("type_tie").alias("held_reason"),
        agreed.alias("stable"), F.when(agreed, "").otherwise(F.coalesce("said", F.lit(""))).alias("run_variants"),
        F.when(few, "model_unresolved").when(off, "model_held").when(won, "model").otherwise("model_tie").alias("source"),
    )


def type_problems(rows: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """``(key, problem)`` of typed rows that contradict themselves (M5)."""
    typed = F.col("type") != ""
    problem = (
        F.when(typed & ~F.col("type").isin(allowed), "unknown type").when(typed & F.col("abstain"), "typed and held")
        .when(~typed & ~F.col("abstain"), "neither typed nor held").when(F.col("abstain") & (F.col("held_reason") == ""), "held without a reason")
    )
    return rows.select(key, problem.alias("problem")).where(F.col("problem").isNotNull())


def category_votes(runs: DataFrame, key: str, enough: int = 2, most: int = 2, allowed: list[str] | None = None) -> DataFrame:
    """Majority over category sets ``(key, run, categories, primary, unassigned)``.

    Categories with two votes stand, the most frequent known primary first, at
    most ``most``.  Without a primary the first category of the earliest
    assigned run is it; without a category of two votes it stands alone.
    """
    assigned = runs.where(~F.col("unassigned"))
    said = F.when(F.col("unassigned"), F.lit("UNASSIGNED")).otherwise(F.array_join(F.array_sort("categories"), "+"))
    sums = runs.groupBy(key).agg(F.count_if("unassigned").alias("off"), F.countDistinct(said).alias("kinds"), _variants(said, " | ").alias("said"))
    votes = assigned.select(key, F.explode(F.array_distinct("categories")).alias("_c")).groupBy(key, "_c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough)
    accepted = votes.groupBy(key).agg(F.array_sort(F.collect_list("_c")).alias("accepted"))
    known = F.col("primary").isNotNull() if allowed is None else F.col("primary").isin(allowed)
    primaries = assigned.where(known).groupBy(key, "primary").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("first"))
    primary = primaries.groupBy(key).agg(F.max_by("primary", F.struct("n", -F.col("first"))).alias("voted"))
    earliest = assigned.groupBy(key).agg(F.min_by("categories", "run").alias("e"))
    none = F.array().cast("array<string>")
    held = F.col("off") >= enough
    first = F.coalesce("voted", F.get("e", F.lit(0)))
    stand = F.coalesce("accepted", none)
    chosen = F.slice(F.when(first.isNull(), stand).otherwise(F.concat(F.array(first), F.array_remove(stand, first))), 1, most)
    return sums.join(accepted, key, "left").join(primary, key, "left").join(earliest, key, "left").select(
        key, F.array_join(F.when(held, none).otherwise(chosen), "|").alias("categories"),
        F.when(held, "").otherwise(F.coalesce(first, F.lit(""))).alias("primary_category"),
        F.when(held, 0).otherwise(F.size(chosen)).alias("n_categories"), held.alias("unassigned"), (F.col("kinds") == 1).alias("stable"),
        F.when(F.col("kinds") == 1, "").otherwise(F.col("said")).alias("run_variants"), F.lit("model").alias("source"),
    )


def seeded_order(requests: DataFrame, request: str, values: DataFrame, value: str) -> DataFrame:
    """``(request, value, place)``: the values in an order of their own for every request (M6).

    The order comes from a hash of both, so it is the same on every run.
    ``values`` is the fixed list of categories, a few dozen, and is broadcast.
    """
    both = requests.select(request).distinct().crossJoin(F.broadcast(values.select(value).distinct()))
    order = Window.partitionBy(request).orderBy(F.sha2(F.concat_ws("|", request, value), 256), value)
    return both.withColumn("place", F.row_number().over(order))


def confusion(a: DataFrame, b: DataFrame, key: list[str], verdict: str = "verdict") -> DataFrame:
    """Counts of verdict pairs of two judges; a key missing in one is ``MISSING``."""
    both = a.select(*key, F.col(verdict).alias("first")).join(b.select(*key, F.col(verdict).alias("second")), key, "full_outer")
    both = both.fillna("MISSING", ["first", "second"])
    return both.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))


# --- decisions ----------------------------------------------------------------------------


def pair_key(a: Column, b: Column) -> Column:
    """Key of an unordered pair."""
    return F.concat_ws(" || ", F.least(a, b), F.greatest(a, b))


def edge_key(parent: Column, child: Column) -> Column:
    return F.concat_ws(" || ", parent, child)


def applied(edges: DataFrame, decisions: DataFrame) -> DataFrame:
    """Edges with the verdict that decisions give them; ``kept`` where they stay."""
    d = decisions.select("parent", "child", "verdict", "by")
    return edges.join(d, ["parent", "child"], "left").withColumn("kept", F.coalesce(F.col("verdict") == "rollup", F.lit(True)))


def forced(edges: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decided roll-ups that the rules didn't make."""
    return decisions.where(F.col("verdict") == "rollup").join(edges, ["parent", "child"], "left_anti")


def stale(decisions: DataFrame, corpus: DataFrame) -> DataFrame:
    """Decisions naming a form that the corpus no longer holds."""
    parts = []
    known = corpus.select("form").distinct().withColumn("_known", F.lit(True))
    for end in ("parent", "child"):
        gone = decisions.join(known.withColumnRenamed("form", end), end, "left").where(F.col("_known").isNull())
        parts.append(gone.select("parent", "child", F.col(end).alias("missing")))
    return reduce(DataFrame.unionByName, parts)


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Decisions after new ones came in: newer wins, but no model over a person."""
    rank = F.when(F.col("by") == "human", AUTHORITY["human"]).otherwise(AUTHORITY["model"])
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return latest(both.withColumn("_rank", rank), key, "_rank", "_new", "verdict").drop("_rank", "_new")


def decision_problems(decisions: DataFrame) -> DataFrame:
    """Decisions that break the rules: self pair, unknown verdict or author, double key."""
    double = Window.partitionBy("parent", "child")
    problem = (
        F.when(F.col("parent") == F.col("child"), "self pair")
        .when(~F.col("verdict").isin("rollup", "related", "reject"), "unknown verdict")
        .when(~F.col("by").isin("human", "model"), "unknown author")
        .when(F.count(F.lit(1)).over(double) > 1, "decided twice")
    )
    return decisions.withColumn("problem", problem).where(F.col("problem").isNotNull())


def pair_decision_problems(pairs: DataFrame) -> DataFrame:
    """``(a, b, problem)`` of decisions ``(a, b, verdict, canonical, by)`` on unordered pairs.

    A merge must name which of the two forms stays.
    """
    double = Window.partitionBy(pair_key(F.col("a"), F.col("b")))
    merge = F.col("verdict") == "merge"
    problem = (
        F.when(F.col("a") == F.col("b"), "self pair")
        .when(~F.col("verdict").isin("merge", "keep_separate"), "unknown verdict")
        .when(~F.col("by").isin("human", "model"), "unknown author")
        .when(merge & (F.coalesce("canonical", F.lit("")) == ""), "no canonical")
        .when(merge & (F.col("canonical") != F.col("a")) & (F.col("canonical") != F.col("b")), "canonical not of the pair")
        .when(F.count(F.lit(1)).over(double) > 1, "decided twice")
    )
    return pairs.select("a", "b", problem.alias("problem")).where(F.col("problem").isNotNull())


def same_version(stored: str, current: str) -> None:
    """Refuses decisions made over forms of another level-1 version."""
    if stored != current:
        raise ValueError(f"decisions were made over level 1 {stored!r}, not {current!r}; check them anew")


def keyed(wanted: DataFrame, edges: DataFrame) -> DataFrame:
    """``wanted(parent, child)`` with what ``edges`` knows of them and ``found``, false where nothing."""
    known = edges.withColumn("_known", F.lit(True))
    return wanted.join(known, ["parent", "child"], "left").withColumn("found", F.coalesce("_known", F.lit(False))).drop("_known")


def disagreement_sample(edges: DataFrame, decided: DataFrame, first: DataFrame, second: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` undecided edges with the verdicts of two judges side by side, MISSING where one has none."""
    key = ["parent", "child"]
    open_edges = edges.select(*key).join(decided.select(*key), key, "left_anti").withColumn("_all", F.lit(1))
    picked = seeded_sample(open_edges, ["_all"], key, n, seed).drop("_all")
    a, b = (x.select(*key, F.col("verdict").alias(name)) for x, name in ((first, "first"), (second, "second")))
    return picked.join(a, key, "left").join(b, key, "left").fillna("MISSING", ["first", "second"])


def escalated(verdicts: DataFrame, again: DataFrame, items: DataFrame, key: list[str]) -> DataFrame:
    """Verdicts of all items after one second opinion on the uncertain ones (M8).

    ``again``: the second judge's verdicts; only those on uncertain items count.
    ``escalated`` tells them apart; an item without a verdict is ``MISSING``.
    """
    second = again.select(*key, F.col("verdict").alias("_second"))
    out = items.select(*key).join(verdicts.select(*key, "verdict"), key, "left").join(second, key, "left")
    up = (F.col("verdict") == "uncertain") & F.col("_second").isNotNull()
    return out.select(*key, F.when(up, F.col("_second")).otherwise(F.coalesce("verdict", F.lit("MISSING"))).alias("verdict"), F.coalesce(up, F.lit(False)).alias("escalated"))


def transport(items: int, batch_from: int, batches: bool = True) -> str:
    """Whether so many items go as a batch or one request at a time (M8)."""
    return "batch" if batches and items >= batch_from else "standard"


_T = TypeVar("_T")


def with_retries(call: Callable[[], _T], complete: Callable[[_T], bool], most: int = 3, wait: Callable[[int], float] = lambda n: 2.0**n) -> _T | None:
    """The first complete answer of a remote call, or the last one; None if all attempts raised (M5, M7).

    ``wait``: seconds before attempt n + 1.
    """
    answer = None
    for attempt in range(1, most + 1):
        try:
            answer = call()
            if complete(answer):
                return answer
        except (ValueError, KeyError, OSError):
            pass
        if attempt < most:
            time.sleep(wait(attempt))
    return answer


def counted_by(decisions: DataFrame, *by: str) -> DataFrame:
    return decisions.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


# --- merges and assignments -----------------------------------------------------------------


def partition_problems(members: DataFrame, inputs: DataFrame) -> DataFrame:
    """Where a partition of a group fails (M2, U3): ``(group_id, form, problem)``.

    ``members(group_id, label, form[, vendor_relation])``, ``inputs(group_id,
    form)``.  Missing, invented or doubled forms, an empty label, a concept
    without members (a row without a form), and a concept of several forms that
    says it joins a product and its technology.  For problems of a concept
    ``form`` holds its label.
    """
    named = members.where(F.col("form").isNotNull())
    used = named.groupBy("group_id", "form").agg(F.count(F.lit(1)).alias("n"))
    key = ["group_id", "form"]
    parts = [
        inputs.join(used, key, "left_anti").select(*key, F.lit("missing").alias("problem")),
        used.join(inputs, key, "left_anti").select(*key, F.lit("invented").alias("problem")),
        used.where(F.col("n") > 1).select(*key, F.lit("in two concepts").alias("problem")),
        named.where(F.coalesce(text.ws_trim(F.col("label")), F.lit("")) == "").select(*key, F.lit("empty label").alias("problem")),
        members.where(F.col("form").isNull()).select("group_id", F.col("label").alias("form"), F.lit("no members").alias("problem")),
    ]
    if "vendor_relation" in members.columns:
        mixed = named.where(F.col("vendor_relation") == "product_and_technology").groupBy("group_id", "label").agg(F.count(F.lit(1)).alias("n"))
        parts.append(mixed.where(F.col("n") > 1).select("group_id", F.col("label").alias("form"), F.lit("merged product and technology").alias("problem")))
    return reduce(DataFrame.unionByName, parts)


#: The order in which a failed group names its reason.
PARTITION_REASONS = ("empty label", "no members", "merged product and technology", "in two concepts", "missing", "invented")


def partition_ledger(members: DataFrame, inputs: DataFrame, most: int = 5) -> DataFrame:
    """``(group_id, status, reason, forms)`` for the ledger: ``ok``, or ``failed`` with its first reason.

    ``forms``: up to ``most`` forms or labels that show it, in order.
    """
    order = F.array_position(F.array(*map(F.lit, PARTITION_REASONS)), F.col("problem"))
    problems = partition_problems(members, inputs).distinct().withColumn("_o", order)
    rank = Window.partitionBy("group_id").orderBy("_o", "form")
    first = problems.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= most)
    low = problems.groupBy("group_id").agg(F.min_by("problem", "_o").alias("reason"), F.min("_o").alias("_low"))
    shown = first.join(low, "group_id").where(F.col("_o") == F.col("_low")).groupBy("group_id", "reason").agg(F.array_join(F.array_sort(F.collect_list("form")), "; ").alias("forms"))
    out = inputs.select("group_id").distinct().join(shown, "group_id", "left")
    return out.select("group_id", F.when(F.col("reason").isNull(), "ok").otherwise("failed").alias("status"), F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("forms", F.lit("")).alias("forms"))


def merge_report(concepts: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` concepts of most forms, with these (A22); of equal numbers the first label."""
    rank = Window.orderBy(F.desc("n_forms"), "label", "concept_id")
    top = concepts.where(F.col("n_forms") > 1).orderBy(F.desc("n_forms"), "label", "concept_id").limit(n)
    return top.select(F.row_number().over(rank).alias("rank"), "concept_id", "label", "n_forms", "forms")


def singleton_concepts(forms: DataFrame, members: DataFrame) -> DataFrame:
    """Forms of no group become concepts of their own (M3)."""
    alone = forms.join(members.select("form").distinct(), "form", "left_anti")
    return alone.select("form", F.col("form").alias("label"), text.concept_id(F.col("form")).alias("concept_id"), F.lit(1.0).alias("confidence"))


def assignment_problems(surface: DataFrame) -> DataFrame:
    """``(problem, n)`` over ``(form, concept_id, label)`` (M4)."""
    several = surface.where(F.col("concept_id").isNotNull()).groupBy("form").agg(F.countDistinct("concept_id").alias("n")).where(F.col("n") > 1)
    shared = surface.where(F.col("concept_id").isNotNull()).groupBy("label").agg(F.countDistinct("concept_id").alias("n")).where(F.col("n") > 1)
    unstable = surface.where(F.col("concept_id").isNotNull() & (F.col("concept_id") != text.concept_id(F.col("label"))))
    checks = {
        "unassigned": surface.where(F.col("concept_id").isNull()),
        "several concepts": several, "empty label": surface.where(F.coalesce("label", F.lit("")) == ""),
        "shared label": shared, "unstable id": unstable,
    }
    return reduce(DataFrame.unionByName, (df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("problem"), "n") for name, df in checks.items()))


def corrected(values: DataFrame, corrections: DataFrame) -> DataFrame:
    """Facet values after a person's corrections ``(facet_id, concept_id, value)``.

    A correction that meets no row, or several, is refused.
    """
    key = ["facet_id", "concept_id"]
    hits = corrections.join(values.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), key, "left").where(F.coalesce("n", F.lit(0)) != 1)
    wrong = hits.limit(3).collect()
    if wrong:
        raise ValueError(f"corrections must meet one row each: {wrong}")
    new = corrections.select(*key, F.col("value").alias("_value"))
    out = values.join(new, key, "left")
    changed = F.col("_value").isNotNull()
    return out.withColumns({
        "value": F.coalesce("_value", "value"), "by": F.when(changed, "human").otherwise(F.col("by")),
        "model": F.when(changed, "").otherwise(F.col("model")),
    }).drop("_value")


def resolved_labels(wanted: DataFrame, concepts: DataFrame) -> DataFrame:
    """Labels to ids; a label without a concept is refused."""
    out = wanted.join(concepts.select("label", "concept_id"), "label", "left")
    lost = out.where(F.col("concept_id").isNull()).limit(3).collect()
    if lost:
        raise ValueError(f"no concept for {[r['label'] for r in lost]}")
    return out


def facet_rewritten(existing: DataFrame, new: DataFrame, facet: str) -> DataFrame:
    """Rows of other facets as they are, rows of ``facet`` kept and new ones added once."""
    own = new.withColumn("facet_id", F.lit(facet)).join(existing.where(F.col("facet_id") == facet), ["facet_id", "concept_id"], "left_anti")
    return existing.unionByName(own.select(*existing.columns))


def facet_answers(answers: DataFrame, slugs: list[str]) -> DataFrame:
    """Valid values per concept: unknown slugs skipped, ``none`` only without a real value (M7)."""
    values = answers.select("concept_id", F.explode(F.array_distinct("values")).alias("value")).where(F.col("value").isin(*slugs, "none"))
    real = values.where(F.col("value") != "none").select("concept_id").distinct().withColumn("_real", F.lit(True))
    return values.join(real, "concept_id", "left").where((F.col("value") != "none") | F.col("_real").isNull()).drop("_real")


def facet_invalid(answers: DataFrame, slugs: list[str]) -> DataFrame:
    """``(concept_id, value)`` of answers that are no value of the facet: reported and left out (M7)."""
    return answers.select("concept_id", F.explode(F.array_distinct("values")).alias("value")).where(~F.col("value").isin(*slugs, "none"))


def facet_pending(concepts: DataFrame, values: DataFrame, facet: str) -> DataFrame:
    """Concepts that the facet has no row for, ``none`` included: what a resumed run asks for (M7)."""
    return concepts.select("concept_id").distinct().join(values.where(F.col("facet_id") == facet).select("concept_id"), "concept_id", "left_anti")


def facet_matches(forms: DataFrame, patterns: DataFrame, fallback: str | None = None) -> DataFrame:
    """Exclusive facet value per form: whole-string, caseless; the first in precedence wins."""
    p = patterns.select(F.lower("pattern").alias("k"), "value", "precedence")
    hit = forms.join(p, F.lower(F.col("form")) == F.col("k"), "left")
    chosen = hit.groupBy("form").agg(F.min_by("value", F.struct("precedence", "value")).alias("value"))
    return chosen.withColumn("value", F.coalesce("value", F.lit(fallback))) if fallback is not None else chosen


def with_overrides(rows: DataFrame, overrides: DataFrame, key: str, column: str) -> DataFrame:
    """A fixed value by id goes before what the model said (M5)."""
    o = overrides.select(key, F.col(column).alias("_o"))
    return rows.join(o, key, "left").withColumns({
        "source": F.when(F.col("_o").isNotNull(), "override").otherwise(F.lit("model")), column: F.coalesce("_o", column),
    }).drop("_o")


def merged_concepts(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Concepts over all groups (A21): label of most mentions, forms, mentions, source, and how many fell together.

    ``members(group_id, concept_id, label, form[, status])``; a row's group is
    ``ok`` or, where a form makes its own concept, ``singleton``.  ``collapsed``:
    concepts of single groups that this one stands for, less one.
    """
    status = F.col("status") if "status" in members.columns else F.lit("ok")
    weighed = members.withColumn("_status", status).join(counts, "form", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    labels = weighed.groupBy("concept_id", "label").agg(F.sum("count").alias("w"))
    pick = labels.groupBy("concept_id").agg(F.min_by("label", F.struct(-F.col("w"), F.length("label"), F.col("label"))).alias("label"))
    made = weighed.select("concept_id", "group_id", "label").distinct().groupBy("concept_id").agg((F.count(F.lit(1)) - 1).alias("collapsed"))
    sums = weighed.groupBy("concept_id").agg(
        F.countDistinct("form").alias("n_forms"), F.sum("count").alias("mentions"), F.countDistinct("group_id").alias("n_groups"),
        # The sources of a concept.
        F.when(F.max((F.col("_status") == "ok").cast("int")) == 1, "step3-merge").otherwise("step3-singleton").alias("source"),
        F.array_join(F.array_sort(F.collect_set("form")), " | ").alias("forms"),
    )
    return sums.join(pick, "concept_id").join(made, "concept_id")


def extraction_requests(ads: DataFrame, system: str, tool: str, model: str, most_tokens: int) -> DataFrame:
    """``(custom_id, body)``: one request per ad, as JSON with the tool's schema (M1)."""
    message = F.struct(F.lit("user").alias("role"), F.concat(F.lit("Title: "), F.coalesce("job_title", F.lit("")), F.lit("\n\n"), F.coalesce("description", F.lit(""))).alias("content"))
    body = F.struct(
        F.lit(model).alias("model"), F.lit(most_tokens).alias("max_tokens"), F.lit(system).alias("system"),
        F.array(message).alias("messages"), F.parse_json(F.lit(tool)).alias("tools"),
    )
    return unique_ids(ads, "id").select("custom_id", F.to_json(body).alias("body"))


# What a category may be, and the type words that its label must not hold.
CATEGORY_ROLES = ("load_bearing", "coverage")
TYPE_WORDS = ("tool", "library", "language", "method", "practice", "knowledge")


def taxonomy_problems(categories: DataFrame) -> DataFrame:
    """``(id, problem)`` of categories that break the rules of the taxonomy.

    ``categories(id, label, definition, role, excludes)``; ``excludes`` holds
    what a category is not, as ``(concept_shape, goes_to)``.
    """
    known = categories.select(F.col("id").alias("goes_to")).distinct()
    outs = categories.select("id", F.explode("excludes").alias("e")).select("id", "e.concept_shape", "e.goes_to")
    lost = outs.where(F.coalesce("goes_to", F.lit("")) != "").join(known, "goes_to", "left_anti")
    twice = categories.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)

    def empty(column: str) -> Column:
        return text.ws_trim(F.coalesce(column, F.lit(""))) == ""

    checks = {
        "id form": categories.where(~F.col("id").rlike(r"^cat_[a-z0-9]+(_[a-z0-9]+)*$")),
        "id twice": twice,
        "no definition": categories.where(empty("definition")),
        "label names a type": categories.where(F.lower("label").rlike(r"\b(" + "|".join(TYPE_WORDS) + r")\b")),
        "unknown role": categories.where(~F.col("role").isin(*CATEGORY_ROLES) | F.col("role").isNull()),
        "fewer than two excludes": categories.where(F.coalesce(F.size("excludes"), F.lit(0)) < 2),
        "exclude without shape": outs.where(empty("concept_shape")),
        "exclude without goes_to": outs.where(empty("goes_to")),
        "goes_to unknown": lost,
    }
    return reduce(DataFrame.unionByName, (df.select("id", F.lit(name).alias("problem")) for name, df in checks.items()))
