"""Surface forms to families: rules, token sets, plurals, roll-up edges."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators.components import components
from corpusloom.operators.joins import HOT, met_pairs

MOST_STEPS = 10


class RuleError(ValueError):
    """Rules that contradict each other, run in a circle, or don't come to rest."""


@dataclass(frozen=True)
class Rules:
    """Exact rules by kind, in order of precedence, and the suffix rule with its guards."""

    exact: dict[str, dict[str, str]]
    suffixes: frozenset[str] = frozenset()
    protected: frozenset[str] = frozenset()
    blocked_results: frozenset[str] = frozenset()
    blocked_endings: tuple[str, ...] = ()
    version: str = ""
    merged: dict[str, tuple[str, str]] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        for kind, table in self.exact.items():
            for source, target in table.items():
                known = self.merged.get(source)
                if known is None:
                    self.merged[source] = (target, kind)
                elif known[0] != target:
                    raise RuleError(f"{source!r} leads to {known[0]!r} ({known[1]}) and to {target!r} ({kind})")
        for start in self.merged:
            path, here = [start], start
            while here in self.merged:
                here = self.merged[here][0]
                if here in path:
                    raise RuleError("rules run in a circle: " + " -> ".join([*path, here]))
                path.append(here)

    def without_suffix(self, form: str) -> tuple[str, str] | None:
        words = form.split()
        if len(words) < 2 or words[-1] not in self.suffixes:
            return None
        rest = " ".join(words[:-1])
        if rest in self.blocked_results or rest.endswith(self.blocked_endings or ("\0",)):
            return None
        return rest, f"empty_suffix:{words[-1]}"

    def normalise(self, form: str) -> tuple[str, str, bool]:
        """``(normalised, method, converged)`` of one form."""
        if form in self.protected:
            return form, "protected", True
        trail: list[str] = []
        for _ in range(MOST_STEPS):
            step = None if form in self.protected else self.merged.get(form) or self.without_suffix(form)
            if step is None:
                return form, "+".join(trail) or "unchanged", True
            form = step[0]
            trail.append(step[1])
        return form, "+".join(trail), False


def normalised(df: DataFrame, form: str, rules: Rules) -> DataFrame:
    """``df`` with ``normalised_form``, ``method`` and ``config_version``.

    Distinct forms only go through the rule engine, as Arrow batches; a form
    that doesn't come to rest raises.
    """

    def run(forms: pd.Series) -> pd.DataFrame:
        results = [rules.normalise(f) if f is not None else (None, None, True) for f in forms]
        stuck = [f for f, r in zip(forms, results) if not r[2]]
        if stuck:
            raise RuleError(f"no rest after {MOST_STEPS} steps: {stuck[:3]}")
        return pd.DataFrame({"normalised_form": [r[0] for r in results], "method": [r[1] for r in results]})

    engine = F.pandas_udf(run, "normalised_form string, method string")
    distinct = df.select(form).distinct().withColumn("_r", engine(F.col(form)))
    table = distinct.select(form, "_r.normalised_form", "_r.method", F.lit(rules.version).alias("config_version"))
    return df.join(table, form, "left")


def suffix_stripped(c: Column, rules: Rules) -> Column:
    """One guarded suffix step as a column."""
    words = F.filter(F.split(c, rf"{text.WS}+"), lambda w: w != "")
    rest = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    guarded = rest.isin(sorted(rules.blocked_results)) if rules.blocked_results else F.lit(False)
    for ending in rules.blocked_endings:
        guarded = guarded | rest.endswith(ending)
    fires = (F.size(words) >= 2) & F.element_at(words, -1).isin(sorted(rules.suffixes)) & ~guarded
    return F.when(fires, rest).otherwise(c)


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Sources that lead to more than one target."""
    return rules.groupBy("source").agg(F.countDistinct("target").alias("targets")).where(F.col("targets") > 1)


def form_counts(df: DataFrame, form: str | Column, weight: str | Column | None = None) -> DataFrame:
    """``(form, count)``: mentions added up per form."""
    w = F.lit(1) if weight is None else weight if isinstance(weight, Column) else F.col(weight)
    f = form if isinstance(form, Column) else F.col(form)
    return df.where(f.isNotNull()).groupBy(f.alias("form")).agg(F.sum(w).cast("long").alias("count"))


def canonical(count: str = "count", form: str = "form") -> Column:
    """Aggregate: most mentions, then shortest, then alphabetically first."""
    return F.min_by(form, F.struct(-F.col(count), F.length(form), F.col(form)))


def token_set_families(counts: DataFrame) -> DataFrame:
    """``(form, canonical)`` of forms that share their token set."""
    keyed = counts.withColumn("key", text.token_key(F.col("form")))
    heads = keyed.groupBy("key").agg(canonical().alias("canonical"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return keyed.join(heads, "key").select("form", "canonical")


def plural_edges(counts: DataFrame, caps: DataFrame | None = None) -> DataFrame:
    """``(singular, plural)`` where both occur and the plural is no attested acronym."""
    made = counts.select(F.col("form").alias("singular"), F.explode(text.plural_forms(F.col("form"))).alias("plural"))
    edges = made.join(counts.select(F.col("form").alias("plural")), "plural", "left_semi")
    if caps is not None:
        edges = edges.join(caps.select(F.col("form").alias("plural")), "plural", "left_anti")
    return edges.select("singular", "plural").distinct()


def plural_families(counts: DataFrame, caps: DataFrame | None = None) -> DataFrame:
    """``(form, canonical)`` of chained plural pairs."""
    edges = plural_edges(counts, caps)
    groups = components(edges, "singular", "plural").withColumnRenamed("node", "form")
    counted = groups.join(counts, "form")
    heads = counted.groupBy("component").agg(canonical().alias("canonical"))
    return counted.join(heads, "component").select("form", "canonical")


def composed(first: DataFrame, second: DataFrame) -> DataFrame:
    """``(form, canonical)``: the first map, then the second on its targets."""
    after = second.select(F.col("form").alias("canonical"), F.col("canonical").alias("_next"))
    chained = first.join(after, "canonical", "left").select("form", F.coalesce("_next", "canonical").alias("canonical"))
    return chained.unionByName(second.join(first, "form", "left_anti").select("form", "canonical"))


def token_pairs(counts: DataFrame, stopwords: Iterable[str]) -> DataFrame:
    """Pairs of forms where the content tokens of one are all within the other's.

    The smaller side joins on one of its tokens only, its rarest, so a common
    token makes no pairs of its own.
    """
    stop = sorted(set(stopwords))
    forms = counts.select("form", text.content_tokens(F.col("form"), stop).alias("t")).where(F.size("t") > 0)
    single = forms.select("form", F.explode("t").alias("token"))
    rarity = single.groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    rarest = (
        single.join(rarity, "token").groupBy("form").agg(F.min_by("token", F.struct("held", "token")).alias("token"))
        .join(forms, "form").select(F.col("form").alias("parent"), F.col("t").alias("pt"), "token")
    )
    other = single.join(forms, "form").select(F.col("form").alias("child"), F.col("t").alias("ct"), "token")
    return rarest.join(other, "token").where(
        (F.col("parent") != F.col("child")) & (F.size(F.array_except("pt", "ct")) == 0) & (F.size("pt") < F.size("ct"))
    ).select("parent", "child")


def judged_edges(pairs: DataFrame, counts: DataFrame, stopwords: Iterable[str], parent_stop: Iterable[str], stopword_only: str = "related") -> DataFrame:
    """Candidate pairs with the reason that speaks against a roll-up edge, or null.

    ``pairs(a, b)`` in any direction; the side with fewer content tokens is the
    parent.  ``dropped``: words of the parent that the child lacks, where only
    a stop word made the pair.  ``stopword_only``: what becomes of edges that exist only because a
    stop word vanished (``related``, ``reject`` or ``rollup``).
    """
    stop, heads = sorted(set(stopwords)), sorted(set(parent_stop))
    t = pairs.withColumns({"ca": text.content_tokens(F.col("a"), stop), "cb": text.content_tokens(F.col("b"), stop)})
    a_in_b = (F.size(F.array_except("ca", "cb")) == 0) & (F.size("ca") < F.size("cb"))
    b_in_a = (F.size(F.array_except("cb", "ca")) == 0) & (F.size("cb") < F.size("ca"))
    t = t.withColumns({
        "parent": F.when(a_in_b, F.col("a")).when(b_in_a, F.col("b")),
        "child": F.when(a_in_b, F.col("b")).when(b_in_a, F.col("a")),
        "empty": (F.size("ca") == 0) | (F.size("cb") == 0),
    })
    p, c = text.tokens(F.col("parent")), text.tokens(F.col("child"))
    sibling = F.size(F.array_except(p, c)) > 0
    seen = counts.select(F.col("form").alias("parent"), F.col("count").alias("parent_mentions"))
    kids = counts.select(F.col("form").alias("child"), F.col("count").alias("child_mentions"))
    known = t.join(seen, "parent", "left").join(kids, "child", "left")
    reason = (
        F.when(F.col("empty"), "empty content tokens")
        .when(F.col("parent").isNull(), "not a strict subset")
        .when(F.size(F.array_except(p, text.word_list(heads))) == 0, "parent is all stoplist tokens")
    )
    if stopword_only in ("related", "reject"):
        reason = reason.when(sibling, f"stopword-only subset -> {'related' if stopword_only == 'related' else 'rejected'}")
    reason = reason.when(F.col("parent_mentions").isNull(), "parent never occurs standalone")
    dropped = F.when(reason.startswith("stopword-only"), F.array_sort(F.array_except(p, c)))
    return known.select("a", "b", "parent", "child", "parent_mentions", F.coalesce("child_mentions", F.lit(0)).alias("child_mentions"), reason.alias("reason"), dropped.alias("dropped"))


def rollup_edges(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).select("parent", "child", "parent_mentions", "child_mentions")


def obvious_edges(edges: DataFrame, parent_stop: Iterable[str]) -> DataFrame:
    """Edges that need no judgement: one-token parent, child is parent and one more token."""
    p, c = text.tokens(F.col("parent")), text.tokens(F.col("child"))
    return edges.where(
        (F.size(p) == 1) & (F.size(c) == 2) & (F.size(F.array_except(p, c)) == 0) & ~F.col("parent").isin(sorted(set(parent_stop)))
    )


def acronym_dominance(forms: DataFrame, min_gain: int = 10, ratio: float = 5.0) -> DataFrame:
    """Acronyms and the expansions that share their initials.

    ``settled`` where the top expansion has ``ratio`` times the runner-up's
    mentions, else ``contested``; below ``min_gain`` mentions ``below_limit``.
    """
    words = F.filter(F.split("form", " "), lambda w: w != "")
    spelled = forms.where(F.size(words) >= 2).select(
        F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "").alias("acronym"), F.col("form").alias("spelled_out"), F.col("count").alias("gain")
    )
    order = Window.partitionBy("acronym").orderBy(F.desc("gain"), "spelled_out")
    ranked = spelled.withColumns({"r": F.row_number().over(order), "next": F.lead("gain").over(order)}).where(F.col("r") == 1)
    ratio_of = F.col("gain") / F.col("next")
    verdict = F.when(F.col("gain") < min_gain, "below_limit").when(F.col("next").isNotNull() & (ratio_of < ratio), "contested").otherwise("settled")
    return ranked.select("acronym", "spelled_out", "gain", F.coalesce("next", F.lit(0)).alias("runner_up"), verdict.alias("verdict"))


def first_word_pairs(counts: DataFrame, cutoff: int = 88, min_count: int = 2, most_length: int = 60, hot: int = HOT) -> DataFrame:
    """``(a, b, score)``: forms with the same first word and a high token-set ratio.

    The ratio is the best of three: of the shared words with all words of
    either form, which follows from lengths, and of the two rests, which their
    lengths bound from above.  Only pairs whose rests could decide reach Python.
    A first word of more than ``hot`` forms is cut into salts on one side and
    repeated on the other.
    """
    kept = counts.where((F.col("count") >= min_count) & (F.length("form") <= most_length)).select(
        "form", F.split("form", " ")[0].alias("first"), F.array_sort(F.array_distinct(F.filter(F.split("form", r"\s+"), lambda w: w != ""))).alias("t")
    ).where(F.size("t") > 0)
    pairs = met_pairs(kept, "first", "form", "t", hot=hot).withColumnsRenamed({"a_t": "ta", "b_t": "tb"})

    def letters(words: Column) -> Column:
        return F.length(F.array_join(words, " "))

    both, left, right = F.array_intersect("ta", "tb"), F.array_except("ta", "tb"), F.array_except("tb", "ta")
    base = letters(both)
    gap = F.when(base > 0, 1).otherwise(0)
    sized = pairs.withColumns({
        "base": base, "inside": (F.size(both) > 0) & ((F.size(left) == 0) | (F.size(right) == 0)), "one": base + gap + letters(left), "two": base + gap + letters(right),
    })
    known = F.when(F.col("base") > 0, F.greatest(*(200.0 * F.col("base") / (F.col("base") + F.col(x)) for x in ("one", "two")))).otherwise(0.0)
    bound = 200.0 * F.least("one", "two") / (F.col("one") + F.col("two"))
    judged = sized.withColumns({"known": F.when(F.col("inside"), 100.0).otherwise(known), "open": ~F.col("inside") & (bound >= cutoff)})
    ratio = F.pandas_udf(_token_set_ratios, "double")
    scored = judged.where("open").select("a", "b", ratio("a", "b").alias("score"))
    return scored.unionByName(judged.where("NOT open").select("a", "b", F.col("known").alias("score"))).where(F.col("score") >= cutoff)


def _token_set_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)], index=a.index)


def _longest_common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    row = (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit) | (row - hit)
    return len(a) - bin(row & ((1 << len(a)) - 1)).count("1")


def _indel(a: str, b: str) -> float:
    size = len(a) + len(b)
    return 100.0 if not size else 200.0 * _longest_common(a, b) / size


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of two token sets, 0 to 100: shared words weigh fully, the rest by letters."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    base = " ".join(both)
    one, two = (" ".join(filter(None, (base, " ".join(part)))) for part in (left, right))
    best = _indel(one, two)
    if base:
        best = max(best, _indel(base, one), _indel(base, two))
    return best
