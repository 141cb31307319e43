"""Queries of the policy and of the checks of configuration files."""

from __future__ import annotations

import copy
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from corpusloom.queries.registry import query
from corpusloom.sources import policy, taxonomy

#: A policy without faults, in the shape of the file.
SOUND: dict[str, Any] = {
    "schema_version": 1, "policy_version": "1",
    "counting": {"closure": "distinct", "unit": "postings", "families_partition": False},
    "level1": {"version": "v1", "plural_folding": False},
    "level2": {"rule_a": {"enabled": True}, "rule_b": {"enabled": True, "caps_test": True, "caps_test_requires_token_match": True}, "order": ["rule_b", "rule_a"]},
    "candidates": {"min_mentions": 2, "fuzzy_cutoff": 88}, "level3": {"penetration_threshold": 0.05},
    "acronym_scan": {"sort_by": "gain", "min_gain_mentions": 10, "min_dominance_ratio": 5.0},
    "level4": {
        "must_be_standalone": True, "parent_stoplist": [], "content_stopwords": [], "stopword_only_edges": "related",
        "obvious_edges": {"enabled": True, "parent_max_tokens": 1, "child_extra_tokens": 1},
    },
    "adjudication": {"model": "m", "escalation_model": "n", "single_pass": True, "use_batch_api": True, "items_per_request": 25, "batch_api_min_items": 200},
    "review": {"must_read": "union", "sort_by": "scatter", "scatter_top_k": 30, "closure_top_k": 30},
    "publication": {"review_queue": "open", "provisional_when_queue_nonempty": True},
    "tests": {
        "bounds": {"rollup_edges": [10, 90], "level3_queue": [3, 6]},
        "change_detection": {
            "same_corpus_must_be_identical": True, "shared_string_tolerance_ratio": 1.2, "shared_string_tolerance_floor": 0.02, "max_single_parent_drift": 0.4,
            "new_occupation_requires_new_baseline": True, "new_occupation_requires_approval": True, "known_occupations": ["a"], "baseline_dir": "b",
        },
    },
}
# Faults, by key and the value that makes them; the last is one of two values together.
FAULTS: tuple[tuple[str, Any], ...] = (
    ("schema_version", 2), ("counting.unit", "words"), ("level1.plural_folding", True), ("level2.order", ["rule_a", "rule_b"]), ("acronym_scan.sort_by", "weight"),
    ("acronym_scan.min_gain_mentions", 0), ("acronym_scan.min_dominance_ratio", 0.9), ("level4.stopword_only_edges", "keep"), ("adjudication.items_per_request", 101),
    ("adjudication.single_pass", False), ("review.must_read", "scatter"), ("review.sort_by", "name"), ("review.scatter_top_k", 0), ("review.closure_top_k", 0),
    ("tests.bounds.rollup_edges", [9]), ("tests.bounds.level3_queue", [9, 1]), ("tests.change_detection.shared_string_tolerance_ratio", 10),
    ("tests.change_detection.shared_string_tolerance_floor", 1), ("tests.change_detection.max_single_parent_drift", 0), ("tests.change_detection.known_occupations", []),
    ("tests.change_detection.new_occupation_requires_new_baseline", False), ("tests.change_detection.new_occupation_requires_approval", False),
    ("tests.change_detection.same_corpus_must_be_identical", False), ("tests.change_detection.shared_string_tolerance_floor", 0.5),
)


def changed(content: dict[str, Any], dotted: str, value: Any = None, drop: bool = False) -> dict[str, Any]:
    out = copy.deepcopy(content)
    *path, last = dotted.split(".")
    here = out
    for part in path:
        here = here[part]
    if drop:
        del here[last]
    else:
        here[last] = value
    return out


_REQUIRED = [name for name, _, _ in policy.RULES]


def _listed(rows: list[tuple[str, str]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in rows) + ") t(name, fault)"


@query(_listed([(name, "missing") for name in _REQUIRED] + [(name, "value") for name in dict.fromkeys(name for name, _ in FAULTS)]))
def policy_faults(spark: SparkSession, d: str) -> DataFrame:
    """Every key left out, and every value that a policy must not have, is found."""
    found = [(name, "missing") for name in _REQUIRED if policy.problems(changed(SOUND, name, drop=True)) == [f"{name} is missing"]]
    found += [(name, "value") for name, value in FAULTS if any(x.startswith(name) for x in policy.problems(changed(SOUND, name, value)))]
    assert policy.problems(SOUND) == []
    return spark.createDataFrame(list(dict.fromkeys(found)), "name string, fault string")


FACETS: dict[str, Any] = {
    "version": "1", "frozen_at": "now",
    "facets": [{
        "id": "facet_x", "label": "X", "definition": "d", "applies_to": "concepts", "inputs": ["concept_label"], "exclusivity": "exclusive", "unmatched": "declared",
        "precedence": ["a", "b"], "fallback_value": "b",
        "values": [{"value": "a", "label": "A", "definition": "d", "match": {"stage_d_type_in": ["tool"]}}, {"value": "b", "label": "B", "definition": "d"}],
    }],
}
# Changes of a sound facet and the problem that each must bring up.
FACET_FAULTS: tuple[tuple[str, Any, str], ...] = (
    ("id", "x", "id form"), ("definition", " ", "no definition"), ("applies_to", "", "no applies_to"), ("inputs", [], "no inputs"), ("inputs", ["concept_category"], "unknown input"),
    ("exclusivity", "both", "unknown exclusivity"), ("unmatched", "other", "unknown unmatched"), ("assignment", "guess", "unknown assignment"), ("precedence", ["a"], "precedence has"),
    ("precedence", ["a", "b", "c"], "precedence names"), ("precedence", None, "precedence goes"), ("fallback_value", "z", "fallback z"), ("fallback_value", None, "a fallback value goes"),
    ("label", "TEMPLATE", "scaffold left"), ("label", "see cat_tools", "names category"), ("label", "as of 2026", "names year"), ("categories", "x", "key categories"), ("values", [], "no values"),
)
_VALUE_FAULTS: tuple[tuple[str, Any, str], ...] = (
    ("value", "A b", "value A b: slug form"), ("value", "b", "value b twice"), ("definition", "", "value a: no definition"), ("match", {}, "value a: no match rule"),
    ("match", {"other": ["x"]}, "value a: unknown match key"), ("match", {"stage_d_type_in": ["x"]}, "value a: unknown type"), ("match", {"stage_d_type_in": []}, "value a: no match rule with content"),
)


@query(_listed([(name, said) for name, _, said in FACET_FAULTS] + [("values." + name, said) for name, _, said in _VALUE_FAULTS] + [("id", "id twice"), ("frozen_at", "not frozen"), ("facets", "no facets")]))
def facet_file_faults(spark: SparkSession, d: str) -> DataFrame:
    """Every fault of a facet file is found."""
    found = []
    for name, value, said in FACET_FAULTS:
        bad = copy.deepcopy(FACETS)
        bad["facets"][0][name] = value
        found += [(name, said)] * any(x.startswith(said) for _, x in taxonomy.facet_problems(bad))
    for name, value, said in _VALUE_FAULTS:
        bad = copy.deepcopy(FACETS)
        bad["facets"][0]["values"][0][name] = value
        found += [("values." + name, said)] * any(x.startswith(said) for _, x in taxonomy.facet_problems(bad))
    twice = {**FACETS, "facets": FACETS["facets"] * 2}
    found += [("id", "id twice")] * any(x == "id twice" for _, x in taxonomy.facet_problems(twice))
    found += [("frozen_at", "not frozen")] * (taxonomy.facet_problems({**FACETS, "frozen_at": None}, frozen=True) == [("", "not frozen")])
    found += [("facets", "no facets")] * (taxonomy.facet_problems({**FACETS, "facets": []}) == [("", "no facets")])
    assert taxonomy.facet_problems(FACETS, frozen=True) == []
    return spark.createDataFrame(found, "name string, fault string")
