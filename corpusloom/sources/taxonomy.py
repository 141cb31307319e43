"""Checks of a facet file before it is used."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from typing import Any

# What the file may say.
FACET_ID = re.compile(r"facet_[a-z0-9]+(_[a-z0-9]+)*")
SLUG = re.compile(r"[a-z0-9]+(_[a-z0-9]+)*")
CATEGORY_ID = re.compile(r"\bcat_[a-z0-9]+(?:_[a-z0-9]+)*\b")
YEAR = re.compile(r"\b(?:19|20)\d{2}\b")
TYPES = ("language", "library", "tool", "method", "knowledge_area", "practice", "transversal_skill", "compliance", "industry_context")
INPUTS = ("concept_label", "surface_form", "stage_d_type")
MATCH_KEYS = ("concept_label_matches", "surface_form_matches", "stage_d_type_in")
CHOICES = {"exclusivity": ("exclusive", "multi_valued"), "unmatched": ("absent", "declared"), "assignment": ("pattern", "classifier")}
SCAFFOLD = ("TEMPLATE", "REPLACE_WITH")
CATEGORY_KEYS = (
    "category", "category_id", "categories", "concept_category", "concept_category_csv", "primary_category", "secondary_category", "goes_to",
)

Problem = tuple[str, str]
Facet = Mapping[str, Any]


def _filled(value: Any) -> bool:
    return isinstance(value, str) and bool(value.strip())


def _leaves(node: Any) -> Iterator[tuple[bool, str]]:
    """All keys and texts below a node, with whether it is a key."""
    if isinstance(node, Mapping):
        for key, below in node.items():
            yield True, str(key)
            yield from _leaves(below)
    elif isinstance(node, list):
        for below in node:
            yield from _leaves(below)
    elif isinstance(node, str):
        yield False, node


def _slugs(facet: Facet) -> list[str]:
    values = facet.get("values")
    return [v["value"] for v in values if isinstance(v, Mapping) and v.get("value")] if isinstance(values, list) else []


def _texts(facet: Facet) -> Iterator[str]:
    for name in ("definition", "applies_to"):
        if not _filled(facet.get(name)):
            yield f"no {name}"
    if "label" not in facet:
        yield "no label"


def _inputs(facet: Facet) -> Iterator[str]:
    given = facet.get("inputs")
    if not isinstance(given, list) or not given:
        yield "no inputs"
    else:
        yield from (f"unknown input {x}" for x in given if x not in INPUTS)


def _choices(facet: Facet) -> Iterator[str]:
    for name, allowed in CHOICES.items():
        if name in facet and facet[name] not in allowed:
            yield f"unknown {name} {facet[name]}"
        elif name not in facet and name != "assignment":
            yield f"no {name}"


def _precedence(facet: Facet) -> Iterator[str]:
    given = facet.get("precedence")
    if (given is not None) != (facet.get("exclusivity") == "exclusive"):
        yield "precedence goes with an exclusive facet only, and with each"
    elif given is not None:
        counts = Counter(given) if isinstance(given, list) else Counter()
        known = _slugs(facet)
        yield from (f"precedence names {x}, which is no value" for x in counts if x not in known)
        yield from (f"precedence has {x} {counts[x]} times" for x in dict.fromkeys(known) if counts[x] != 1)


def _fallback(facet: Facet) -> Iterator[str]:
    given = facet.get("fallback_value")
    if (given is not None) != (facet.get("unmatched") == "declared"):
        yield "a fallback value goes with declared unmatched concepts only, and with each"
    elif given is not None and given not in _slugs(facet):
        yield f"fallback {given} is no value"


def _foreign(facet: Facet) -> Iterator[str]:
    """What must stand nowhere in a facet: scaffold, categories, years."""
    for is_key, text in _leaves(facet):
        if not is_key and any(x in text for x in SCAFFOLD):
            yield f"scaffold left in {text!r}"
        if is_key and text in CATEGORY_KEYS:
            yield f"key {text} speaks of categories"
        yield from (f"names category {x}" for x in CATEGORY_ID.findall(text))
        yield from (f"names year {x}" for x in YEAR.findall(text))


def _match(match: Any) -> Iterator[str]:
    if not isinstance(match, Mapping) or not match:
        yield "no match rule"
        return
    for key, listed in match.items():
        if key not in MATCH_KEYS:
            yield f"unknown match key {key}"
        elif not isinstance(listed, list):
            yield f"match {key} is no list"
        elif key == "stage_d_type_in":
            yield from (f"unknown type {x}" for x in listed if x not in TYPES)
    if not any(isinstance(x, list) and x for k, x in match.items() if k in MATCH_KEYS):
        yield "no match rule with content"


def _values(facet: Facet) -> Iterator[str]:
    values = facet.get("values")
    if not isinstance(values, list) or not values:
        yield "no values"
        return
    for n, value in enumerate(values):
        if not isinstance(value, Mapping):
            yield f"value {n} is no mapping"
            continue
        slug = value.get("value") or ""
        name = f"value {slug or n}"
        # Concepts of these values come from elsewhere, so they need no rule.
        free = facet.get("assignment") == "classifier" or slug and slug == facet.get("fallback_value")
        if not slug:
            yield f"{name}: no slug"
        elif not SLUG.fullmatch(slug):
            yield f"{name}: slug form"
        if "label" not in value:
            yield f"{name}: no label"
        if not _filled(value.get("definition")):
            yield f"{name}: no definition"
        if "match" in value:
            yield from (f"{name}: {x}" for x in _match(value["match"]))
        elif not free:
            yield f"{name}: no match rule"
    yield from (f"value {x} twice" for x, n in Counter(_slugs(facet)).items() if n > 1)


CHECKS: tuple[Callable[[Facet], Iterator[str]], ...] = (_texts, _inputs, _choices, _precedence, _fallback, _foreign, _values)


def facet_problems(document: Mapping[str, Any], frozen: bool = False) -> list[Problem]:
    """``(facet, problem)`` of a facet file; ``frozen``: its freezing date must be set."""
    out: list[Problem] = [("", f"no {name}") for name in ("version", "frozen_at") if name not in document]
    if frozen and not document.get("frozen_at"):
        out.append(("", "not frozen"))
    facets = document.get("facets")
    if not isinstance(facets, list) or not facets:
        return [*out, ("", "no facets")]
    ids = Counter(f.get("id") for f in facets if isinstance(f, Mapping))
    for n, facet in enumerate(facets):
        if not isinstance(facet, Mapping):
            out.append((str(n), "no mapping"))
            continue
        name = facet.get("id") or ""
        if not FACET_ID.fullmatch(name):
            out.append((name or str(n), "id form"))
        if ids[name] > 1:
            out.append((name, "id twice"))
        out += [(name or str(n), problem) for check in CHECKS for problem in check(facet)]
    return out
