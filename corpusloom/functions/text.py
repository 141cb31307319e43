"""String expressions: folding, tokens, ids.  All are JVM-side columns."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the Unicode property has it, for regular expressions of the JVM.
WS = r"(?U)\s"

# Punctuation folded to its plain form, one to one.
PLAIN_QUOTES = "‘’‚‛´`"
PLAIN_DOUBLE_QUOTES = "“”„‟"
PLAIN_DASHES = "‐‑‒–—―−"
PLAIN_SPACES = "\u00a0\u2009\u202f"
EVIDENCE_SPACES = "\u00a0\u2007\u202f"
BULLETS = "•·●▪"


def ws_trim(c: Column) -> Column:
    """Trims any white space (``trim`` alone knows the blank only)."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")


def ws_collapse(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WS}+", " ")


def join_key(c: Column) -> Column:
    """The key that mentions and bridge meet on: lower case, trimmed."""
    return ws_trim(F.lower(c))


def punctuation_fold(c: Column, bullets: bool = False) -> Column:
    """Typographic quotes, dashes and blanks to plain ones; zero-width space away."""
    blanks = EVIDENCE_SPACES + BULLETS if bullets else PLAIN_SPACES
    source = PLAIN_QUOTES + PLAIN_DOUBLE_QUOTES + PLAIN_DASHES + blanks
    target = "'" * len(PLAIN_QUOTES) + '"' * len(PLAIN_DOUBLE_QUOTES) + "-" * len(PLAIN_DASHES) + " " * len(blanks)
    # A letter beyond the target string is deleted.
    return F.replace(F.translate(c, source + "\u200b", target), F.lit("…"), F.lit("..."))


def strip_parenthesis(c: Column) -> Column:
    """Drops one trailing bracket of up to 60 characters."""
    return ws_trim(F.regexp_replace(c, rf"{WS}*\([^)]{{1,60}}\){WS}*$", ""))


def lookup(c: Column, table: Mapping[str, str]) -> Column:
    """The value of a fixed map where it has one, else the text itself."""
    if not table:
        return c
    cells = [F.lit(x) for pair in sorted(table.items()) for x in pair]
    return F.coalesce(F.create_map(*cells)[c], c)


def level1(c: Column, acronyms: Mapping[str, str]) -> Column:
    """One form per wording: punctuation, case, blanks, trailing bracket, acronym."""
    folded = ws_collapse(ws_trim(F.lower(punctuation_fold(c))))
    return lookup(strip_parenthesis(folded), acronyms)


def legacy_steps(c: Column, acronyms: Mapping[str, str]) -> Column:
    """The older form: no punctuation fold, no collapse."""
    return lookup(strip_parenthesis(join_key(c)), acronyms)


def map_version(logic: str, table: Mapping[str, str]) -> str:
    """Version of a normaliser: its logic's name and a digest of its map, in any order."""
    lines = "\n".join(f"{k}\t{v}" for k, v in sorted(table.items()))
    return f"{logic}+map.{hashlib.sha256(lines.encode()).hexdigest()[:12]}"


def evidence_flatten(c: Column) -> Column:
    """Text as evidence is compared: folded, bullets as blanks, one blank, lower case."""
    return F.lower(ws_trim(ws_collapse(punctuation_fold(c, bullets=True))))


def sanitised_id(c: Column, most: int = 64) -> Column:
    return F.substring(F.regexp_replace(c, "[^a-zA-Z0-9_-]", "_"), 1, most)


def concept_id(label: Column, space: str = "skill-concept:v1") -> Column:
    """Stable id of a label: ``cpt_`` and 16 digits of a hash in a name space."""
    key = F.lower(ws_collapse(ws_trim(label)))
    return F.concat(F.lit("cpt_"), F.substring(F.sha2(F.concat(F.lit(space + "\x1f"), key), 256), 1, 16))


def tokens(c: Column) -> Column:
    """Distinct words, sorted; slash and hyphen separate."""
    words = F.split(F.translate(c, "/-", "  "), rf"{WS}+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def word_list(values: list[str] | frozenset[str] | set[str]) -> Column:
    return F.array(*(F.lit(v) for v in sorted(values))) if values else F.array().cast("array<string>")


def content_tokens(c: Column, stopwords: list[str] | set[str]) -> Column:
    return F.array_except(tokens(c), word_list(stopwords))


def residual_tokens(parent: Column, child: Column, stopwords: list[str] | set[str]) -> Column:
    """What the child says beyond the parent and the stop words."""
    return F.array_except(F.array_except(tokens(child), tokens(parent)), word_list(stopwords))


def token_key(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def plural_forms(c: Column) -> Column:
    """Plurals of a form: ``+s``; ``+es`` after a hiss; ``y`` to ``ies`` after a consonant."""
    no = F.lit(None).cast("string")
    return F.filter(
        F.array(
            F.concat(c, F.lit("s")),
            F.when(c.rlike("(s|x|z|ch|sh)$"), F.concat(c, F.lit("es"))).otherwise(no),
            F.when(c.rlike("[^aeiou ]y$"), F.regexp_replace(c, "y$", "ies")).otherwise(no),
        ),
        lambda x: x.isNotNull(),
    )


def mentions_vendor(c: Column, words: list[str], phrases: list[str]) -> Column:
    """A vendor word among the tokens, or a vendor phrase within the text."""
    low = F.lower(c)
    hits = [F.arrays_overlap(tokens(low), word_list(words))] + [F.contains(low, F.lit(p)) for p in phrases]
    return reduce(lambda a, b: a | b, hits)


def pretty_slug(c: Column, special: Mapping[str, str]) -> Column:
    """``machine_learning_ai`` to ``Machine Learning AI``."""
    words = F.split(c, "_")
    return F.array_join(F.transform(words, lambda w: F.coalesce(_special(w, special), F.initcap(w))), " ")


def _special(word: Column, special: Mapping[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in sorted(special.items()):
        out = F.when(word == k, v).otherwise(out)
    return out


def unfenced(c: Column) -> Column:
    """A model's answer without the markdown fence around it."""
    return ws_trim(F.regexp_replace(ws_trim(c), r"^```[a-zA-Z]*\s*|\s*```$", ""))
