"""Template residue, filler and error-page text (problem 8).

Labelled exemplars (``exemplars``) are held in an inverted index over their
features: words, neighbouring word pairs, template slots by their syntax, the
words of a slot's name, the field label before it, and whether the passage
speaks about templates and code.  Each text is cut into passage windows (its
lines and sentences); a window retrieves the exemplars that share one of their
weightiest features, and an exemplar counts when its TF-IDF containment in the
window is high.  No exemplar has a single feature.  Those made of two parts
("the page" ... "has been removed") must stand in this order and cover a good
part of the window.  Exemplars of the label ``mention`` (texts that only speak
of such things) go first and take the features they explain out of the window.
A line that only repeats one word or short phrase is filler whatever its wording.

One pass over the texts counts the documents of every exemplar feature and
keeps the windows that could hold an exemplar: every exemplar has a pair of
words, a slot or an empty value that no hit can do without, as a pair weighs no
less than its words.  Weights and containment are then worked out on these
windows alone.  Only the counts of exemplar features, a set of fixed size, are
gathered.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.exemplars import (
    EMPTY_VALUES, FIELD_LABELS, FIELD_WORDS, FILLER_WORDS, MENTIONS, SLOT_NAMES, SOFT_WORDS, TALK, TALK_OF_ERRORS, TALK_OF_SLOTS, lines,
    residue_exemplars, two_part_exemplars,
)
from corpusloom.llm.surface import IGNORABLE_RANGES
from corpusloom.runtime import spread, written

#: Containment from which an exemplar counts as found.
CONTAINMENT = 0.8
#: Containment from which a mention explains what it shares with a window.
EXPLAINED = 0.65
#: Share of a window's words that an exemplar made by rule must have.
COVER = {"error page": 0.35, "scripts required": 0.2, "filler": 0.5}
#: Share of filler words (by weight) that makes a passage filler, and the least number of them.
FILLER_SHARE, FILLER_LEAST = 0.75, 3
#: Copies of one phrase, and most words of it, that make a line of nothing else filler.
REPEATS, REPEATED_WORDS = 3, 5
#: Tokens of a window; longer passages are cut, overlapping by a third, which no exemplar may exceed.
WINDOW = 60

# Template slots: opening and closing sign, and whether the syntax alone tells.
_SLOTS = (
    ("{{", "}}", True), ("${", "}", True), ("#{", "}", True), ("<%", "%>", True), ("{%", "%}", True),
    ("%%", "%%", True), ("@@", "@@", True), ("__", "__", True), ("<<", ">>", True), ("[[", "]]", True),
    ("[", "]", False), ("{", "}", False), ("<", ">", False),
)
#: Syntax that no prose uses otherwise; names in the others must tell that a field was meant.
_UNMISTAKABLE = ("{{", "${", "#{", "<%", "{%", "@@", "[[")
_HTML = "a b i u s p em hr br ul ol li dl dt dd td th tr h1 h2 h3 h4 h5 h6 div pre sub sup nav span code html body head main form font table tbody thead strong small title meta link img footer header section article noscript script style blockquote".split()
_UNSEEN = re.compile("[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in IGNORABLE_RANGES) + "]+")
_TAGS = re.compile(r"</?(?:" + "|".join(_HTML) + r")(?:\s[^<>]*)?/?>|<\|[a-z]+\|>", re.IGNORECASE)
_BREAK = re.compile(r"[\n\r|;]+|(?<=[.!?…])\s+|\s//\s")


# A slot is found on its whole line and then stands in it as one sign.
_SIGN = "\ue000"
_OPENING = re.compile("|".join(re.escape(opening) for opening, _, _ in _SLOTS))
_TOKEN = re.compile(rf"(?P<slot>{_SIGN})|(?P<format>%[sd]\b|%[A-Z][A-Z_]+%)|(?P<number>\d+)|(?P<word>[^\W\d_]+)")
# The breaks between passages as tokens: line ends and signs, a blank after a sentence end, a double stroke.
_WITH_BREAKS = re.compile(r"\d+|[^\W\d_]+|[\n\r|;]|(?<=[.!?…])\s|(?<=\s)//(?=\s)")
_BREAKS = frozenset("\n\r|; \t\v\f//\x85\u2028\u2029") | {"//"}
_PLAIN_TOKEN = re.compile(r"\d+|[^\W\d_]+")
#: Soft brackets around more than this, or around a passage end, are read as text too.
_SHORT = 60
_INNER = re.compile(r"[A-ZÀ-Þ]?[^\W\d_A-Z]+|[A-Z]+(?![a-z])|\d+")
_CROSSED = re.compile(r"x{3,}")
_LINE = re.compile(r"[\n\r]+")
_NUMBERED = re.compile(r"[\W_]*\d+[.):]\s")
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"\d")


def _slot_features(slot: str) -> list[str]:
    """The syntax of a slot and the words of its name; an empty inside is no slot."""
    for opening, closing, _ in _SLOTS:
        if slot.startswith(opening) and slot.endswith(closing):
            inner = slot[len(opening) : len(slot) - len(closing)].strip(" =-")
            if opening in ("<", "[", "{") and inner[:1] in "/!?" or slot.startswith("<|"):
                return []
            words = [w.casefold() for w in _INNER.findall(inner)]
            names = [w for w in words if not w.isdigit()] or (["0"] if inner.isdigit() else [])
            return [f"slot {opening}", *(f"in {w}" for w in names)] if names else []
    return []


def _shown(text: str) -> str:
    """The text without unseen characters and markup."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", _UNSEEN.sub("", text))
    return _TAGS.sub("\n", text) if "<" in text else text


def repeats(line: str) -> bool:
    """Whether a line, less its list number, only repeats one phrase of 3 letters or more; no other digits."""
    numbered = _NUMBERED.match(line)
    words = _LETTERS.findall(line[numbered.end() :] if numbered else line)
    if len(words) < REPEATS or _DIGIT.search(line, numbered.end() if numbered else 0):
        return False
    words = [w.casefold() for w in words]
    for n in range(1, min(REPEATED_WORDS, len(words) // REPEATS) + 1):
        if words[n:] == words[:-n]:
            return sum(map(len, words[:n])) >= 3
    return False


def windows(text: str, size: int = WINDOW) -> Iterator[list[str]]:
    """Token lists of the passages of a text; a slot is several tokens that start with a mark."""
    yield from _windows(_shown(text), size)


def _cut_slots(line: str, soft_text: bool) -> tuple[str, list[str], bool]:
    """The line with a sign for each slot, the slots, and whether one in soft brackets may be text.

    A slot ends at its first closing sign, on the same line.  ``soft_text``:
    those that may be text stay in the line.
    """
    parts: list[str] = []
    slots: list[str] = []
    may_be_text = False
    closed: dict[str, int] = {}
    at = done = 0
    while m := _OPENING.search(line, at):
        start = m.start()
        at = start + 1
        for opening, closing, hard in _SLOTS:
            if not line.startswith(opening, start):
                continue
            inside = start + len(opening)
            # Each closing sign is looked for once up to its next place, so a line is read in linear time.
            if -1 < closed.get(closing, 0) < inside:
                closed[closing] = line.find(closing, inside)
            end = closed.get(closing, -1)
            if end <= inside:
                continue
            if not hard and (end - inside > _SHORT or _BREAK.search(line, inside, end)):
                may_be_text = True
                if soft_text:
                    continue
            at = end + len(closing)
            parts += [line[done:start], _SIGN]
            slots.append(line[start:at])
            done = at
            break
    return "".join([*parts, line[done:]]), slots, may_be_text


def _windows(text: str, size: int = WINDOW) -> Iterator[list[str]]:
    if _SIGN in text:
        text = text.replace(_SIGN, " ")
    if "%" not in text and not _OPENING.search(text):
        for passages in _plain_lines(text):
            yield from (w for tokens in passages if tokens for w in _cut(tokens, size))
        return
    for line in _LINE.split(text):
        if not _OPENING.search(line):
            yield from _line_windows(line, [], size)
            continue
        cut, slots, may_be_text = _cut_slots(line, False)
        yield from _line_windows(cut, slots, size)
        if may_be_text:
            cut, slots, _ = _cut_slots(line, True)
            yield from _line_windows(cut, slots, size)


def _plain_lines(text: str) -> Iterator[list[list[str]]]:
    """Passages of each line of a text without slots: its words and breaks in one pass."""
    tokens = _WITH_BREAKS.findall(text.casefold())
    if "xxx" in text or "XXX" in text:
        tokens = ["xxx" if t[0] == "x" and _CROSSED.fullmatch(t) else t for t in tokens]
    line: list[list[str]] = []
    start = 0
    for i, t in enumerate(tokens):
        if t in _BREAKS:
            line.append(_numbers(tokens[start:i]))
            start = i + 1
            if t == "\n" or t == "\r":
                yield line
                line = []
    yield [*line, _numbers(tokens[start:])]


def _numbers(tokens: list[str]) -> list[str]:
    return tokens if "".join(tokens).isalpha() else ["0" if t[0].isdigit() else t for t in tokens]


def _cut(tokens: list[str], size: int) -> Iterator[list[str]]:
    if len(tokens) <= size:
        yield tokens
    else:
        for start in range(0, len(tokens) - size // 3, size - size // 3):
            yield tokens[start : start + size]


def _line_windows(line: str, slots: list[str], size: int) -> Iterator[list[str]]:
    slot = iter(slots)
    for passage in _BREAK.split(line):
        if slots or "%" in passage:
            tokens: list[str] = []
            for m in _TOKEN.finditer(passage):
                kind = m.lastgroup
                if kind == "word":
                    tokens.append(m[0].casefold())
                elif kind == "number":
                    tokens.append("0")
                elif kind == "format":
                    tokens.append("slot %")
                else:
                    tokens.extend(_slot_features(next(slot)))
        else:
            tokens = ["0" if t[0].isdigit() else t for t in _PLAIN_TOKEN.findall(passage.casefold())]
        if "xxx" in passage or "XXX" in passage:
            tokens = ["xxx" if t[0] == "x" and _CROSSED.fullmatch(t) else t for t in tokens]
        if tokens:
            yield from _cut(tokens, size)


_MARKS = ("slot ", "in ")
_LABELS = frozenset(FIELD_LABELS.split())
_TALK_OF_SLOTS = frozenset(TALK_OF_SLOTS.split())
_TALK = _TALK_OF_SLOTS | frozenset(TALK.split())
_TALK_OF_ERRORS = frozenset(TALK_OF_ERRORS.split())
_GAPS = frozenset(EMPTY_VALUES)
_SOFT = frozenset(SOFT_WORDS.split())
_SYNTAXES = frozenset(f"slot {opening}" for opening in [*(x[0] for x in _SLOTS), "%"])
_STATES = frozenset(("after label", "no talk of slots", "no talk of errors", "prose"))


class Vocabulary:
    """Exemplar features: words and slot tokens, pairs of neighbouring words, and states of a window."""

    def __init__(self, held: Iterable[str]):
        self.all = frozenset(held)
        self.tokens = frozenset(f for f in self.all if " " not in f or f.startswith(_MARKS))
        self.next: dict[str, set[str]] = {}
        for f in self.all - self.tokens - _STATES:
            first, second = f.split(" ")
            self.next.setdefault(first, set()).add(second)


def features(tokens: list[str], vocabulary: Vocabulary | None = None) -> set[str]:
    """Words, slot tokens, pairs of neighbouring words, and what the window says of gaps and talk.

    ``vocabulary``: only its features count.
    """
    if vocabulary is None:
        out = set(tokens)
        out.update(f"{a} {b}" for a, b in zip(tokens, tokens[1:]) if not a.startswith(_MARKS) and not b.startswith(_MARKS))
    else:
        out = set(vocabulary.tokens.intersection(tokens))
        follow = vocabulary.next
        out.update([f"{a} {b}" for a, b in zip(tokens, tokens[1:]) if a in follow and b in follow[a]])
    slots = () if _SYNTAXES.isdisjoint(out) else [i for i, t in enumerate(tokens) if t.startswith("slot ")]
    if slots or not _GAPS.isdisjoint(out):
        if any(i and tokens[i - 1] in _LABELS for i in slots):
            out.add("after label")
        if _TALK_OF_SLOTS.isdisjoint(tokens):
            out.add("no talk of slots")
        if _TALK.isdisjoint(tokens):
            out.add("prose")
    if _TALK_OF_ERRORS.isdisjoint(tokens):
        out.add("no talk of errors")
    return out


class Exemplar(NamedTuple):
    label: str
    features: tuple[str, ...]
    least: float = CONTAINMENT
    cover: float = 0.0
    parts: tuple[tuple[str, ...], ...] = ()


def _words(text: str) -> tuple[str, ...]:
    return tuple(t for window in windows(text) for t in window)


def _said(tokens: tuple[str, ...]) -> set[str]:
    """The words and pairs of an exemplar's text."""
    return features(list(tokens)) - {"no talk of errors"}


class Exemplars:
    """Feature sets of all exemplars, before weights are known."""

    def __init__(self) -> None:
        self.items: list[Exemplar] = []
        for label, text, made in residue_exemplars():
            self.items.append(Exemplar(label, tuple(sorted(_said(_words(text)))), cover=COVER[label] if made else 0.0))
        for label, first, second in two_part_exemplars():
            parts = _words(first), _words(second)
            held = _said(parts[0]) | _said(parts[1]) | {"no talk of errors"}
            self.items.append(Exemplar(label, tuple(sorted(held)), 1.0, COVER[label], parts))
        for opening, closing, hard in _SLOTS:
            syntax = f"slot {opening}"
            if hard:
                for word in sorted(set(FIELD_WORDS.split())):
                    self.items.append(Exemplar("placeholder", (syntax, f"in {word}", "no talk of slots"), 1.0))
                self.items.append(Exemplar("placeholder", (syntax, "after label", "prose"), 1.0))
                if opening in _UNMISTAKABLE:
                    self.items.append(Exemplar("placeholder", (syntax, "prose"), 1.0))
                continue
            for name in lines(SLOT_NAMES):
                named = tuple(dict.fromkeys(_words(f"{opening}{name}{closing}")))
                self.items.append(Exemplar("placeholder", named))
            for word in ("insert", "insertar", "einfügen", "insérer", "here", "enter"):
                self.items.append(Exemplar("placeholder", (syntax, f"in {word}")))
        self.items.append(Exemplar("placeholder", ("slot {", "in 0")))
        self.items += [Exemplar("placeholder", (gap, "prose"), 1.0) for gap in ("slot %", *EMPTY_VALUES)]
        self.mentions = [Exemplar("mention", tuple(sorted(_said(_words(text)))), EXPLAINED) for text in lines(MENTIONS)]
        self.items += self.mentions
        self.filler = frozenset(FILLER_WORDS.split())
        self.vocabulary = Vocabulary([f for x in self.items for f in x.features] + [*self.filler])
        longest = max(sum(not f.startswith(_MARKS) and " " not in f for f in x.features) for x in self.items)
        assert longest <= WINDOW // 3, "an exemplar would not fit into the overlap of two windows"
        # What every hit must have: a pair of words, a slot, an empty value.
        self.openers = frozenset(
            f for x in self.items if x.label != "mention" for f in x.features
            if f in _GAPS or f.startswith("slot ") or " " in f and not f.startswith(_MARKS) and f not in _STATES
        )

    def scan(self, text: str) -> tuple[set[str], list[list[str]]]:
        """Exemplar features of a text, and its windows that could hold an exemplar."""
        held: set[str] = set()
        kept: list[list[str]] = []
        shown = _shown(text)
        few, before = False, None
        for tokens in _windows(shown):
            here = features(tokens, self.vocabulary)
            if not _SOFT.isdisjoint(tokens):
                here |= features(firm(tokens), self.vocabulary)
            held |= here
            if not self.openers.isdisjoint(here) or not self.filler.isdisjoint(here) and sum(t in self.filler for t in tokens) >= FILLER_LEAST:
                kept.append(tokens)
            # A repeating line has a window of few words, or like windows, one after the other.
            few = few or tokens == before or len(tokens) > 2 and len(set(tokens)) <= len(tokens) // REPEATS + 1
            before = tokens
        if few and any(map(repeats, _LINE.split(shown))):
            kept.append(_REPEATED)
        return held, kept


_REPEATED = ["repeated line"]


def firm(tokens: list[str]) -> list[str]:
    """Tokens without the words that may stand anywhere in a notice."""
    return [t for t in tokens if t not in _SOFT]


def _in_order(parts: tuple[tuple[str, ...], ...], tokens: list[str]) -> bool:
    """Whether the parts stand in the tokens one after the other."""
    at = 0
    for part in parts:
        size = len(part)
        while at + size <= len(tokens) and tuple(tokens[at : at + size]) != part:
            at += 1
        if at + size > len(tokens):
            return False
        at += size
    return True


class ResidueFinder:
    """Inverted index of weighted exemplars.

    ``frequency``: texts that hold a feature, of ``texts`` texts in all.
    """

    def __init__(self, frequency: dict[str, int], texts: int, exemplars: Exemplars | None = None):
        exemplars = exemplars or Exemplars()
        self.filler = exemplars.filler
        self.vocabulary = exemplars.vocabulary
        self.weight = {
            f: math.log((texts + 1) / (frequency.get(f, 0) + 1)) + 1 for f in self.vocabulary.all
        }
        self.items = exemplars.items
        self.totals = [sum(self.weight[f] for f in x.features) for x in self.items]
        # An exemplar reaches its containment only with one of its weightiest
        # features: those that together weigh more than what may be missing.
        self.anchors: dict[str, list[int]] = {}
        for k, x in enumerate(self.items):
            spare = self.totals[k] * (1 - x.least)
            for f in sorted(x.features, key=lambda f: (-self.weight[f], f)):
                self.anchors.setdefault(f, []).append(k)
                spare -= self.weight[f]
                if spare < 0:
                    break

    def _holds(self, k: int, held: set[str]) -> bool:
        x, weight = self.items[k], self.weight
        if x.least == 1.0:
            return held.issuperset(x.features)
        return sum(weight[f] for f in x.features if f in held) >= x.least * self.totals[k]

    def _covers(self, k: int, tokens: list[str]) -> bool:
        x = self.items[k]
        if x.parts and not _in_order(x.parts, tokens):
            return False
        return not x.cover or sum(t in x.features for t in tokens) >= x.cover * len(tokens)

    def _filler(self, tokens: list[str]) -> bool:
        known = sum(t in self.filler for t in tokens)
        if known < FILLER_LEAST:
            return False
        share = sum(self.weight.get(t, 0.0) if t in self.filler else 0.0 for t in tokens)
        rest = sum(1 for t in tokens if t not in self.filler)
        mean = share / known
        return share / (share + rest * mean) >= FILLER_SHARE

    def label(self, tokens: list[str]) -> str | None:
        """Label of the residue in one window, or None."""
        if tokens == _REPEATED:
            return "filler"
        held = features(tokens, self.vocabulary)
        reached = {k for f in held if f in self.anchors for k in self.anchors[f]}
        if reached:
            explained: set[str] = set()
            for k in reached:
                if self.items[k].label == "mention" and self._holds(k, held):
                    explained.update(self.items[k].features)
            left = held - explained
            for k in sorted(reached):
                label = self.items[k].label
                if label != "mention" and self._holds(k, left) and self._covers(k, tokens):
                    return label
            if explained:
                return None
        return "filler" if self._filler(tokens) else None

    def find(self, kept: Iterable[list[str]]) -> str | None:
        """Label of the first residue window."""
        for tokens in kept:
            label = self.label(tokens)
            if not label and not _SOFT.isdisjoint(tokens):
                label = self.label(firm(tokens))
            if label:
                return label
        return None


def _scanned(texts: DataFrame, exemplars: Exemplars, kind: str) -> DataFrame:
    """One pass: ``(d, w)``, candidate windows of a text, and ``(f, n)``, texts per feature of a task.

    ``n`` of a null ``f`` is the number of texts.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        size = 0
        for batch in batches:
            size += len(batch)
            out = []
            for d, text in zip(batch["d"], batch["t"]):
                seen, kept = exemplars.scan(text)
                held.update(seen)
                if kept:
                    out.append((d, [_JOIN.join(w) for w in kept], None, None))
            yield pd.DataFrame(out, columns=["d", "w", "f", "n"], dtype=object)
        yield pd.DataFrame([(None, None, f, n) for f, n in [*held.items(), (None, size)]], columns=["d", "w", "f", "n"], dtype=object)

    return written(texts.mapInPandas(scan, f"d {kind}, w array<string>, f string, n long"), "windows")


_JOIN = "\x1f"


def residue(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(row_id, label)`` of every text with template residue in it.

    Labels: ``placeholder``, ``filler``, ``error page``, ``scripts required``.
    Null, empty and merely short texts have none; rows with a null id are left
    out; repeated rows come as often as they stand there; whole texts are read;
    an empty table gives no rows; other columns are ignored.
    """
    rows = spread(df.select(F.col(row_id).alias("d"), F.col(text).alias("t"))).where(
        F.col("d").isNotNull() & F.col("t").isNotNull()
    )
    exemplars = Exemplars()
    kind = dict(df.dtypes)[row_id]
    scanned = _scanned(rows, exemplars, kind)
    counts = {r["f"]: r["n"] for r in scanned.where(F.col("n").isNotNull()).groupBy("f").agg(F.sum("n").alias("n")).collect()}
    texts = counts.pop(None, 0)
    finder = df.sparkSession.sparkContext.broadcast(ResidueFinder(counts, texts, exemplars))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels = [finder.value.find(w.split(_JOIN) for w in kept) for kept in batch["w"]]
            out = pd.DataFrame({"d": batch["d"], "label": labels})
            yield out[out["label"].notna()]

    found = scanned.where(F.col("w").isNotNull()).select("d", "w").mapInPandas(search, f"d {kind}, label string")
    return found.select(F.col("d").alias(row_id), "label")


def without_residue(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """Rows of ``df`` whose text shows no residue; all columns and rows without an id are kept."""
    marked = residue(df, row_id, text).select(F.col(row_id).alias("_residue_id")).distinct()
    return df.join(marked, df[row_id] == marked["_residue_id"], "left_anti")


def label_all(texts: Iterable[str | None]) -> list[str | None]:
    """Labels of texts held in memory, weighted by those texts alone (for tests)."""
    exemplars = Exemplars()
    scanned = [exemplars.scan(t) if t else (set(), []) for t in texts]
    counts: Counter[str] = Counter()
    for held, _ in scanned:
        counts.update(held)
    finder = ResidueFinder(counts, len(scanned), exemplars)
    return [finder.find(kept) for _, kept in scanned]
