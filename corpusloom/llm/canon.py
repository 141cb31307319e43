"""Free-entered values mapped to a canonical list (problem 3).

Every distinct value goes through an automaton over all canonical names and
aliases, run on the value's folded letters without blanks, so that split and
joined words are the same text.  The longest non-overlapping mentions win, and
settle the value if nothing is left over but frame words ("experience with",
"tools", ...).  Frame words are no list of this module: they are learned from
the values themselves, as the words that stand beside many different entries.

What remains goes to a token-set similarity: each word is corrected to the
words of the list it may be a slip of, found through a deletion index, and the
sets of corrected words are looked up among the token sets of the names.  All
look-ups are by hash, so the time of a value doesn't grow with the list.

A list too long for a worker is cut into shards.  Each shard answers with a
rank (whole name, mention, similarity) and the least rank wins; the words of
the whole list are known to every shard.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.surface import fold_key
from corpusloom.runtime import tasks, written

NONE = -1

_WORD = re.compile(r"[^\W_]+")
_NUMBER = re.compile(r"v?\d+")

#: A word that stands beside this share of the entries found, and beside so many at least, is a frame word;
#: one that names hold as well needs the second share.
FRAME_SHARE, FRAME_SHARE_LISTED, FRAME_LEAST = 0.02, 0.03, 3
#: Names of fewer letters are codes: a slip makes another code of them, so they match exactly or not at all.
CODE = 5
#: Slips of a whole name: 1 in fewer letters than the first number, 2 in fewer than the second, else 3.
SLIPS = (6, 14)


def plain_words(text: str | None) -> list[str]:
    """Words of the folded text without accents; separators and signs are gaps."""
    if not text:
        return []
    folded = text.lower() if text.isascii() else fold_key(text)
    if not folded.isascii():
        folded = "".join(c for c in unicodedata.normalize("NFD", folded) if not unicodedata.combining(c))
    return _WORD.findall(folded)


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between a and b, or more than ``most``.

    Bit-parallel: one machine-word-like step per letter of ``b``.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    # What both begin and end with costs nothing; slips are local, so little is left.
    start, least = 0, min(len(a), len(b))
    while start < least and a[start] == b[start]:
        start += 1
    end = 0
    while end < least - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return max(len(a), len(b))
    if len(a) == len(b) == 1:
        return 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, diagonal, before, score = full, 0, 0, 0, len(a)
    for c in b:
        here = where.get(c, 0)
        swap = ((((~diagonal) & here) << 1) & before) & full
        diagonal = (((((here & plus) + plus) ^ plus) | here | minus) | swap) & full
        up = (minus | ~(diagonal | plus)) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = ((up << 1) | 1) & full
        down = (down << 1) & full
        plus = (down | ~(diagonal | up)) & full
        minus = up & diagonal
        before = here
    return score


def word_slips(word: str, more: bool = False) -> int:
    """Slips that a word may hold and still be known again; ``more``: where the other words leave less doubt."""
    size = len(word) + (2 if more else 0)
    return 0 if size < 4 else 1 if size < 6 else 2


def shortened(word: str, most: int) -> list[str]:
    """The forms that up to ``most`` (0 to 2) deletions make of a word."""
    forms = [word]
    if most:
        forms += [word[:i] + word[i + 1 :] for i in range(len(word))]
    if most > 1:
        size = len(word)
        forms += [word[:i] + word[i + 1 : j] + word[j + 1 :] for j in range(1, size) for i in range(j)]
    return forms


class NearWords:
    """Words within a few edits of a given one, by a symmetric deletion index.

    Two words within ``d`` edits share a form that ``d`` deletions or fewer make
    of each, so the candidates of a word are a few hash look-ups.
    """

    def __init__(self, words: Iterable[str]):
        self.made: dict[str, list[str]] = {}
        words = sorted(set(words))
        self.longest = max(map(len, words), default=0)
        for word in words:
            for form in set(shortened(word, word_slips(word, True) if len(word) > 2 else 0)):
                self.made.setdefault(form, []).append(word)
        self.forms = frozenset(self.made)
        self.within = lru_cache(maxsize=200_000)(self._within)

    def near(self, word: str, more: bool = False) -> tuple[tuple[str, int], ...]:
        """``(word, edits)`` of all known words within its slips, itself included, nearest first."""
        return self.within(word, word_slips(word, more))

    def _within(self, word: str, most: int) -> tuple[tuple[str, int], ...]:
        if len(word) > self.longest + most:
            return ()
        hits = self.forms.intersection(shortened(word, most))
        if not hits:
            return ()
        met = {w for form in hits for w in self.made[form]}
        found = ((w, edit_distance(word, w, most)) for w in met)
        return tuple(sorted((x for x in found if x[1] <= most), key=lambda x: (x[1], x[0])))


class ListWords:
    """The words of all names: which entry they speak of, and what may be a slip of them."""

    def __init__(self, owner: dict[str, int]):
        self.owner = owner
        self.slips = NearWords(owner)

    def near(self, word: str, most: int) -> tuple[tuple[str, int], ...]:
        """List words within ``most`` edits, nearest first; a word that the list holds stands for itself only,
        else it would be another skill's."""
        return ((word, 0),) if word in self.owner else self.slips.within(word, most)

    def owners(self, word: str) -> frozenset[int]:
        """Entries whose names hold the word or, from 4 letters on, a word it may be a slip of; NONE for several."""
        if word in self.owner:
            return frozenset([self.owner[word]])
        return frozenset(self.owner[w] for w, _ in self.slips.near(word, True))


def name_words(entries: Iterable[tuple[int, str, list[str] | None]]) -> dict[str, int]:
    """Each word of the names with its entry, NONE where several entries hold it."""
    owner: dict[str, int] = {}
    for key, name, more in entries:
        for text in [name, *(more or [])]:
            for w in plain_words(text):
                owner[w] = key if owner.get(w, key) == key else NONE
    return owner


class Mention(NamedTuple):
    key: int
    length: int
    left: tuple[str, ...]  # words left over on both sides, run-together ones as they stand


class Answer(NamedTuple):
    """An entry with its rank among the answers of all shards; the least rank wins, of equal ones none."""

    key: int
    rank: tuple[int, int, int, int]


class Matcher:
    """The names of a list, or of one shard of it, in an automaton and token sets."""

    def __init__(self, entries: Iterable[tuple[int, str, list[str] | None]], words: ListWords, frame: Iterable[str] = ()):
        named = [(i > 0, key, tuple(plain_words(t))) for key, name, more in entries for i, t in enumerate([name, *(more or [])])]
        self.words = words
        # Of names that read alike the canonical one goes first, then the smaller entry.
        self.joined: dict[str, tuple[int, int]] = {}
        self.sets: dict[tuple[str, ...], tuple[int, int]] = {}
        for alias, key, parts in sorted(x for x in named if x[2]):
            self.joined.setdefault("".join(parts), (int(alias), key))
            self.sets.setdefault(tuple(sorted(parts)), (int(alias), key))
        self.longest = max((len(s) for s in self.sets), default=0)
        # The rest of each name beside one of its words, by the letters that the rest begins and ends with.
        self.rests: dict[tuple[str, str, bool], list[tuple[str, int]]] = {}
        for _, key, parts in named:
            for i, w in enumerate(parts if len(parts) > 1 else ()):
                rest = "".join(parts[:i] + parts[i + 1 :])
                for part in ((rest[:2], True), (rest[-2:], False)):
                    self.rests.setdefault((w, *part), []).append((rest, key))
        self.automaton = ahocorasick.Automaton()
        for text, (alias, key) in self.joined.items():
            self.automaton.add_word(text, (len(text), alias, key))
        self.automaton.make_automaton()
        self.with_frame(frame)

    def with_frame(self, frame: Iterable[str]) -> None:
        self.frame = frozenset(frame)
        self.frame_slips = NearWords(w for w in self.frame if len(w) > 1)
        self.frame_like = lru_cache(maxsize=100_000)(self._frame_like)

    # --- mentions --------------------------------------------------------------------

    def mentions(self, words: list[str]) -> list[Mention]:
        """The longest non-overlapping names in the joined letters of ``words``.

        A name begins and ends with a word; inside a word only names that are
        no codes count.  All mentions of an entry are one, with what is left
        over beside them; the longest first.
        """
        if not self.joined:
            return []
        joined = "".join(words)
        ends = list(itertools.accumulate(map(len, words)))
        bounds = {0, *ends}
        found = []
        for end, (n, alias, key) in self.automaton.iter(joined):
            loose = (end + 1 - n not in bounds) + (end + 1 not in bounds)
            if not loose or n >= CODE:
                found.append((-n, loose, end + 1 - n, alias, key))
        if not found:
            return []
        taken: list[tuple[int, int, int]] = []
        for n, _, start, _, key in sorted(found):
            if all(start - n <= s or e <= start for s, e, _ in taken):
                taken.append((start, start - n, key))
        out = []
        for key in dict.fromkeys(k for _, _, k in taken):
            spans = sorted((s, e) for s, e, k in taken if k == key)
            cuts = sorted(bounds.union(*spans))
            left = tuple(joined[a:b] for a, b in zip(cuts, cuts[1:]) if all(b <= s or e <= a for s, e in spans))
            out.append(Mention(key, max(e - s for s, e in spans), left))
        return out

    # --- frame -----------------------------------------------------------------------

    def _frame_like(self, word: str) -> bool:
        """A frame word, a number, several run together, or a slip of one nearer than any word of the list."""
        if word in self.frame or _NUMBER.fullmatch(word):
            return True
        if len(word) < 3 or word in self.words.owner:
            return False
        listed = self.words.near(word, 1)
        if listed:
            return listed[0][0] in self.frame
        near = self.frame_slips.near(word, len(word) == 3)
        if near:
            listed = self.words.near(word, word_slips(word))
            return not listed or near[0][1] < listed[0][1] or listed[0][0] in self.frame
        return any(word[:i] in self.frame and self.frame_like(word[i:]) for i in range(2, len(word) - 1))

    def _without_run_on(self, word: str) -> str:
        """A word less the frame words that run into it at its ends."""
        for cut in range(len(word) - 3, 2, -1):
            if word[:cut] in self.frame:
                word = word[cut:]
                break
        for cut in range(3, len(word) - 2):
            if word[cut:] in self.frame:
                return word[:cut]
        return word

    # --- similarity ------------------------------------------------------------------

    def _near(self, word: str, more: bool, most: int) -> tuple[tuple[str, int], ...]:
        return self.words.near(word, min(most, word_slips(word, more)))

    def _readings(self, words: list[str], most: int) -> Iterator[list[tuple[tuple[str, int], ...]]]:
        """Ways to read the words as list words: each alone, two as one, one as several."""
        near = [self._near(w, len(words) > 1, most) for w in words]
        unknown = [i for i, n in enumerate(near) if not n]
        if not unknown:
            yield near
        if len(unknown) > 2:
            return
        for i in range(len(words) - 1):
            split = words[i] not in self.words.owner or words[i + 1] not in self.words.owner
            if split and all(j in (i, i + 1) for j in unknown):
                both = self._near(words[i] + words[i + 1], len(words) > 2, most)
                if both:
                    yield [*near[:i], both, *near[i + 2 :]]
        for i, word in enumerate(words):
            if 2 * CODE <= len(word) <= 3 * (self.words.slips.longest + 2) and all(j == i for j in unknown) and word not in self.words.owner:
                for pieces in self._pieces(word, 3, most):
                    yield [*near[:i], *pieces, *near[i + 1 :]]

    def _pieces(self, word: str, parts: int, most: int) -> Iterator[list[tuple[tuple[str, int], ...]]]:
        """Readings of a run-together word as 2 to ``parts`` list words."""
        for cut in range(3, len(word) - 2):
            head = self._near(word[:cut], False, most)
            if not head:
                continue
            tail = self._near(word[cut:], False, most)
            if tail:
                yield [head, tail]
            if parts > 2 and len(word) - cut >= 6:
                for rest in self._pieces(word[cut:], parts - 1, most):
                    yield [head, *rest]

    def _by_set(self, words: list[str], most: int) -> dict[int, int]:
        """Entries and edits of the first reading whose set of list words is a name's."""
        best: dict[int, int] = {}
        for slips in range(1, min(most, 2) + 1):  # deeper only while nothing is found
            for reading in self._readings(words, slips):
                if len(reading) > self.longest:
                    continue
                for chosen in itertools.product(*reading):
                    edits = sum(e for _, e in chosen)
                    if edits <= most:
                        hit = self.sets.get(tuple(sorted(w for w, _ in chosen)))
                        if hit is not None:
                            best[hit[1]] = min(edits, best.get(hit[1], edits))
                if best:
                    return best
        return best

    def _by_rest(self, words: list[str], most: int) -> dict[int, int]:
        """Entries that hold one of the words, where no other word is known: the rest compared as a whole."""
        best: dict[int, int] = {}
        known = [i for i, w in enumerate(words) if w in self.words.owner]
        if len(words) > 1 and len(known) == 1:
            i = known[0]
            rest = "".join(words[:i] + words[i + 1 :])
            for name, key in (*self.rests.get((words[i], rest[:2], True), ()), *self.rests.get((words[i], rest[-2:], False), ())):
                edits = edit_distance(rest, name, most)
                if edits <= most:
                    best[key] = min(edits, best.get(key, edits))
        return best

    def similar(self, words: list[str]) -> Answer | None:
        """The entry whose name has nearly the same set of words; none if two are equally near."""
        size = sum(map(len, words))
        if size < CODE - 1 or len(words) > 2 * self.longest:
            return None
        most = 1 if size < SLIPS[0] else 2 if size < SLIPS[1] else 3
        best = self._by_set(words, most) or self._by_rest(words, most)
        if not best:
            return None
        low = min(best.values())
        keys = [key for key, edits in best.items() if edits == low]
        return Answer(keys[0] if len(keys) == 1 else NONE, (2, low, 0, 0))

    # --- decision --------------------------------------------------------------------

    def settled(self, words: list[str]) -> Answer | None:
        """The name that is the whole value."""
        hit = self.joined.get("".join(words))
        return None if hit is None else Answer(hit[1], (0, *hit, 0))

    def answer(self, value: str) -> Answer | None:
        words = plain_words(value)
        if not words:
            return None
        found = self.settled(words)
        if found:
            return found
        mentions = self.mentions(words)
        if mentions and (len(mentions) == 1 or mentions[0].length > mentions[1].length):
            if all(map(self.frame_like, mentions[0].left)):
                return Answer(mentions[0].key, (1, -mentions[0].length, 0, 0))
        bare = [w for w in words if w not in self.frame and not _NUMBER.fullmatch(w)]
        loose = [w for w in words if not self.frame_like(w)]
        tries = [loose, bare, [w for w in words if w in self.words.owner or not self.frame_like(w)], words]
        if len(words) == 1:
            tries.insert(0, [self._without_run_on(words[0])])
        elif len(loose) > 1:
            tries.append([w for w in loose if w in self.words.owner or not self.frame_slips.near(w, True)])
        for n, attempt in enumerate(tries):
            if attempt and attempt not in tries[:n]:
                found = self.similar(attempt)
                if found:
                    return found
        # Last, as a slip in the other words of a longer name leaves a shorter name's mention.
        if len(mentions) == 1 and all(self.words.owners(w) <= {mentions[0].key} or self.frame_like(w) for w in mentions[0].left):
            return Answer(mentions[0].key, (3, -mentions[0].length, 0, 0))
        return None


def frame_of(
    beside: Iterable[tuple[str, int]], entries: int, listed: Iterable[str],
    share: float = FRAME_SHARE, share_listed: float = FRAME_SHARE_LISTED, least: int = FRAME_LEAST,
) -> frozenset[str]:
    """Frame words from ``(word, entries it stands beside)``; ``listed``: words of the names."""
    listed = set(listed)
    return frozenset(w for w, n in beside if n >= max(least, (share_listed if w in listed else share) * entries))


#: Names that one shard of the list holds (about 2 kB a name in a worker); a longer list makes more shards.
SHARD_NAMES = 100_000
#: Words of the whole list, and frame words, that a worker holds; they are counted before they are sent.
MOST_WORDS = 2_000_000

_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, make: Callable[[], Matcher]) -> Matcher:
    """The matcher of a shard, built once per worker; an earlier one goes."""
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = make()
    return _MATCHERS[key]


def _beside(matcher: Matcher, words: list[str]) -> tuple[int | str | None, list[str]]:
    """The entry of the one longest mention and what is left beside it, without numbers.

    A piece of a word bears a mark, so that it is no frame word, unless the
    value is a single word.
    """
    mentions = matcher.mentions(words)
    if not mentions or len(mentions) > 1 and mentions[0].length == mentions[1].length:
        return None, []
    whole = set(words)
    left = [w for w in dict.fromkeys(mentions[0].left) if not _NUMBER.fullmatch(w)]
    return mentions[0].key, [w if w in whole or len(words) == 1 and len(w) > 1 else _PIECE + w for w in left]


#: Marks a piece of a word; no folded word holds it.
_PIECE = " "
#: So many frame words at most are looked up in a plan; more are left to the workers.
PLANNED_FRAME = 5_000


def _bounded(df: DataFrame, most: int, what: str) -> list:
    """All rows of a table that may have ``most`` at most; more are refused, never cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def map_values(
    df: DataFrame, row_id: str, value: str, entries: DataFrame, entry_id: str, name: str, other_names: str | None = None,
    frame: Iterable[str] = (), shard_names: int = SHARD_NAMES,
) -> DataFrame:
    """``(row_id, entry_id)`` for every row with a value; ``-1`` where it means no entry.

    Rows with a null value are left out; empty and meaningless values give
    ``-1``; repeated rows come as often as they stand there; entries with a null
    id or name are no target; an empty list maps everything to ``-1``.
    ``frame``: words known to be able to stand around a name, beside those
    learned from the values.

    Every distinct value is looked at once: first for whole names and for the
    words beside mentions, of which the frame is learned, then, where no name
    is the whole value, for the decision.  The list is sent in shards of
    ``shard_names`` names; the answers of several shards are merged by rank.
    """
    spark = df.sparkSession
    kinds = dict(df.dtypes)[value], dict(entries.dtypes)[entry_id]
    typed = str if kinds[1] == "string" else lambda key: key
    other = F.col(other_names) if other_names else F.lit(None).cast("array<string>")
    names = entries.select(F.col(entry_id).alias("k"), F.col(name).alias("n"), other.alias("o")).where(
        F.col("k").isNotNull() & F.col("n").isNotNull()
    )
    size = names.agg(F.sum(F.lit(1) + F.greatest(F.size(F.coalesce("o", F.array())), F.lit(0)))).first()[0] or 0
    shards = max(1, -(-size // shard_names))
    given = df.select(F.col(row_id).alias("r"), F.col(value).alias("v")).where(F.col("v").isNotNull())
    values = given.select("v").distinct().repartition(tasks(spark))
    if shards > 1:
        values = written(values, "values")
    # One shard at a time passes through the driver.
    shard_of = F.pmod(F.xxhash64("k"), F.lit(shards))

    def listed(shard: int) -> list:
        return sorted((r[0], r[1], [o for o in r[2] or [] if o]) for r in names.where(shard_of == shard).collect())

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [(w, k) for k, n, o in zip(batch["k"], batch["n"], batch["o"]) for w in name_words([(k, n, [x for x in (o if o is not None else []) if x])])]
            yield pd.DataFrame(pairs, columns=["w", "k"])

    owners = names.mapInPandas(words_of, f"w string, k {kinds[1]}").groupBy("w").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    owner = {w: lo if lo == hi else NONE for w, lo, hi in _bounded(owners, MOST_WORDS, "words in the list")}
    shared = spark.sparkContext.broadcast(owner)

    def over_shards(table: DataFrame, look: Callable[[Matcher, str], tuple], schema: str, frame_words: frozenset[str], step: str) -> list[DataFrame]:
        columns = [c.split()[0] for c in schema.split(", ")]
        out = []
        for shard in range(shards):
            entries_here = spark.sparkContext.broadcast(listed(shard))
            key = uuid.uuid4().hex

            def run(batches: Iterator[pd.DataFrame], entries_here=entries_here, key=key) -> Iterator[pd.DataFrame]:
                matcher = _matcher(key, lambda: Matcher(entries_here.value, ListWords(shared.value), frame_words))
                for batch in batches:
                    yield pd.DataFrame([(v, *look(matcher, v)) for v in batch["v"]], columns=columns, dtype=object)

            out.append(written(table.mapInPandas(run, schema), step))
            entries_here.unpersist()
        return out

    def first(matcher: Matcher, v: str) -> tuple:
        words = plain_words(v)
        hit = matcher.joined.get("".join(words))
        if hit:
            return hit[0], typed(hit[1]), None, []
        key, left = _beside(matcher, words)
        return None, None, None if key is None else typed(key), left

    def second(matcher: Matcher, v: str) -> tuple:
        answer = matcher.answer(v)
        return (None, None) if answer is None else (typed(answer.key), list(answer.rank))

    looked = over_shards(values, first, f"v {kinds[0]}, a int, e {kinds[1]}, k {kinds[1]}, left array<string>", frozenset(), "whole")
    seen = reduce(DataFrame.unionByName, looked)
    met = seen.where(F.col("k").isNotNull())
    n_entries = met.agg(F.countDistinct("k")).first()[0]
    beside = (
        met.select("k", F.explode("left").alias("w")).where(~F.startswith("w", F.lit(_PIECE))).distinct().groupBy("w").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= max(FRAME_LEAST, FRAME_SHARE * n_entries))
    )
    learned = frame_of([tuple(r) for r in _bounded(beside, MOST_WORDS, "frame words")], n_entries, owner) | frozenset(frame)

    none = F.lit(NONE).cast(kinds[1])
    if shards == 1:
        # Where nothing but the frame stands beside the one longest mention, that is the answer.
        planned = sorted(learned) if len(learned) <= PLANNED_FRAME else []
        framed = F.col("k").isNotNull() & (F.size(F.array_except("left", F.lit(planned).cast("array<string>"))) == 0)
        seen = seen.withColumn("e", F.coalesce("e", F.when(framed, F.col("k"))))
        whole = seen.where(F.col("e").isNotNull()).select("v", "e")
        open_values = seen.where(F.col("e").isNull()).select("v")
    else:
        best = seen.groupBy("v").agg(F.min(F.when(F.col("e").isNotNull(), F.struct("a", "e"))).alias("b"))
        whole = best.where(F.col("b").isNotNull()).select("v", F.col("b.e").alias("e"))
        open_values = written(best.where(F.col("b").isNull()).select("v"), "open")
    answers = reduce(DataFrame.unionByName, over_shards(open_values, second, f"v {kinds[0]}, e {kinds[1]}, rank array<int>", learned, "answers"))
    if shards == 1:
        decided = answers.select("v", F.coalesce("e", none).alias("e"))
    else:
        ranked = answers.groupBy("v").agg(F.min("rank").alias("low"))
        lowest = answers.join(ranked, "v").where(F.col("rank") == F.col("low")).groupBy("v").agg(F.min("e").alias("lo"), F.max("e").alias("hi"))
        decided = ranked.join(lowest, "v", "left").select("v", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(none).alias("e"))
    return given.join(whole.unionByName(decided), "v").select(F.col("r").alias(row_id), F.col("e").alias(entry_id))
