"""Frequencies of every distinct value and n-gram (problem 5).

Suffix-sorted counting: each text gives its suffixes, truncated to the longest
n-gram asked for; suffixes are routed by their first terms in ranges, sorted in
reverse lexicographic order, and one stack per partition adds up all prefixes.
Every n-gram is a prefix of a run of neighbouring suffixes, so a single pass
counts n-grams of all lengths.  The suffix that starts a text stays whole and
bears a mark at its end, so the same stack gives the frequency of whole values:
values and terms come out of one run.

Two points differ from the textbook form, for scale.  Ranges replace the hash
of the first term, so a term that starts a third of all texts is split by what
follows it; only prefixes of a partition's first or last suffix can go on in
its neighbours, and these few are added up afterwards.  Instead of sets of
record ids a suffix carries the length that the same record has shown before
(``seen``): longer prefixes are new to the record, so the number of records is
exact without holding any set.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.runtime import written

#: Term separator inside a suffix: the lowest code point, so that prefixes are contiguous.
GAP = "\x00"
#: Suffixes a map task holds before it hands on a combined run.
RUN = 400_000

_SUFFIX = "suffix string, start int, seen int, weight long, rows long"
_COUNTED = "gram string, n int, total long, rows long, weight long, whole_rows long, open boolean"

# What a suffix is: one inside a text, one that starts it, or a whole text that no n-gram is taken from.
_INNER, _FIRST, _VALUE = 0, 1, 2


def _escape(term: str) -> str:
    if GAP in term or "\x01" in term:
        return term.replace("\x01", "\x01\x02").replace(GAP, "\x01\x01")
    return term


def _unescape(gram: str) -> str:
    joined = gram.replace(GAP, " ")
    return joined.replace("\x01\x01", GAP).replace("\x01\x02", "\x01") if "\x01" in joined else joined


def _shared(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def text_suffixes(text: str, longest: int) -> list[tuple[str, int, int]]:
    """``(suffix, kind, seen)`` of a text: ``seen`` terms of it begin an earlier suffix of the text.

    The first suffix is whole, the others have ``longest`` terms at most.  A
    text whose blanks are not single and inside counts whole with empty terms,
    of which no n-gram is taken; its terms count without it.
    """
    parts = text.split(" ")
    plain = all(parts)
    terms = [_escape(t) for t in parts if t]
    # The longest prefix shared with an earlier suffix, found among the prefixes met so far.
    met: set[tuple[str, ...]] = set()
    out = [] if plain else [(GAP.join(map(_escape, parts)), _VALUE, 0)]
    for i in range(len(terms)):
        suffix = terms[i : i + longest]
        seen = 0
        for n in range(1, len(suffix) + 1):
            prefix = tuple(suffix[:n])
            if prefix in met:
                seen = n
            else:
                met.add(prefix)
        if plain and not i:
            out.append((GAP.join(terms), _FIRST, 0))
        else:
            out.append((GAP.join(suffix), _INNER, seen))
    return out


def _make_suffixes(longest: int):
    """Rows ``(v, w)`` to combined suffix runs."""

    # Plain dictionaries: the hash tables of pandas end a text at its first NUL.
    def combine(values: dict[str, list[int]]) -> pd.DataFrame:
        sums: dict[tuple[str, int, int], list[int]] = {}
        for v, (weight, size) in values.items():
            for key in text_suffixes(v, longest):
                entry = sums.setdefault(key, [0, 0])
                entry[0] += weight
                entry[1] += size
        rows = [(suffix, kind, seen, weight, size) for (suffix, kind, seen), (weight, size) in sums.items()]
        return pd.DataFrame(rows, columns=["suffix", "start", "seen", "weight", "rows"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values: dict[str, list[int]] = {}
        for batch in batches:
            for v, w in zip(batch["v"], batch["w"]):
                held = values.setdefault(v, [0, 0])
                held[0] += w
                held[1] += 1
            if len(values) >= RUN:
                yield combine(values)
                values = {}
        if values:
            yield combine(values)

    return run


def _count_prefixes(longest: int, least: int, values: bool):
    """The stack over suffixes in reverse lexicographic order.

    Hands on n-grams of ``least`` rows or more and, with ``values``, whole texts.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path: list[str] = []
        # Per depth: occurrences, rows, rows not new below this depth, weight and rows of whole texts.
        stack: list[list[int]] = []
        like_first = -1  # terms that the path shares with the partition's first suffix
        out: list[tuple] = []

        def pop(last: bool) -> None:
            total, rows, stop, weight, whole = stack.pop()
            depth = len(path)
            rows -= stop
            counts = depth <= longest
            if not counts:
                total_here = rows_here = 0
            else:
                total_here, rows_here = total, rows
            # Equal suffixes meet in one partition, so only a prefix can go on in the next.
            open_ = counts and (last or depth <= like_first)
            if (values and whole) or open_ or (counts and rows >= max(1, least)):
                out.append((GAP.join(path), depth, total_here, rows_here, weight, whole, open_))
            path.pop()
            if stack:
                stack[-1][0] += total
                stack[-1][1] += rows

        for batch in batches:
            for suffix, kind, seen, weight, rows in zip(
                batch["suffix"], batch["start"], batch["seen"], batch["weight"], batch["rows"]
            ):
                terms = suffix.split(GAP)
                common = _shared(path, terms)
                while len(path) > common:
                    pop(False)
                like_first = len(terms) if like_first < 0 else min(like_first, common)
                while len(path) < len(terms):
                    path.append(terms[len(path)])
                    stack.append([0, 0, 0, 0, 0])
                node = stack[-1]
                if kind != _VALUE:
                    node[0] += rows
                    node[1] += rows
                if kind != _INNER:
                    node[3] += weight
                    node[4] += rows
                if seen:
                    stack[seen - 1][2] += rows
            if out:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out = []
        while path:
            pop(True)
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)

    return run


_COLUMNS = [c.split()[0] for c in _COUNTED.split(", ")]


@F.pandas_udf(T.StringType())
def _to_text(grams: pd.Series) -> pd.Series:
    return grams.map(_unescape)


def _counted(rows: DataFrame, longest: int, least: int, values: bool) -> DataFrame:
    """Counts of all prefixes; ``open`` ones of neighbouring partitions added up."""
    suffixes = written(rows.mapInPandas(_make_suffixes(longest), _SUFFIX), "suffixes")
    parts = (
        suffixes.repartitionByRange("suffix").sortWithinPartitions(F.desc("suffix"))
        .mapInPandas(_count_prefixes(longest, least, values), _COUNTED)
    )
    parts = written(parts, "counted")
    sums = [F.sum(c).alias(c) for c in ("total", "rows", "weight", "whole_rows")]
    edge = parts.where("open").groupBy("gram", "n").agg(*sums)
    return parts.where(~F.col("open")).drop("open").unionByName(edge)


def value_frequencies(df: DataFrame, value: str, count: str, longest: int = 1) -> DataFrame:
    """``(value, total, rows)`` of every distinct value.

    Whole-row copies count once (over all columns); rows with a null value are
    left out; a null count adds nothing, so a value of nulls only has total 0.
    Values are compared exactly as stored, the empty string is a value.  An
    empty table gives no rows.  Taken from the suffix run of the values' n-grams
    of up to ``longest`` terms: the whole texts that its stack has marked.
    """
    rows = df.distinct().select(F.col(value).alias("v"), F.coalesce(F.col(count).cast("long"), F.lit(0)).alias("w")).where(
        F.col("v").isNotNull()
    )
    # Only whole texts and what is open at the ends is handed on.
    counted = _counted(rows, longest, sys.maxsize, True).where(F.col("whole_rows") > 0)
    return counted.select(_to_text("gram").alias(value), F.col("weight").alias("total"), F.col("whole_rows").alias("rows"))


def _marked(counted: DataFrame, all_rows: DataFrame, rare_below: int, common_share: float) -> DataFrame:
    """``counted`` with ``mark``: ``rare`` below the total, else ``common`` from the share of ``all_rows`` on, else null."""
    mark = F.when(F.col("total") < rare_below, "rare").when(
        F.col("rows") >= F.lit(common_share) * F.col("all_rows"), "common"
    )
    return counted.crossJoin(F.broadcast(all_rows)).withColumn("mark", mark).drop("all_rows")


def marked_values(df: DataFrame, value: str, count: str, rare_below: int = 3, common_share: float = 0.02) -> DataFrame:
    """``(value, total, rows, mark)`` of every distinct value; see ``value_frequencies``."""
    counted = written(value_frequencies(df, value, count), "values")
    all_rows = counted.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"))
    return _marked(counted, all_rows, rare_below, common_share)


def uninformative_values(df: DataFrame, value: str, count: str, rare_below: int = 3, common_share: float = 0.02) -> DataFrame:
    """``(value, mark)``: ``rare`` below the total, else ``common`` from the share of rows on."""
    return marked_values(df, value, count, rare_below, common_share).select(value, "mark").where(F.col("mark").isNotNull())


def ngram_frequencies(df: DataFrame, text: str, longest: int | None = 3, least: int = 1) -> DataFrame:
    """``(gram, n, total, rows)`` of every n-gram of up to ``longest`` terms; None: of any length.

    Terms are what blanks separate; ``total`` counts every occurrence, ``rows``
    the rows that hold the n-gram, at least ``least``.  Null and empty texts
    hold none; repeated rows count as often as they stand there.  Without
    ``longest`` the suffixes of a text grow with the square of its terms.
    """
    rows = df.select(F.col(text).alias("v"), F.lit(1).cast("long").alias("w")).where(F.col("v").isNotNull())
    counted = _counted(rows, sys.maxsize if longest is None else longest, least, False).where(F.col("rows") >= max(1, least))
    return counted.select(_to_text("gram").alias("gram"), "n", "total", "rows")


def marked_ngrams(
    df: DataFrame, text: str, longest: int | None = None, rare_below: int = 3, common_share: float = 0.02
) -> DataFrame:
    """``(gram, n, total, rows, mark)`` of every n-gram; the share is of the rows with a text."""
    all_rows = df.agg(F.count(text).alias("all_rows"))
    return _marked(ngram_frequencies(df, text, longest), all_rows, rare_below, common_share)
