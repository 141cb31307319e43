"""Test passages inside the corpus (problem 7).

The test items form a BM25 inverted index with block maxima.  Every passage of
every corpus text is a query; block-max WAND retrieves all items above a
threshold, and the overlap of the two word sequences is verified.

The threshold loses nothing.  BM25 weights are positive, so a passage that
holds a run of ``run_words`` words of an item scores at least what the run's
words score alone.  Each item's weights are divided by the lowest such score
over its own runs; then every item's threshold is 1, and every true case
reaches it.  Passages overlap by ``run_words - 1`` words, so each run of a text
lies whole in some passage.

Items that fit into one index are sent to the executors.  More items make an
index in partitions: every run of an item and of a passage is filed under its
leading pair of neighbouring words (the one of most letters, then by hash),
which is the same on both sides where the run is the same.  Items and passages
meet in buckets of these keys, each bucket builds its own index and the passages
stream past it.  The corpus is read once and no item comes to the driver.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.surface import IGNORABLE_RANGES
from corpusloom.runtime import spread, tasks, written

_WORD = re.compile(r"[^\W_]+")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_ENTITY = re.compile(r"&(?:[a-zA-Z][a-zA-Z0-9]*|#\d+|#[xX][0-9a-fA-F]+);")
_UNSEEN = re.compile("[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in IGNORABLE_RANGES) + "]+")

#: Items of one index: as many are sent to the executors, and as many a bucket holds.
BLOCK_ITEMS = 50_000
#: Words of all items that are sent (about 30 bytes each in a worker).
BLOCK_WORDS = 5_000_000
#: Passages of a bucket that one task takes; more are shared among tasks that each hold its items.
BUCKET_PASSAGES = 200_000
#: Bits of the table that says which keys the items have: 32 MB at most, whatever their number.
MOST_BITS = 28
#: Items whose weights share a block maximum.
IMPACT_BLOCK = 16
_SLACK = 1e-9


def _character(entity: re.Match[str]) -> str:
    """What an entity stands for; a blank if its name is unknown."""
    shown = html.unescape(entity[0])
    return " " if shown == entity[0] else shown


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, caseless; markup, signs and unseen characters are no words."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(_character, text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _UNSEEN.sub("", text)).casefold()
        return _WORD.findall(unicodedata.normalize("NFKC", text))
    return _WORD.findall(text.lower())


class ItemIndex:
    """BM25 index of items, weights divided by each item's floor.

    Postings are numpy arrays per term, in item order; ``ceiling[t]`` is the
    term's largest weight, ``blocks[t]`` maps item blocks to theirs.
    """

    def __init__(self, items: Iterable[tuple[int, str | None]], run_words: int = 12, k1: float = 1.2, b: float = 0.75):
        self.run_words = run_words
        split = [(key, words_of(text)) for key, text in items]
        split = [(key, words) for key, words in split if len(words) >= run_words]
        self.keys = [key for key, _ in split]
        self.terms: dict[str, int] = {}
        held = Counter(w for _, words in split for w in set(words))
        average = sum(len(words) for _, words in split) / max(1, len(split))
        posted: dict[int, list[tuple[int, float]]] = {}
        # The words of each item, 4 bytes each, for the overlap.
        self.texts: list[bytes] = []
        for i, (_, words) in enumerate(split):
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words]
            length = k1 * (1 - b + b * len(words) / average)
            weights = {
                self.terms[w]: math.log(1 + (len(split) - held[w] + 0.5) / (held[w] + 0.5)) * n * (k1 + 1) / (n + length)
                for w, n in Counter(words).items()
            }
            runs = {tuple(ids[s : s + run_words]) for s in range(len(ids) - run_words + 1)}
            floor = min(sum(weights[t] for t in set(run)) for run in runs)
            self.texts.append(np.array(ids, dtype=np.int32).tobytes())
            for t, weight in weights.items():
                posted.setdefault(t, []).append((i, weight / floor))
        size = len(self.terms)
        self.ceiling = np.zeros(size + 1)  # the last is for words of no item
        self.postings: list[tuple[list[int], list[float]]] = [([], [])] * size
        self.blocks: list[dict[int, float]] = [{}] * size
        for t, pairs in posted.items():
            self.postings[t] = ([i for i, _ in pairs], [w for _, w in pairs])
            self.ceiling[t] = max(w for _, w in pairs)
            block: dict[int, float] = {}
            for i, w in pairs:
                block[i // IMPACT_BLOCK] = max(block.get(i // IMPACT_BLOCK, 0.0), w)
            self.blocks[t] = block

    def retrieve(self, query: Iterable[int], threshold: float = 1.0) -> list[int]:
        """Items that score at least ``threshold``: block-max WAND, item at a time."""
        need = threshold - _SLACK
        cursors = [[self.postings[t][0][0], 0, t] for t in query]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.ceiling[t]
                if bound >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // IMPACT_BLOCK
            if sum(self.blocks[t].get(block, 0.0) for _, _, t in cursors[: pivot + 1]) >= need:
                if cursors[0][0] == item:
                    if sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1]) >= need:
                        found.append(item)
                    target = item + 1
                else:
                    target = item
            else:
                # No item of this block can reach the threshold with these terms.
                target = (block + 1) * IMPACT_BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, max(cursors[pivot + 1][0], item + 1))
            alive = []
            for k, cursor in enumerate(cursors):
                if k <= pivot and cursor[0] < target:
                    ids = self.postings[cursor[2]][0]
                    at = bisect_left(ids, target, cursor[1])
                    if at == len(ids):
                        continue
                    cursor[0], cursor[1] = ids[at], at
                alive.append(cursor)
            cursors = alive
        return found

    def leaks(self, text: str | None, passage: int = 24) -> list[int]:
        """Keys of the items that share ``run_words`` consecutive words with ``text``."""
        return self.leaks_of(words_of(text), passage)

    def leaks_of(self, words: list[str], passage: int = 24) -> list[int]:
        if len(words) < self.run_words or not self.keys:
            return []
        none = len(self.terms)
        get = self.terms.get
        ids = np.fromiter((get(w, none) for w in words), dtype=np.int64, count=len(words))
        weight = np.cumsum(np.r_[0.0, self.ceiling[ids]])
        passage = max(passage, self.run_words)
        step = passage - self.run_words + 1
        starts = np.arange(0, len(ids) - self.run_words + 1, step)
        ends = np.minimum(starts + passage, len(ids))
        # A repeated word counts twice here, so this only errs upwards.
        rich = np.flatnonzero(weight[ends] - weight[starts] >= 1.0 - _SLACK)
        found: set[int] = set()
        for k in rich:
            part = ids[starts[k] : ends[k]]
            query = set(part.tolist()) - {none}
            if self.ceiling[list(query)].sum() < 1.0 - _SLACK:
                continue
            for item in self.retrieve(query):
                if item not in found and self._overlaps(part, item):
                    found.add(item)
        return [self.keys[i] for i in sorted(found)]

    def _overlaps(self, part: np.ndarray, item: int) -> bool:
        text, size = self.texts[item], 4 * self.run_words
        words = part.astype(np.int32).tobytes()
        for start in range(0, len(words) - size + 1, 4):
            at = text.find(words[start : start + size])
            while at >= 0 and at % 4:
                at = text.find(words[start : start + size], at + 1)
            if at >= 0:
                return True
        return False


def run_keys(words: list[str], run_words: int) -> np.ndarray:
    """The leading key of each run of ``run_words`` words: the same run has the same key anywhere."""
    if len(words) < run_words:
        return np.array([], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    sizes = np.fromiter(map(len, words), dtype=np.uint64, count=len(words))
    span = run_words
    if run_words > 1:
        hashes = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        sizes = sizes[:-1] + sizes[1:]
        span = run_words - 1
    # Pairs of many letters lead, as they are rare; the hash tells those of equal size apart.
    ranks = ((np.uint64(63) - np.minimum(sizes, np.uint64(63))) << np.uint64(58)) | (_mixed(hashes) >> np.uint64(6))
    return np.lib.stride_tricks.sliding_window_view(ranks, span).min(axis=1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(keys) >> np.uint64(64 - bits)).astype(np.int64)


def _in_buckets(texts: DataFrame, tests: DataFrame, kinds: tuple[str, str], run_words: int, block_items: int, passage: int = 24) -> DataFrame:
    """Pairs of texts and items from an index in partitions."""
    spark = texts.sparkSession

    def of_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, t in zip(batch["i"], batch["t"]):
                words = words_of(t)
                rows += [(int(k), i, " ".join(words)) for k in np.unique(run_keys(words, run_words)).astype(np.int64)]
            yield pd.DataFrame(rows, columns=["key", "i", "w"])

    tests = spread(tests).where(F.col("i").isNotNull() & F.col("t").isNotNull())
    filed = written(tests.mapInPandas(of_items, f"key long, i {kinds[1]}, w string"), "filed")
    n_filed = filed.count()
    buckets = max(tasks(spark), -(-4 * n_filed // block_items))
    bits = min(MOST_BITS, max(16, (8 * n_filed).bit_length()))
    chunk = 1 << 16  # slots of one piece of the table

    @F.pandas_udf("long")
    def slot(keys: pd.Series) -> pd.Series:
        return pd.Series(_places(keys.to_numpy(np.int64).view(np.uint64), bits))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            slots = batch["slot"].to_numpy(np.int64)
            for number in np.unique(slots // chunk):
                piece = held.setdefault(int(number), np.zeros(chunk // 8, dtype=np.uint8))
                own = slots[slots // chunk == number] % chunk
                np.bitwise_or.at(piece, own // 8, (1 << (own % 8)).astype(np.uint8))
        yield pd.DataFrame({"number": list(held), "piece": [p.tobytes() for p in held.values()]})

    # The slots of one piece meet in one task, so what comes together is the table once.
    slots = filed.select(slot("key").alias("slot")).distinct().repartition(tasks(spark), F.shiftright("slot", 16))
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for number, piece in slots.mapInPandas(pieces, "number int, piece binary").toLocalIterator():
        at = number * (chunk // 8)
        table[at : at + chunk // 8] = np.frombuffer(bytes(piece), dtype=np.uint8)
    known = spark.sparkContext.broadcast(table)
    step = max(passage, run_words) - run_words + 1

    def of_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bit = known.value
        for batch in batches:
            rows = []
            for d, t in zip(batch["d"], batch["t"]):
                words = words_of(t)
                keys = run_keys(words, run_words)
                slots = _places(keys, bits)
                good = np.flatnonzero(bit[slots // 8] >> (slots % 8).astype(np.uint8) & 1)
                met: dict[int, set[int]] = {}
                for s in good:
                    met.setdefault(int(s) // step, set()).add(int(keys[s] % np.uint64(buckets)))
                for k, places in met.items():
                    part = " ".join(words[k * step : k * step + step + run_words - 1])
                    rows += [(b, d, part) for b in places]
            yield pd.DataFrame(rows, columns=["b", "d", "w"])

    passages = written(texts.mapInPandas(of_texts, f"b long, d {kinds[0]}, w string").distinct(), "passages")
    low = np.uint64(buckets)

    @F.pandas_udf("long")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series((keys.to_numpy(np.int64).view(np.uint64) % low).astype(np.int64))

    listed = filed.select(bucket("key").alias("b"), "i", "w").distinct()
    # Parts of a bucket: by items, so that an index fits, and by texts, so that none is hot.
    held = listed.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_items)).cast("int").alias("parts"))
    busy = passages.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(BUCKET_PASSAGES)).cast("int").alias("shares"))
    plan = written(held.join(busy, "b"), "plan")
    nothing = F.lit(None)
    left = listed.join(plan, "b").select(
        "b", F.pmod(F.xxhash64("i"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        F.lit(0).alias("side"), "i", nothing.cast(kinds[0]).alias("d"), "w",
    )
    right = passages.join(plan, "b").select(
        "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("d", "w"), F.col("shares")).cast("int").alias("share"),
        F.lit(1).alias("side"), nothing.cast(kinds[1]).alias("i"), "d", "w",
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, items, index = None, [], None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("b", "part", "share", "side", "i", "d", "w"))
            for b, part, share, side, i, d, w in zip(*columns):
                if (b, part, share) != here:
                    here, items, index = (b, part, share), [], None
                if side == 0:
                    items.append((i, w))
                elif items:
                    index = index or ItemIndex(items, run_words)
                    out += [(d, item) for item in index.leaks_of(w.split(" "), passage)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], batch.schema.field(c).type) for k, c in enumerate(("d", "i"))], ["d", "i"]
            )

    place = ["b", "part", "share"]
    both = left.unionByName(right).repartition(tasks(spark), *place).sortWithinPartitions(*place, "side")
    return both.mapInArrow(search, f"d {kinds[0]}, i {kinds[1]}")


def leaked_items(
    corpus: DataFrame, row_id: str, text: str, items: DataFrame, item_id: str, item_text: str, run_words: int = 12,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``(row_id, item_id)`` of every text that shares ``run_words`` consecutive words with an item.

    A word is a run of letters and digits; case, signs, markup, line breaks and
    characters without width don't matter.  Null and empty texts, null ids and
    items of fewer words have no case; each pair comes once.  Whole texts are
    read, in one scan of the corpus.  Up to ``block_items`` items make one index
    that goes to the executors; more make an index in partitions of as many.
    """
    spark = corpus.sparkSession
    texts = spread(corpus.select(F.col(row_id).alias("d"), F.col(text).alias("t"))).where(
        F.col("d").isNotNull() & F.col("t").isNotNull()
    )
    tests = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    held = tests.where(F.col("i").isNotNull() & F.col("t").isNotNull())
    kinds = dict(corpus.dtypes)[row_id], dict(items.dtypes)[item_id]
    n_items, letters = held.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    if n_items <= block_items and letters <= 4 * BLOCK_WORDS:
        index = spark.sparkContext.broadcast(ItemIndex(sorted((r[0], r[1]) for r in held.collect()), run_words))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                pairs = [(d, i) for d, t in zip(batch["d"], batch["t"]) for i in index.value.leaks(t)]
                yield pd.DataFrame(pairs, columns=["d", "i"])

        out = texts.mapInPandas(search, f"d {kinds[0]}, i {kinds[1]}")
    else:
        out = _in_buckets(texts, tests, kinds, run_words, block_items)
    return out.distinct().select(F.col("d").alias(row_id), F.col("i").alias(item_id))
