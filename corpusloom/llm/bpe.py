"""Encoding of text with a public byte-level tokenizer (problem 6).

Merges run in rounds over many words at once: the symbols of all words lie in
one flat array, a binary search over the sorted pair keys finds the rank of
every neighbouring pair, and each round merges each word's lowest-ranked pair
wherever it stands in the word.  Distinct words are encoded once per worker.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import spread

#: Where the public vocabulary files lie; every function takes another place.
TOKENIZERS = os.environ.get("CORPUSLOOM_TOKENIZERS", "/opt/tokenizers")

# Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NEVER = np.iinfo(np.int32).max


@dataclass(frozen=True)
class MergeTable:
    """Ids of the 256 bytes, and the merges as sorted pair keys with rank and product."""

    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    products: np.ndarray
    base: int


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in vocabulary files: printable bytes
    for themselves, the others in turn from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def load_merges(name: str = "byte_bpe_50k", folder: str | None = None) -> MergeTable:
    """The merge table of ``<folder>/<name>.json``."""
    with open(os.path.join(folder or TOKENIZERS, f"{name}.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = model["vocab"]
    pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    base = max(ids.values()) + 1
    letters = _byte_letters()
    keys = np.array([ids[a] * base + ids[b] for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys)
    products = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
    return MergeTable(
        np.array([ids[letters[b]] for b in range(256)], dtype=np.int32),
        keys[order], np.arange(len(pairs), dtype=np.int32)[order], products[order], base,
    )


def merge_words(words: list[bytes], table: MergeTable) -> list[np.ndarray]:
    """Ids of each word (non-empty bytes), by batched merge rounds."""
    out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    symbols = table.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        rank = np.full(len(symbols), _NEVER, dtype=np.int32)
        product = np.zeros(len(symbols), dtype=np.int32)
        if len(symbols) > 1:
            key = symbols[:-1].astype(np.int64) * table.base + symbols[1:]
            at = np.minimum(np.searchsorted(table.keys, key), len(table.keys) - 1)
            known = (table.keys[at] == key) & (owner[1:] == owner[:-1])
            rank[:-1][known] = table.ranks[at[known]]
            product[:-1][known] = table.products[at[known]]
        low = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(symbols)])
        ended = low == _NEVER
        if ended.any():
            for s, n in zip(starts[ended], sizes[ended]):
                out[owner[s]] = symbols[s : s + n]
        chosen = (rank == np.repeat(low, sizes)) & (rank != _NEVER)
        # Of overlapping places ("aaa") the first, third, ... of a run merge.
        picks = np.flatnonzero(chosen)
        if len(picks):
            fresh = np.r_[True, np.diff(picks) != 1]
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(picks)), 0))
            picks = picks[(np.arange(len(picks)) - run_start) % 2 == 0]
        symbols = symbols.copy()
        symbols[picks] = product[picks]
        keep = np.repeat(~ended, sizes)
        keep[picks + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return out


class Encoder:
    """Text to ids; keeps the ids of up to ``kept`` distinct words."""

    def __init__(self, table: MergeTable, pattern: str = PATTERN, kept: int = 300_000):
        self.table = table
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.kept = kept

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts give an empty list."""
        split = [self.split(t) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in self.known})
        if new:
            if len(self.known) + len(new) > self.kept:
                self.known.clear()
                new = list({w for words in split for w in words})
            for word, ids in zip(new, merge_words([w.encode() for w in new], self.table)):
                self.known[word] = tuple(ids.tolist())
        known = self.known
        out = []
        for words in split:
            ids: list[int] = []
            for w in words:
                ids += known[w]
            out.append(ids)
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encode(df: DataFrame, row_id: str, text: str, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``(row_id, ids array<int>)`` of every row, special tokens as ordinary text.

    Null and empty texts give an empty array; nulls in the id and repeated rows
    are kept as they are.  The merge table (about 1 MB, fixed by the vocabulary
    file) is sent to the executors, the file is only read by the driver.
    """
    table = df.sparkSession.sparkContext.broadcast(load_merges(name, folder))
    key = (name, folder)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(table.value)
        for texts in batches:
            yield pd.Series(_ENCODERS[key].encode_batch(texts.tolist()), index=texts.index, dtype=object)

    coder = F.pandas_udf(run, "array<int>")
    return spread(df.select(F.col(row_id), F.col(text).alias("_text"))).select(row_id, coder("_text").alias("ids"))
