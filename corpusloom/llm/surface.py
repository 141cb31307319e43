"""Text that looks the same, brought to one form (problem 4).

Two keys come out of every text:

``visual_key``
    what the reader sees.  Width variants, characters without width, kinds of
    blank, composed or combining marks and look-alike letters are levelled;
    letter case, accents, punctuation, inner blank counts, superscripts and
    fractions stay apart, because they are seen apart.

``fold_key``
    the coarser form for comparing text: compatibility normalisation (composed
    form) and full case folding on top of the visual key.

Both are pure functions of the text, computed once per distinct value of an
Arrow batch.  ``visual_key(a) == visual_key(b)`` implies
``fold_key(a) == fold_key(b)``: rows block on the fold key, and within a block
the visual keys are compared.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.runtime import written

# Letters of other scripts drawn like a Latin letter.  Left the
# letter, right the Latin letter it is drawn as; applied to decomposed text, so
# accented letters (for instance Cyrillic io) follow their base letter.
CYRILLIC_LOWER = "а a е e о o с c р p у y х x і i ј j ѕ s ԁ d һ h ԛ q ԝ w ӏ l"
CYRILLIC_UPPER = "А A В B Е E К K М M Н H О O Р P С C Т T Х X І I Ј J Ѕ S Ԛ Q Ԝ W"
GREEK_LOWER = "ο o ϲ c ϳ j"
GREEK_UPPER = "Α A Β B Ε E Ζ Z Η H Ι I Κ K Μ M Ν N Ο O Ρ P Τ T Υ Y Χ X Ϲ C Ϳ J"

# Ranges of default-ignorable code points (Unicode property).
IGNORABLE_RANGES = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160),
    (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E),
    (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
    (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3),
    (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)

# Code points that show as a blank, besides the space itself.
BLANKS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


def _letter_table() -> dict[int, str]:
    table = {}
    for line in (CYRILLIC_LOWER, CYRILLIC_UPPER, GREEK_LOWER, GREEK_UPPER):
        cells = line.split()
        table.update((ord(a), b) for a, b in zip(cells[::2], cells[1::2]))
    return table


def _shape_table() -> dict[int, str]:
    """Width variants to their normal form, blanks to the space, ignorables away."""
    table: dict[int, str] = {}
    for cp in range(0xFF00, 0xFFF0):
        if unicodedata.decomposition(chr(cp)).startswith(("<wide>", "<narrow>")):
            table[cp] = unicodedata.normalize("NFKC", chr(cp))
    for cp in (*range(0x00, 0x20), *range(0x7F, 0xA0)):
        table[cp] = ""
    for low, high in IGNORABLE_RANGES:
        for cp in range(low, high + 1):
            table[cp] = ""
    for cp in BLANKS:
        table[cp] = " "
    return table


#: A list of blocks up to this many rows (12 bytes each) is sent to the executors whole.
BROADCAST_BLOCKS = 1_000_000

_SHAPE = _shape_table()
_LETTERS = _letter_table()


def visual_key(text: str | None) -> str | None:
    """What ``text`` shows; ``None`` stays ``None``, a text of blanks becomes ``""``."""
    if text is None:
        return None
    if text.isascii() and text.isprintable():
        return text.strip(" ")
    shaped = text.translate(_SHAPE)
    if not shaped.isascii():
        bare = unicodedata.normalize("NFD", shaped).translate(_LETTERS)
        shaped = unicodedata.normalize("NFC", bare)
    return shaped.strip(" ")


def fold_key(text: str | None) -> str | None:
    """Caseless compatibility form of ``visual_key(text)`` for comparing texts."""
    return _folded(visual_key(text))


def _folded(seen: str | None) -> str | None:
    if seen is None or seen.isascii():
        return seen if seen is None else seen.lower()
    folded = unicodedata.normalize("NFKC", seen).casefold()
    # Folding can leave a sequence that composes anew, or set a blank free at an end.
    return unicodedata.normalize("NFKC", folded).strip(" ")


def _distinct(values: pd.Series) -> tuple[list[str | None], np.ndarray]:
    """Distinct values and the place of each value among them; null is the last one."""
    # Arrow's dictionary, as the hash tables of pandas end a text at its first NUL.
    coded = pa.array(values, pa.string()).dictionary_encode()
    known = [*coded.dictionary.to_pylist(), None]
    return known, coded.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)


def _per_distinct(values: pd.Series, function) -> pd.Series:
    known, at = _distinct(values)
    made = np.array([*map(function, known), None], dtype=object)[:-1]
    return pd.Series(made[at], index=values.index, dtype=object)


@F.pandas_udf(T.StringType())
def visual_key_udf(values: pd.Series) -> pd.Series:
    return _per_distinct(values, visual_key)


@F.pandas_udf(T.StringType())
def fold_key_udf(values: pd.Series) -> pd.Series:
    return _per_distinct(values, fold_key)


def with_keys(df: DataFrame, text: str, visual: str = "visual", folded: str = "folded") -> DataFrame:
    """``df`` with the two keys of column ``text``; null texts get null keys."""
    return df.withColumns({visual: visual_key_udf(F.col(text)), folded: fold_key_udf(F.col(text))})


_KEYS = T.StructType([T.StructField("fold", T.BinaryType()), T.StructField("seen", T.BinaryType())])


def _digests(text: str | None) -> tuple[bytes | None, bytes | None]:
    """Digests of 8 bytes of the fold key, which only blocks, and of 16 bytes of the visual key, which decides."""
    if text is None:
        return None, None
    seen = visual_key(text)
    return (
        hashlib.blake2b(_folded(seen).encode(), digest_size=8).digest(),
        hashlib.blake2b(seen.encode(), digest_size=16).digest(),
    )


@F.pandas_udf(_KEYS)
def _keys_udf(values: pd.Series) -> pd.DataFrame:
    known, at = _distinct(values)
    both = np.array([*map(_digests, known)], dtype=object)
    return pd.DataFrame({"fold": both[at, 0], "seen": both[at, 1]})


def _keyed(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(id, text, fold, seen)``, texts and keys as digests: whole texts are read once and travel nowhere."""
    rows = df.select(F.col(row_id).alias("_id"), F.col(text).alias("_t")).where(F.col("_id").isNotNull() & F.col("_t").isNotNull())
    keys = rows.select("_id", F.unhex(F.md5("_t")).alias("_text"), _keys_udf("_t").alias("_k"))
    return written(keys.select("_id", "_text", F.col("_k.fold").alias("_fold"), F.col("_k.seen").alias("_seen")), "keys")


def same_looking_pairs(df: DataFrame, row_id: str, text: str, hot: int = 20_000) -> DataFrame:
    """Pairs of rows whose texts differ in code points but look the same.

    Returns ``(id_a, id_b)`` with ``id_a < id_b``, each pair once.  Rows with a
    null id or text have no partner; repeated rows count once; rows with the
    very same text are no pair; texts without any visible character look like
    the empty text.  An empty table gives no rows, other columns are ignored.

    Rows block on the fold key; one aggregate with map-side combine finds the
    blocks of more than one text, and only their rows go on.  Within a block
    rows pair up where the visual keys agree.  A block of more than ``hot`` rows
    is cut into ``ceil(n / hot)`` salts on one side and repeated on the other,
    so no task holds a whole one.  The pairs of a class grow with the square of
    its rows; ``same_looking_classes`` says the same in a row per row.
    """
    keyed = _keyed(df, row_id, text)
    blocks = written(
        keyed.groupBy("_fold").agg(F.count(F.lit(1)).alias("_n"), F.min("_text").alias("_lo"), F.max("_text").alias("_hi"))
        .where(F.col("_lo") != F.col("_hi"))
        .select("_fold", F.ceil(F.col("_n") / F.lit(hot)).cast("int").alias("_salts")),
        "blocks",
    )
    few = blocks.count() <= BROADCAST_BLOCKS
    kept = keyed.join(F.broadcast(blocks) if few else blocks, "_fold").distinct()
    left = kept.select(
        "_fold", F.col("_seen").alias("_sa"), F.col("_id").alias("_a"), F.col("_text").alias("_ta"),
        F.pmod(F.xxhash64("_id"), F.col("_salts")).cast("int").alias("_salt"),
    )
    right = kept.select(
        "_fold", F.col("_seen").alias("_sb"), F.col("_id").alias("_b"), F.col("_text").alias("_tb"),
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"),
    )
    same = (F.col("_sa") == F.col("_sb")) & (F.col("_a") < F.col("_b")) & (F.col("_ta") != F.col("_tb"))
    pairs = left.join(right, ["_fold", "_salt"]).where(same)
    return pairs.select(F.col("_a").alias("id_a"), F.col("_b").alias("id_b")).distinct()


def same_looking_classes(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(row_id, class_id, texts)``: rows that look the same bear the smallest id among them.

    ``texts``: distinct texts of the class.  The classes are whole, so their
    heads have no further links.  Rows with a null id or text are left out,
    repeated rows come once; an empty table gives no rows.
    """
    keyed = _keyed(df, row_id, text)
    # Distinct texts first, so that the rows of a hot text are gone when its class is counted.
    per_text = keyed.groupBy("_fold", "_seen", "_text").agg(F.min("_id").alias("_id"))
    heads = per_text.groupBy("_fold", "_seen").agg(F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("texts"))
    out = keyed.select("_id", "_fold", "_seen").distinct().join(heads, ["_fold", "_seen"])
    return out.select(F.col("_id").alias(row_id), "class_id", "texts").distinct()


def one_form_per_text(df: DataFrame, text: str, out: str = "one_form") -> DataFrame:
    """``df`` with column ``out``: the fold key of ``text`` (null stays null)."""
    return df.withColumn(out, fold_key_udf(F.col(text)))


__all__ = [
    "visual_key", "fold_key", "visual_key_udf", "fold_key_udf", "with_keys",
    "same_looking_pairs", "same_looking_classes", "one_form_per_text",
]
