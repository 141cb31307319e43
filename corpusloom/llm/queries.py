"""Named queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, leak, pairs, residue, surface, terms, topn
from corpusloom.llm.canon import map_values
from corpusloom.sources.tables import table


def p1_top_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The first 10 labels of every occupation, with score and rank."""
    return topn.top_per_group(table(spark, folder, "penetration"), "occupation", "label", "rate", 10)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_top_labels(spark, folder).select("occupation", "label")


def p2_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Associated skill pairs with their counts, lift and corrected odds ratio."""
    found = pairs.associated_pairs(table(spark, folder, "normed_occurrences"), "occupation", "job_id", "canonical_skill")
    return found.select(
        "occupation", F.col("item_a").alias("skill_a"), F.col("item_b").alias("skill_b"), "n", "n_a", "n_b", "n_ab",
        F.round("lift", 6).alias("lift"), F.round("odds_ratio", 6).alias("odds_ratio"),
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_pairs(spark, folder).select("occupation", "skill_a", "skill_b")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    values = table(spark, folder, "norm_map").where(F.col("canonical_skill").isNull())
    return map_values(values, "map_id", "raw_skill", table(spark, folder, "skill_list"), "skill_id", "canonical_skill", "other_names")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = surface.same_looking_pairs(table(spark, folder, "surface_form"), "form_id", "form")
    return found.select(F.col("id_a").alias("form_id_a"), F.col("id_b").alias("form_id_b"))


def p4_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of every spelling, named by its smallest id, and the texts in it."""
    return surface.same_looking_classes(table(spark, folder, "surface_form"), "form_id", "form")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return terms.uninformative_values(table(spark, folder, "surface_form"), "normalised_form", "count")


def p5_terms(spark: SparkSession, folder: str) -> DataFrame:
    """N-grams of up to three terms of the normalised forms that 5 rows or more hold."""
    return terms.ngram_frequencies(table(spark, folder, "surface_form"), "normalised_form", 3, 5)


def p5_values(spark: SparkSession, folder: str) -> DataFrame:
    """Total, rows and mark of every normalised form, those without a mark as well."""
    return terms.marked_values(table(spark, folder, "surface_form"), "normalised_form", "count")


def p5_all_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Every n-gram of the normalised forms, of any length and frequency, with its mark."""
    return terms.marked_ngrams(table(spark, folder, "surface_form"), "normalised_form")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), "doc_id", "text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leak.leaked_items(
        table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_item"), "item_id", "text"
    )


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(table(spark, folder, "documents"), "doc_id", "text").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_top_labels, p2_found, p2_pairs, p3_found, p4_found, p4_classes, p5_found, p5_terms, p5_values, p5_all_terms, p6_ids,
        p7_found, p8_found,
    )
}


_P1 = """
WITH best AS (
  SELECT occupation, label, max(rate) AS rate FROM penetration
  WHERE occupation IS NOT NULL AND label IS NOT NULL AND rate IS NOT NULL AND NOT isnan(rate)
  GROUP BY occupation, label
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY occupation ORDER BY rate DESC, label) AS "rank" FROM best
)
"""

_P2 = """
WITH r AS (
  SELECT DISTINCT occupation AS o, job_id AS j, canonical_skill AS s FROM normed_occurrences
  WHERE occupation IS NOT NULL AND job_id IS NOT NULL AND canonical_skill IS NOT NULL
), g AS (SELECT o, count(DISTINCT j) AS n FROM r GROUP BY o),
i AS (SELECT o, s, count(*) AS c FROM r GROUP BY o, s),
p AS (
  SELECT x.o, x.s AS a, y.s AS b, count(*) AS n_ab FROM r x JOIN r y ON x.o = y.o AND x.j = y.j AND x.s < y.s
  GROUP BY x.o, x.s, y.s HAVING count(*) >= 5
), f AS (
  SELECT p.o AS occupation, p.a AS skill_a, p.b AS skill_b, g.n, ia.c AS n_a, ib.c AS n_b, p.n_ab
  FROM p JOIN g ON g.o = p.o JOIN i ia ON ia.o = p.o AND ia.s = p.a JOIN i ib ON ib.o = p.o AND ib.s = p.b
  WHERE p.n_ab * g.n >= 3 * ia.c * ib.c
)
"""

_P5 = """
WITH r AS (SELECT DISTINCT * FROM surface_form WHERE normalised_form IS NOT NULL),
v AS (SELECT normalised_form, coalesce(sum("count"), 0) AS total, count(*) AS n FROM r GROUP BY normalised_form)
SELECT normalised_form, CASE WHEN total < 3 THEN 'rare' ELSE 'common' END AS mark FROM v
WHERE total < 3 OR n >= 0.02 * (SELECT sum(n) FROM v)
"""

_P5_TERMS = """
WITH t AS (
  SELECT row_number() OVER () AS id, list_filter(string_split(normalised_form, ' '), lambda x: x <> '') AS w
  FROM surface_form WHERE normalised_form IS NOT NULL
), s AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
g AS (
  SELECT id, array_to_string(w[i:i + k - 1], ' ') AS gram, k AS n
  FROM s, (SELECT unnest([1, 2, 3]) AS k) ks WHERE i + k - 1 <= len(w)
)
SELECT gram, CAST(n AS INTEGER) AS n, count(*) AS total, count(DISTINCT id) AS "rows"
FROM g GROUP BY gram, n HAVING count(DISTINCT id) >= 5
"""

_P5_VALUES = """
WITH r AS (SELECT DISTINCT * FROM surface_form WHERE normalised_form IS NOT NULL),
v AS (SELECT normalised_form, coalesce(sum("count"), 0) AS total, count(*) AS n FROM r GROUP BY normalised_form)
SELECT normalised_form, CAST(total AS BIGINT) AS total, n AS "rows",
  CASE WHEN total < 3 THEN 'rare' WHEN n >= 0.02 * (SELECT sum(n) FROM v) THEN 'common' END AS mark
FROM v
"""

_P5_ALL_TERMS = """
WITH t AS (
  SELECT row_number() OVER () AS id, list_filter(string_split(normalised_form, ' '), lambda x: x <> '') AS w
  FROM surface_form WHERE normalised_form IS NOT NULL
), s AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
k AS (SELECT id, w, i, unnest(range(1, len(w) - i + 2)) AS k FROM s),
g AS (
  SELECT array_to_string(w[i:i + k - 1], ' ') AS gram, CAST(k AS INTEGER) AS n, count(*) AS total, count(DISTINCT id) AS "rows"
  FROM k GROUP BY ALL
)
SELECT *, CASE WHEN total < 3 THEN 'rare' WHEN "rows" >= 0.02 * (SELECT count(*) FROM t) THEN 'common' END AS mark FROM g
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _p4_keys() -> str:
    """What a form shows, in SQL: letters, widths and blanks by ``translate``, then NFC."""
    source: list[str] = []
    target: list[str] = []
    gone: list[str] = []
    letters = surface._letter_table()
    for cp in range(0x250, 0x2000):
        bare = unicodedata.normalize("NFD", chr(cp))
        if ord(bare[0]) in letters:
            source.append(chr(cp))
            target.append(unicodedata.normalize("NFC", letters[ord(bare[0])] + bare[1:]))
    for cp, to in surface._shape_table().items():
        if len(to) == 1:
            source.append(chr(cp))
            target.append(to)
        elif not to and cp < 0xE0000 and cp not in range(0x00, 0x20) and cp not in range(0x7F, 0xA0):
            gone.append(chr(cp))
    pairs_ = [(a, b) for a, b in zip(source, target) if len(b) == 1]
    shape = f"translate(form, {_quoted(''.join(a for a, _ in pairs_))}, {_quoted(''.join(b for _, b in pairs_))})"
    seen = f"trim(nfc_normalize(regexp_replace({shape}, {_quoted('[' + ''.join(gone) + ']')}, '', 'g')), ' ')"
    return f"WITH k AS (SELECT DISTINCT form_id, form, {seen} AS seen FROM surface_form WHERE form_id IS NOT NULL AND form IS NOT NULL)"


_P4 = _p4_keys() + """
SELECT DISTINCT a.form_id AS form_id_a, b.form_id AS form_id_b
FROM k a JOIN k b ON a.seen = b.seen AND a.form_id < b.form_id AND a.form <> b.form
"""

_P4_CLASSES = _p4_keys() + """
SELECT DISTINCT form_id, min(form_id) OVER (PARTITION BY seen) AS class_id, count(DISTINCT form) OVER (PARTITION BY seen) AS texts FROM k
"""


def _entities() -> str:
    """Names of HTML entities and their characters as a map, from the library's own table."""
    known = [(name, shown) for name, shown in sorted(html5.items()) if name.endswith(";")]
    return f"MAP {{{', '.join(f'{_quoted(chr(38) + name)}: {_quoted(shown)}' for name, shown in known)}}}"


def _p7_words(column: str) -> str:
    unseen = "[" + "".join(chr(low) if low == high else f"{chr(low)}-{chr(high)}" for low, high in surface.IGNORABLE_RANGES if high < 0xE0000) + "]"

    def each(text: str, pattern: str, character: str) -> str:
        """Every entity of a pattern by its character; ``e`` is the entity."""
        return f"list_reduce(list_prepend({text}, list_distinct(regexp_extract_all({text}, '{pattern}'))), lambda t, e: replace(t, e, {character}))"

    bare = f"regexp_replace({column}, '</?[a-zA-Z][^<>]*>', ' ', 'g')"
    named = each("t1", "&[a-zA-Z][a-zA-Z0-9]*;", "coalesce(entities[e], ' ')")
    numbered = each("t2", "&#[0-9]{1,6};", "chr(CAST(substring(e, 3, length(e) - 3) AS INTEGER))")
    hexed = each("t3", "&#[xX][0-9a-fA-F]{1,5};", "chr(CAST('0x' || substring(e, 4, length(e) - 4) AS INTEGER))")
    words = f"regexp_extract_all(lower(nfc_normalize(regexp_replace(t4, {_quoted(unseen)}, '', 'g'))), '[\\p{{L}}\\p{{N}}]+')"
    return f"(SELECT {words} FROM (SELECT {hexed} AS t4 FROM (SELECT {numbered} AS t3 FROM (SELECT {named} AS t2 FROM (SELECT {bare} AS t1) x1, names) x2) x3) x4)"


_P7 = f"""
WITH names AS (SELECT {_entities()} AS entities), d AS (SELECT doc_id, {_p7_words('text')} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, {_p7_words('text')} AS w FROM eval_item WHERE text IS NOT NULL),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS p FROM d WHERE len(w) >= 12),
ip AS (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS p FROM i WHERE len(w) >= 12),
dr AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 11], ' ') AS run FROM dp),
ir AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 11], ' ') AS run FROM ip)
SELECT DISTINCT doc_id, item_id FROM dr JOIN ir ON dr.run = ir.run
"""

ORACLES: dict[str, str] = {
    "p1_found": _P1 + 'SELECT occupation, label FROM ranked WHERE "rank" <= 10',
    "p1_top_labels": _P1 + 'SELECT occupation, label, rate, CAST("rank" AS INTEGER) AS "rank" FROM ranked WHERE "rank" <= 10',
    "p2_found": _P2 + "SELECT occupation, skill_a, skill_b FROM f",
    "p2_pairs": _P2
    + "SELECT *, round(n_ab * n / (n_a::DOUBLE * n_b), 6) AS lift, "
    + "round(((n_ab + 0.5::DOUBLE) * (n - n_a - n_b + n_ab + 0.5::DOUBLE)) / ((n_a - n_ab + 0.5::DOUBLE) * (n_b - n_ab + 0.5::DOUBLE)), 6) AS odds_ratio FROM f",
    "p4_found": _P4,
    "p4_classes": _P4_CLASSES,
    "p5_found": _P5,
    "p5_terms": _P5_TERMS,
    "p5_values": _P5_VALUES,
    "p5_all_terms": _P5_ALL_TERMS,
    "p7_found": _P7,
}
