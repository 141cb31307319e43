"""The domain's facts over the test tables, as DataFrames and as SQL.

An ad is a distinct ``(year, occupation, posting_id)`` of ``posting``; a
mention is a row of ``normed_occurrences`` of such an ad; a concept is a skill.
Types, categories, held marks and facets are functions of the skill's length,
since the tables carry none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import adjacency, cells
from corpusloom.runtime import written
from corpusloom.sources.tables import table

BASE, TARGET = "2021", "2026"

ACRONYMS = {"taq": "tabular querying", "nlp": "natural language processing", "saet": "spatial extraction", "bop": "boiler pricing"}
STOPWORDS = ["and", "data", "for", "in", "of", "the", "with", "dense"]
PARENT_STOP = ["pricing", "data", "tools"]


def posting(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "posting").where("year IS NOT NULL AND occupation IS NOT NULL AND posting_id IS NOT NULL")
    return rows.groupBy("year", "occupation", "posting_id").agg(F.min("status").alias("status"))


def ads(spark: SparkSession, d: str) -> DataFrame:
    return cells.ad_counts(posting(spark, d))


def mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "normed_occurrences").where("occupation IS NOT NULL AND job_id IS NOT NULL AND canonical_skill IS NOT NULL")
    named = rows.select("year", "occupation", F.col("job_id").alias("posting_id"), F.col("canonical_skill").alias("concept_id"))
    return named.join(posting(spark, d).select("year", "occupation", "posting_id"), ["year", "occupation", "posting_id"], "left_semi")


def dims(spark: SparkSession, d: str) -> DataFrame:
    skill, n = F.col("canonical_skill"), F.length("canonical_skill")
    return table(spark, d, "skill_list").select(
        skill.alias("concept_id"), skill.alias("concept_label"),
        F.when(n % 4 == 0, "").when(n % 4 == 1, "tool").when(n % 4 == 2, "method").otherwise("domain").alias("concept_type"),
        F.when(n % 6 == 5, cells.BOILERPLATE).when(n % 6 == 4, "").otherwise(F.concat(F.lit("cat_"), (n % 6).cast("string"))).alias("primary_category"),
        (n % 11 == 0).alias("held"),
    )


def facets(spark: SparkSession, d: str) -> DataFrame:
    skill, n = F.col("canonical_skill"), F.length("canonical_skill")
    rows = table(spark, d, "skill_list")
    related = rows.select(skill.alias("concept_id"), F.lit("relatedness").alias("facet_id"), F.when(n % 3 == 0, "none").when(n % 3 == 1, "core").otherwise("adjacent").alias("value"))
    wave = rows.select(skill.alias("concept_id"), F.lit("wave").alias("facet_id"), F.when(F.contains(skill, F.lit(" ")), "none").otherwise("first").alias("value"))
    return related.unionByName(wave)


def facts(spark: SparkSession, d: str) -> DataFrame:
    return cells.with_dims(cells.posting_concepts(mentions(spark, d)), dims(spark, d))


GRAINS = ("concept", "category", "type", "facet")


def kept_facts(spark: SparkSession, d: str, year: str | None = None) -> DataFrame:
    """The fact table, or one year of it, written once for the several branches that read it."""
    rows = facts(spark, d)
    return written(rows if year is None else rows.where(F.col("year") == year), "facts")


def kept_ads(spark: SparkSession, d: str) -> DataFrame:
    return written(ads(spark, d), "ads")


def rates(spark: SparkSession, d: str, grains: tuple[str, ...] = GRAINS, table_: DataFrame | None = None, ads_: DataFrame | None = None) -> DataFrame:
    return cells.penetration(table_ or kept_facts(spark, d), ads_ or ads(spark, d), facets(spark, d), grains)


def changes(spark: SparkSession, d: str, grains: tuple[str, ...] = GRAINS, table_: DataFrame | None = None, ads_: DataFrame | None = None) -> DataFrame:
    ads_ = ads_ or kept_ads(spark, d)
    return cells.change_tests(rates(spark, d, grains, table_, ads_), ads_, BASE, TARGET)


def countable(spark: SparkSession, d: str) -> DataFrame:
    return adjacency.countable(kept_facts(spark, d))


def edges(spark: SparkSession, d: str, prune: bool = True, table_: DataFrame | None = None, ads_: DataFrame | None = None) -> DataFrame:
    used = adjacency.countable(table_ or kept_facts(spark, d))
    pairs = adjacency.joint_counts(used, ads_ or ads(spark, d), prune)
    return adjacency.flagged(adjacency.measured(pairs), TARGET).drop("_lift", "_geo")


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d, table_=kept_facts(spark, d, TARGET)).where(F.col("passes_graph") == 1)


def skill_forms(spark: SparkSession, d: str) -> DataFrame:
    """``(form, count)``: names of the list and their single words, with their mentions."""
    words = F.explode(F.concat(F.array("canonical_skill"), F.split("canonical_skill", " ")))
    rows = table(spark, d, "normed_occurrences").where("canonical_skill IS NOT NULL").groupBy("canonical_skill").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(words.alias("form"), "n").where("form <> ''").groupBy("form").agg(F.sum("n").alias("count"))


# --- the same in SQL --------------------------------------------------------------------

SQL_POSTING = """
posting_d AS (
  SELECT year, occupation, posting_id, min(status) AS status FROM posting
  WHERE year IS NOT NULL AND occupation IS NOT NULL AND posting_id IS NOT NULL GROUP BY year, occupation, posting_id
), ads AS (SELECT year, occupation, count(*) AS n_ads FROM posting_d GROUP BY year, occupation)"""

SQL_FACTS = SQL_POSTING + """,
dims AS (
  SELECT canonical_skill AS concept_id, canonical_skill AS concept_label,
    CASE length(canonical_skill) % 4 WHEN 0 THEN '' WHEN 1 THEN 'tool' WHEN 2 THEN 'method' ELSE 'domain' END AS concept_type,
    CASE length(canonical_skill) % 6 WHEN 5 THEN 'cat_generic_field_reference' WHEN 4 THEN '' ELSE 'cat_' || (length(canonical_skill) % 6) END AS primary_category,
    length(canonical_skill) % 11 = 0 AS held
  FROM skill_list
), facets AS (
  SELECT canonical_skill AS concept_id, 'relatedness' AS facet_id, CASE length(canonical_skill) % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'core' ELSE 'adjacent' END AS value FROM skill_list
  UNION ALL SELECT canonical_skill, 'wave', CASE WHEN contains(canonical_skill, ' ') THEN 'none' ELSE 'first' END FROM skill_list
), mentions AS (
  SELECT o.year, o.occupation, o.job_id AS posting_id, o.canonical_skill AS concept_id
  FROM normed_occurrences o JOIN posting_d p ON p.year = o.year AND p.occupation = o.occupation AND p.posting_id = o.job_id
  WHERE o.canonical_skill IS NOT NULL
), facts AS (
  SELECT m.*, coalesce(d.concept_label, '') AS concept_label, coalesce(d.concept_type, '') AS concept_type,
    coalesce(d.primary_category, '') AS primary_category, coalesce(d.held, false) AS held
  FROM (SELECT year, occupation, posting_id, concept_id, count(*) AS n_mentions FROM mentions GROUP BY ALL) m LEFT JOIN dims d USING (concept_id)
)"""

_Z = "1.959963984540054::DOUBLE"
_WILSON_HALF = f"({_Z} / (1 + {_Z} * {_Z} / n_ads)) * sqrt((hits / n_ads) * (1 - hits / n_ads) / n_ads + {_Z} * {_Z} / (4.0::DOUBLE * n_ads * n_ads))"
_WILSON_MID = f"((hits / n_ads) + {_Z} * {_Z} / (2 * n_ads)) / (1 + {_Z} * {_Z} / n_ads)"

SQL_RATES = SQL_FACTS + f""",
grains AS (
  SELECT year, occupation, posting_id, 'concept' AS grain, '' AS facet_id, concept_id AS key, concept_label AS label FROM facts
  UNION ALL SELECT DISTINCT year, occupation, posting_id, 'category', '', primary_category, primary_category FROM facts WHERE primary_category <> ''
  UNION ALL SELECT DISTINCT year, occupation, posting_id, 'type', '', concept_type, concept_type FROM facts WHERE concept_type <> ''
  UNION ALL SELECT DISTINCT f.year, f.occupation, f.posting_id, 'facet', t.facet_id, t.value, t.value FROM facts f JOIN facets t USING (concept_id) WHERE t.value <> 'none'
), counted AS (SELECT year, occupation, grain, facet_id, key, label, count(*) AS hits FROM grains GROUP BY ALL),
held_set AS (SELECT DISTINCT concept_id FROM facts WHERE held),
rates AS (
  SELECT c.year, c.occupation, c.grain, c.facet_id, c.key, c.label, a.n_ads, c.hits, round(hits / n_ads, 6) AS rate,
    round(greatest(0.0::DOUBLE, {_WILSON_MID} - {_WILSON_HALF}), 6) AS wilson_low, round(least(1.0::DOUBLE, {_WILSON_MID} + {_WILSON_HALF}), 6) AS wilson_high,
    CASE WHEN c.grain = 'concept' AND h.concept_id IS NOT NULL THEN 1 ELSE 0 END AS is_held,
    CASE WHEN c.grain = 'category' AND c.key = 'cat_generic_field_reference' THEN 1 ELSE 0 END AS is_boilerplate
  FROM counted c JOIN ads a ON a.year = c.year AND a.occupation = c.occupation LEFT JOIN held_set h ON h.concept_id = c.key
)"""


def _erfc(x: str) -> str:
    from corpusloom.functions.stats import ERFC_TERMS

    t = f"(1 / (1 + 0.5::DOUBLE * ({x})))"
    poly = f"{ERFC_TERMS[-1]}::DOUBLE"
    for term in reversed(ERFC_TERMS[:-1]):
        poly = f"({term}::DOUBLE + {t} * {poly})"
    return f"{t} * exp(-({x}) * ({x}) + {poly})"


SQL_CHANGES = SQL_RATES + f""",
sizes AS (
  SELECT occupation, coalesce(max(CASE WHEN year = '{BASE}' THEN n_ads END), 0) AS n1, coalesce(max(CASE WHEN year = '{TARGET}' THEN n_ads END), 0) AS n2
  FROM ads WHERE year IN ('{BASE}', '{TARGET}') GROUP BY occupation
), hit AS (
  SELECT occupation, grain, facet_id, key, label, coalesce(max(CASE WHEN year = '{BASE}' THEN hits END), 0) AS h1, coalesce(max(CASE WHEN year = '{TARGET}' THEN hits END), 0) AS h2
  FROM rates WHERE year IN ('{BASE}', '{TARGET}') GROUP BY ALL
), raw AS (
  SELECT *, CASE WHEN n1 > 0 AND n2 > 0 THEN h2 / n2 - h1 / n1 END AS d,
    CASE WHEN n1 > 0 AND n2 > 0 THEN sqrt(((h1 + h2) / (n1 + n2)) * (1 - (h1 + h2) / (n1 + n2)) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)) END AS se
  FROM hit JOIN sizes USING (occupation)
), zed AS (SELECT *, CASE WHEN se > 0 THEN (h2 / n2 - h1 / n1) / se END AS zz FROM raw),
changes AS (
  SELECT occupation, grain, facet_id, key, label, n1 AS n_base, h1 AS hits_base, n2 AS n_target, h2 AS hits_target,
    CASE WHEN n1 = 0 THEN 0.0::DOUBLE ELSE round(h1 / n1, 6) END AS rate_base, CASE WHEN n2 = 0 THEN 0.0::DOUBLE ELSE round(h2 / n2, 6) END AS rate_target,
    round(d, 6) AS diff, round(zz, 4) AS z, round({_erfc('abs(zz) / sqrt(2.0::DOUBLE)')}, 4) AS p_value,
    CASE WHEN abs(zz) > {_Z} THEN 1 ELSE 0 END AS significant, CASE WHEN d > 0 THEN 'up' WHEN d < 0 THEN 'down' ELSE 'flat' END AS direction
  FROM zed
)"""

SQL_EDGES = f""",
used AS (SELECT * FROM facts WHERE NOT held AND primary_category <> 'cat_generic_field_reference'),
single AS (SELECT year, occupation, concept_id, count(*) AS c FROM used GROUP BY ALL),
joint AS (
  SELECT x.year, x.occupation, x.concept_id AS concept_a, y.concept_id AS concept_b, count(*) AS count_ab
  FROM used x JOIN used y ON x.year = y.year AND x.occupation = y.occupation AND x.posting_id = y.posting_id AND x.concept_id < y.concept_id GROUP BY ALL
), stats AS (
  SELECT j.*, sa.c AS count_a, sb.c AS count_b, n_ads, (count_ab * n_ads) / (sa.c * sb.c) AS l, sqrt((count_ab / sa.c) * (count_ab / sb.c)) AS g,
    greatest(3, CAST(floor((3 * n_ads + 99) / 100) AS BIGINT)) AS g_min, greatest(5, CAST(floor((5 * n_ads + 99) / 100) AS BIGINT)) AS a_min
  FROM joint j JOIN ads USING (year, occupation)
  JOIN single sa ON sa.year = j.year AND sa.occupation = j.occupation AND sa.concept_id = j.concept_a
  JOIN single sb ON sb.year = j.year AND sb.occupation = j.occupation AND sb.concept_id = j.concept_b
), edges AS (
  SELECT year, occupation, concept_a, concept_b, count_ab, count_a, n_ads, count_b,
    round(count_a / n_ads, 6) AS support_a, round(count_b / n_ads, 6) AS support_b, round(count_ab / n_ads, 6) AS support_ab,
    round(count_ab / count_a, 6) AS conf_ab, round(count_ab / count_b, 6) AS conf_ba, floor(l * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS lift, round(g, 6) AS geo_mean_conf,
    CASE WHEN year = '{TARGET}' AND count_ab >= g_min AND (l > 1.3::DOUBLE OR (greatest(count_a, count_b) / n_ads >= 0.6::DOUBLE AND l > 1.05::DOUBLE)) THEN 1 ELSE 0 END AS passes_graph,
    CASE WHEN count_ab >= a_min AND count_a >= 5 AND count_b >= 5 AND l > 1 THEN 1 ELSE 0 END AS passes_analysis
  FROM stats
), flagged AS (SELECT * FROM edges WHERE passes_graph = 1 OR passes_analysis = 1),
graph AS (SELECT * FROM edges WHERE passes_graph = 1),
nodes AS (
  SELECT s.year, s.occupation, s.concept_id, s.c AS "count", n_ads, round(s.c / n_ads, 6) AS support FROM single s JOIN ads USING (year, occupation)
  WHERE s.year = '{TARGET}' AND s.c >= greatest(3, CAST(floor((3 * n_ads + 99) / 100) AS BIGINT))
)"""

#: White space as a class of the SQL engine's regular expressions.
SQL_WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_fold(x: str, bullets: bool = False) -> str:
    from corpusloom.functions import text as t

    blanks = t.EVIDENCE_SPACES + t.BULLETS if bullets else t.PLAIN_SPACES
    source = t.PLAIN_QUOTES + t.PLAIN_DOUBLE_QUOTES + t.PLAIN_DASHES + blanks
    target = "''" * len(t.PLAIN_QUOTES) + '"' * len(t.PLAIN_DOUBLE_QUOTES) + "-" * len(t.PLAIN_DASHES) + " " * len(blanks)
    return f"replace(replace(translate({x}, '{source}', '{target}'), '…', '...'), chr(8203), '')"


def sql_paren(x: str) -> str:
    return sql_trim(f"regexp_replace({x}, '{SQL_WS}*\\([^)]{{1,60}}\\){SQL_WS}*$', '')")


def sql_acronym(x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(ACRONYMS.items())) + f" ELSE {x} END"


def sql_flat(x: str) -> str:
    folded = sql_fold(x, True)
    collapsed = f"regexp_replace({folded}, '{SQL_WS}+', ' ', 'g')"
    return f"lower({sql_trim(collapsed)})"


def sql_tokens(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_split_to_array(translate({x}, '/-', '  '), '{SQL_WS}+'), lambda w: w <> '')))"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"
