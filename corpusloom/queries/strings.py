"""Queries of the string layer: folding, evidence, rules, families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import duplicates, govern, ranking, resolve
from corpusloom.queries import domain as m
from corpusloom.queries.registry import query
from corpusloom.runtime import written
from corpusloom.sources.tables import table

_RAW = "(SELECT DISTINCT raw_skill AS form FROM norm_map WHERE raw_skill IS NOT NULL)"


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "norm_map").where("raw_skill IS NOT NULL").select(F.col("raw_skill").alias("form")).distinct()


def _skills(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "skill_list").select(F.col("canonical_skill").alias("form"))


@query(f"SELECT form, {m.sql_trim('lower(form)')} AS key FROM {_RAW}")
def join_key_fold(spark: SparkSession, d: str) -> DataFrame:
    """Lower case, trimmed."""
    return _raw(spark, d).withColumn("key", text.join_key(F.col("form")))


_COLLAPSED = f"regexp_replace({m.sql_trim('lower(' + m.sql_fold('form') + ')')}, '{m.SQL_WS}+', ' ', 'g')"


@query(f"SELECT form, {m.sql_acronym('l')} AS level1 FROM (SELECT form, {m.sql_paren(_COLLAPSED)} AS l FROM {_RAW})")
def level1_fold(spark: SparkSession, d: str) -> DataFrame:
    """The level-1 form."""
    return _raw(spark, d).withColumn("level1", text.level1(F.col("form"), m.ACRONYMS))


@query(f"SELECT form, {m.sql_acronym('l')} AS legacy FROM (SELECT form, {m.sql_paren(m.sql_trim('lower(form)'))} AS l FROM {_RAW})")
def legacy_steps(spark: SparkSession, d: str) -> DataFrame:
    """The older steps."""
    return _raw(spark, d).withColumn("legacy", text.legacy_steps(F.col("form"), m.ACRONYMS))


@query(f"SELECT form, {m.sql_paren('form')} AS bare FROM {_RAW}")
def paren_strip(spark: SparkSession, d: str) -> DataFrame:
    """One trailing bracket dropped."""
    return _raw(spark, d).withColumn("bare", text.strip_parenthesis(F.col("form")))


@query(f"""WITH base AS (SELECT unnest(['taq', 'nlp', 'bop']) AS k, unnest(['tabular querying', 'natural language processing', 'boiler pricing']) AS v),
overlay AS (SELECT 'data_generalist' AS occupation, 'bop' AS k, 'bounded optimisation' AS v)
SELECT r.occupation, r.form, coalesce(o.v, b.v, r.form) AS expanded FROM (SELECT DISTINCT occupation, lower(raw_skill) AS form FROM norm_map WHERE raw_skill IS NOT NULL AND occupation IS NOT NULL) r
LEFT JOIN overlay o ON o.occupation = r.occupation AND o.k = r.form LEFT JOIN base b ON b.k = r.form""")
def acronym_expand(spark: SparkSession, d: str) -> DataFrame:
    """P5: base map, and an occupation's own entries before it."""
    base = spark.createDataFrame([("taq", "tabular querying"), ("nlp", "natural language processing"), ("bop", "boiler pricing")], "form string, b string")
    overlay = spark.createDataFrame([("data_generalist", "bop", "bounded optimisation")], "occupation string, form string, o string")
    rows = table(spark, d, "norm_map").where("raw_skill IS NOT NULL AND occupation IS NOT NULL").select("occupation", F.lower("raw_skill").alias("form")).distinct()
    joined = rows.join(overlay, ["occupation", "form"], "left").join(base, "form", "left")
    return joined.select("occupation", "form", F.coalesce("o", "b", "form").alias("expanded"))


@query(f"SELECT doc_id, {m.sql_flat('text')} AS flat FROM documents")
def evidence_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Texts as evidence is compared."""
    return table(spark, d, "documents").select("doc_id", text.evidence_flatten(F.col("text")).alias("flat"))


#: Evidence of an ad: a span of its text in lower case, or its job title; the occupation is the name.
_EVIDENCE = f"""WITH p AS (SELECT posting_id, occupation, min(job_title) AS title FROM posting WHERE posting_id IS NOT NULL AND occupation IS NOT NULL GROUP BY ALL),
v AS (SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN lower(substring(d.text, 5, 30)) ELSE p.title END AS evidence, replace(p.occupation, '_', ' ') AS name, d.text
FROM documents d JOIN p ON p.posting_id = d.posting_id AND p.occupation = d.occupation WHERE d.text IS NOT NULL),
e AS (SELECT doc_id, evidence, {m.sql_flat('text')} AS body, {m.sql_flat('evidence')} AS fe, {m.sql_flat('name')} AS fn FROM v)
"""


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "posting").where("posting_id IS NOT NULL AND occupation IS NOT NULL").groupBy("posting_id", "occupation").agg(F.min("job_title").alias("title"))
    docs = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "posting_id", "occupation", "text").join(titles, ["posting_id", "occupation"])
    span = F.when(F.col("doc_id") % 2 == 0, F.lower(F.substring("text", 5, 30))).otherwise(F.col("title"))
    named = docs.withColumns({"evidence": span, "name": F.replace("occupation", F.lit("_"), F.lit(" "))})
    return govern.evidence_tiers(named, "evidence", "name", "text")


@query(_EVIDENCE + "SELECT doc_id, evidence FROM e WHERE fe <> '' AND contains(body, fe)")
def evidence_containment(spark: SparkSession, d: str) -> DataFrame:
    """P10: ads whose evidence stands in their text."""
    return _evidence(spark, d).where("evidence_match = 'span'").select("doc_id", "evidence")


@query(_EVIDENCE + "SELECT doc_id, CASE WHEN fe <> '' AND contains(body, fe) THEN 'span' WHEN fn <> '' AND contains(body, fn) THEN 'name' END AS evidence_match FROM e")
def evidence_two_tier(spark: SparkSession, d: str) -> DataFrame:
    """Span, else name, else dropped."""
    return _evidence(spark, d).select("doc_id", "evidence_match")


@query("""SELECT map_id, skill, CASE map_id % 4 WHEN 0 THEN 'tool' WHEN 1 THEN 'method' ELSE 'soft' END AS type, CASE map_id % 3 WHEN 0 THEN 'required' ELSE 'unclear' END AS requirement
FROM (SELECT map_id, raw_skill AS skill FROM norm_map WHERE raw_skill IS NOT NULL) WHERE map_id % 4 <> 3 AND regexp_replace(skill, '""" + m.SQL_WS + """', '', 'g') <> ''""")
def item_filter(spark: SparkSession, d: str) -> DataFrame:
    """Named items of known kinds, requirement unclear where missing."""
    n = F.col("map_id") % 4
    kind = F.when(n == 0, "tool").when(n == 1, "method").when(n == 2, "soft").otherwise("degree")
    items = table(spark, d, "norm_map").select("map_id", F.col("raw_skill").alias("skill"), kind.alias("type"), F.when(F.col("map_id") % 3 == 0, "required").alias("requirement"))
    return govern.kept_items(items, ["tool", "method", "soft"]).select("map_id", "skill", "type", "requirement")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, lower(event_type) ORDER BY event_id) AS r FROM events) WHERE r = 1")
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """The first of each name per record."""
    return govern.first_of_each(table(spark, d, "events"), ["user_id"], F.lower("event_type"), "event_id").select("user_id", "event_type", "event_id")


_SAFE = "substring(regexp_replace(form, '[^a-zA-Z0-9_-]', '_', 'g'), 1, 64)"


@query(f"""SELECT form, CASE WHEN r = 0 THEN safe ELSE substring(safe, 1, 59) || '_' || lpad(CAST(r AS VARCHAR), 4, '0') END AS custom_id
FROM (SELECT form, safe, row_number() OVER (PARTITION BY safe ORDER BY form) - 1 AS r FROM (SELECT form, {_SAFE} AS safe FROM {_RAW}))""")
def sanitise_ids(spark: SparkSession, d: str) -> DataFrame:
    """Clean ids without collisions."""
    return govern.unique_ids(_raw(spark, d), "form")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    """A field of a JSON text."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fenced_json_parse(spark: SparkSession, d: str) -> DataFrame:
    """The same out of a fenced answer."""
    answer = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    return table(spark, d, "events").select("event_id", F.from_json(text.unfenced(answer), "k bigint")["k"].alias("k"))


@query("SELECT skill_id, 'cpt_' || substring(sha256('skill-concept:v1' || chr(31) || lower(trim(canonical_skill))), 1, 16) AS concept_id FROM skill_list")
def concept_id_hash(spark: SparkSession, d: str) -> DataFrame:
    """Stable concept ids."""
    return table(spark, d, "skill_list").select("skill_id", text.concept_id(F.col("canonical_skill")).alias("concept_id"))


@query(f"SELECT form, array_to_string({m.sql_tokens('form')}, ' ') AS token_key FROM {_RAW}")
def token_key(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct tokens."""
    return _raw(spark, d).withColumn("token_key", text.token_key(F.col("form")))


@query(f"SELECT form, array_to_string(list_filter({m.sql_tokens('form')}, lambda w: NOT list_contains({m.sql_list(m.STOPWORDS)}, w)), ' ') AS content FROM {_RAW}")
def content_tokens(spark: SparkSession, d: str) -> DataFrame:
    """P20: tokens less stop words."""
    return _raw(spark, d).select("form", F.array_join(text.content_tokens(F.col("form"), m.STOPWORDS), " ").alias("content"))


@query("""SELECT skill_id, (list_has_any(string_split(lower(canonical_skill), ' '), ['relay', 'vault', 'canvas']) OR contains(lower(canonical_skill), 'stress-testing')) AS vendor FROM skill_list""")
def vendor_token_test(spark: SparkSession, d: str) -> DataFrame:
    """A vendor word, or a vendor phrase within."""
    c = F.col("canonical_skill")
    return table(spark, d, "skill_list").select("skill_id", text.mentions_vendor(c, ["relay", "vault", "canvas"], ["stress-testing"]).alias("vendor"))


@query("""SELECT occupation, array_to_string(list_transform(string_split(occupation, '_'), lambda w: CASE WHEN w = 'data' THEN 'DATA' ELSE upper(substring(w, 1, 1)) || lower(substring(w, 2)) END), ' ') AS pretty
FROM (SELECT DISTINCT occupation FROM posting WHERE occupation IS NOT NULL)""")
def slug_pretty(spark: SparkSession, d: str) -> DataFrame:
    """Slugs as titles."""
    rows = table(spark, d, "posting").where("occupation IS NOT NULL").select("occupation").distinct()
    return rows.withColumn("pretty", text.pretty_slug(F.col("occupation"), {"data": "DATA"}))


@query(f"SELECT form, CASE WHEN length(form) < 5 THEN 'too_short' END AS threshold_used FROM {_RAW}")
def short_forms(spark: SparkSession, d: str) -> DataFrame:
    """Short forms pass through unblocked."""
    return _raw(spark, d).withColumn("threshold_used", F.when(F.length("form") < 5, "too_short"))


@query("SELECT raw_skill AS form, count(*) AS \"count\" FROM norm_map WHERE raw_skill IS NOT NULL GROUP BY raw_skill HAVING count(*) >= 2 AND length(raw_skill) <= 60")
def candidate_filter(spark: SparkSession, d: str) -> DataFrame:
    """P25: forms worth comparing."""
    counts = resolve.form_counts(table(spark, d, "norm_map"), "raw_skill")
    return counts.where((F.col("count") >= 2) & (F.length("form") <= 60))


@query("SELECT normalised_form AS form, CAST(coalesce(sum(\"count\"), 0) AS BIGINT) AS \"count\" FROM surface_form WHERE normalised_form IS NOT NULL GROUP BY normalised_form")
def form_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Mentions per normalised form."""
    return resolve.form_counts(table(spark, d, "surface_form"), "normalised_form", F.coalesce("count", F.lit(0)))


@query("""SELECT concept_id, arg_min(form, struct_pack(a := -c, b := length(form), d := form)) AS canonical FROM (
SELECT concept_id, form, coalesce(sum("count"), 0) AS c FROM surface_form WHERE concept_id IS NOT NULL AND form IS NOT NULL GROUP BY ALL) GROUP BY concept_id""")
def canonical_pick(spark: SparkSession, d: str) -> DataFrame:
    """Most mentions, then shortest, then first."""
    rows = table(spark, d, "surface_form").where("concept_id IS NOT NULL AND form IS NOT NULL")
    counts = rows.groupBy("concept_id", "form").agg(F.sum(F.coalesce("count", F.lit(0))).alias("count"))
    return counts.groupBy("concept_id").agg(resolve.canonical().alias("canonical"))


# --- rules ------------------------------------------------------------------------------

RULES = resolve.Rules(
    exact={
        "orthography": {"fine tuning": "fine-tuning", "load testing": "load-testing"},
        "alias": {"taq": "tabular querying", "nlp": "natural language processing"},
        "vendor_prefix": {"apache spark": "spark"},
    },
    suffixes=frozenset({"tools", "suite", "platform", "software", "skills"}), protected=frozenset({"data tools"}),
    blocked_results=frozenset({"advanced", "internal"}), blocked_endings=("-driven", "-based"), version="rules-1",
)


_RULE_ROWS = [(kind, source, target) for kind, rules in RULES.exact.items() for source, target in rules.items()]
_RULE_SQL = f"""rules(kind, source, target) AS (VALUES {', '.join(f"('{k}', '{a}', '{b}')" for k, a, b in _RULE_ROWS)}),
start AS (SELECT DISTINCT {m.sql_trim('lower(form)')} AS form FROM {_RAW}),
steps AS (
  SELECT form, form AS now, '' AS trail, 0 AS n FROM start WHERE form NOT IN ({', '.join(f"'{x}'" for x in sorted(RULES.protected))})
  UNION ALL SELECT form, CASE WHEN target IS NOT NULL THEN target ELSE rest END, trail || CASE WHEN trail = '' THEN '' ELSE '+' END || coalesce(kind, 'empty_suffix:' || last), n + 1
  FROM (SELECT s.*, r.target, r.kind, array_to_string(w[1:len(w) - 1], ' ') AS rest, w[-1] AS last, len(w) AS size FROM (SELECT *, list_filter(regexp_split_to_array(now, '{m.SQL_WS}+'), lambda x: x <> '') AS w FROM steps) s LEFT JOIN rules r ON r.source = s.now)
  WHERE now NOT IN ({', '.join(f"'{x}'" for x in sorted(RULES.protected))}) AND n < 10 AND (target IS NOT NULL OR (size >= 2 AND last IN ({', '.join(f"'{x}'" for x in sorted(RULES.suffixes))})
    AND rest NOT IN ({', '.join(f"'{x}'" for x in sorted(RULES.blocked_results))}) AND {' AND '.join(f"NOT ends_with(rest, '{x}')" for x in RULES.blocked_endings)}))
)"""


@query(f"""WITH RECURSIVE {_RULE_SQL}
SELECT form, arg_max(now, n) AS normalised_form, CASE WHEN max(n) = 0 THEN 'unchanged' ELSE arg_max(trail, n) END AS method, 'rules-1' AS config_version FROM steps GROUP BY form
UNION ALL SELECT form, form, 'protected', 'rules-1' FROM start WHERE form NOT IN (SELECT form FROM steps)""")
def rule_engine_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Rules to their rest, with the trail as method."""
    return resolve.normalised(_raw(spark, d).withColumn("form", text.join_key(F.col("form"))).distinct(), "form", RULES)


@query(f"""WITH w AS (SELECT form, list_filter(regexp_split_to_array(form, '{m.SQL_WS}+'), lambda x: x <> '') AS t FROM (SELECT DISTINCT {m.sql_trim('lower(form)')} AS form FROM {_RAW})),
r AS (SELECT form, t, array_to_string(t[1:len(t) - 1], ' ') AS rest FROM w)
SELECT form, CASE WHEN len(t) >= 2 AND list_contains(['tools', 'suite', 'platform', 'software', 'skills'], t[-1]) AND rest NOT IN ('advanced', 'internal') AND NOT ends_with(rest, '-driven') AND NOT ends_with(rest, '-based') THEN rest ELSE form END AS stripped FROM r""")
def suffix_guard(spark: SparkSession, d: str) -> DataFrame:
    """One guarded suffix step."""
    forms = _raw(spark, d).select(text.join_key(F.col("form")).alias("form")).distinct()
    return forms.withColumn("stripped", resolve.suffix_stripped(F.col("form"), RULES))


@query("SELECT raw_skill AS source, count(DISTINCT canonical_skill) AS targets FROM norm_map WHERE raw_skill IS NOT NULL AND canonical_skill IS NOT NULL GROUP BY raw_skill HAVING count(DISTINCT canonical_skill) > 1")
def rule_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Sources with more than one target."""
    rows = table(spark, d, "norm_map").where("raw_skill IS NOT NULL AND canonical_skill IS NOT NULL")
    return resolve.rule_conflicts(rows.select(F.col("raw_skill").alias("source"), F.col("canonical_skill").alias("target")))


# --- families ---------------------------------------------------------------------------

_COUNTS = f"c AS (SELECT {m.sql_trim('lower(raw_skill)')} AS form, count(*) AS \"count\" FROM norm_map WHERE raw_skill IS NOT NULL GROUP BY 1)"
_FAMILY_A = f"""k AS (SELECT form, "count", array_to_string({m.sql_tokens('form')}, ' ') AS key FROM c),
ha AS (SELECT key, arg_min(form, struct_pack(a := -"count", b := length(form), d := form)) AS canonical FROM k GROUP BY key HAVING count(*) > 1),
fa AS (SELECT form, canonical FROM k JOIN ha USING (key))"""
_FAMILY_B = """g AS (
  SELECT form AS singular, unnest(list_filter([form || 's', CASE WHEN regexp_matches(form, '(s|x|z|ch|sh)$') THEN form || 'es' END, CASE WHEN regexp_matches(form, '[^aeiou ]y$') THEN regexp_replace(form, 'y$', 'ies') END], lambda x: x IS NOT NULL)) AS plural FROM c
), e AS (SELECT DISTINCT singular, plural FROM g WHERE plural IN (SELECT form FROM c)),
l AS (SELECT singular AS x, plural AS y FROM e UNION SELECT plural, singular FROM e),
w AS (SELECT x AS node, x AS comp FROM l UNION SELECT l.y, w.comp FROM w JOIN l ON l.x = w.node),
cc AS (SELECT node, min(comp) AS comp FROM w GROUP BY node),
hb AS (SELECT comp, arg_min(form, struct_pack(a := -"count", b := length(form), d := form)) AS canonical FROM cc JOIN c ON c.form = cc.node GROUP BY comp),
fb AS (SELECT node AS form, canonical FROM cc JOIN hb USING (comp))"""


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return resolve.form_counts(table(spark, d, "norm_map"), text.join_key(F.col("raw_skill")))


@query(f"WITH {_COUNTS}, {_FAMILY_A} SELECT * FROM fa")
def rule_a_families(spark: SparkSession, d: str) -> DataFrame:
    """Forms of one token set."""
    return resolve.token_set_families(_counts(spark, d))


@query(f"WITH RECURSIVE {_COUNTS}, {_FAMILY_B} SELECT * FROM e")
def plural_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Singular and plural where both occur."""
    return resolve.plural_edges(_counts(spark, d))


@query(f"WITH RECURSIVE {_COUNTS}, {_FAMILY_B} SELECT * FROM fb")
def rule_b_families(spark: SparkSession, d: str) -> DataFrame:
    """Chained plurals."""
    return resolve.plural_families(written(_counts(spark, d), "counts"))


@query(f"""WITH RECURSIVE {_COUNTS}, {_FAMILY_A}, {_FAMILY_B}
SELECT fb.form, coalesce(fa.canonical, fb.canonical) AS canonical FROM fb LEFT JOIN fa ON fa.form = fb.canonical UNION ALL SELECT form, canonical FROM fa WHERE form NOT IN (SELECT form FROM fb)""")
def compose_rules(spark: SparkSession, d: str) -> DataFrame:
    """Plurals first, then token sets."""
    counts = written(_counts(spark, d), "counts")
    return resolve.composed(resolve.plural_families(counts), resolve.token_set_families(counts))


def _sql_common(a: str, b: str) -> str:
    """Length of the longest common subsequence of two texts of up to 60 letters, bit by bit."""
    places = f"list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substring({a}, i::INT, 1) = c THEN 1::BIGINT << (i - 1)::INT ELSE 0::BIGINT END)"
    masks = f"list_transform(string_split({b}, ''), lambda c: coalesce(list_sum({places}), 0)::BIGINT)"
    full = f"((1::BIGINT << length({a})::INT) - 1)"
    row = f"list_reduce(list_prepend({full}, {masks}), lambda r, h: ((r + (r & h)) | (r - (r & h))) & {full})"
    return f"(length({a}) - bit_count({row}))"


_FUZZY = f"""{_COUNTS}, k AS (SELECT form, string_split(form, ' ')[1] AS first, list_sort(list_distinct(list_filter(regexp_split_to_array(form, '\\s+'), lambda w: w <> ''))) AS t FROM c WHERE "count" >= 2 AND length(form) <= 60),
pr AS (SELECT a.form AS a, b.form AS b, list_sort(list_intersect(a.t, b.t)) AS bth, list_sort(list_filter(a.t, lambda w: NOT list_contains(b.t, w))) AS l, list_sort(list_filter(b.t, lambda w: NOT list_contains(a.t, w))) AS r FROM k a JOIN k b ON a.first = b.first AND a.form < b.form WHERE len(a.t) > 0 AND len(b.t) > 0),
tx AS (SELECT a, b, len(bth) > 0 AND (len(l) = 0 OR len(r) = 0) AS inside, array_to_string(bth, ' ') AS base, array_to_string(list_concat(bth, l), ' ') AS one, array_to_string(list_concat(bth, r), ' ') AS two FROM pr),
sc AS (SELECT a, b, CASE WHEN inside THEN 100.0::DOUBLE ELSE greatest(200.0::DOUBLE * {_sql_common('one', 'two')} / (length(one) + length(two)), CASE WHEN base = '' THEN 0 ELSE 200.0::DOUBLE * length(base) / (length(base) + length(one)) END,
  CASE WHEN base = '' THEN 0 ELSE 200.0::DOUBLE * length(base) / (length(base) + length(two)) END) END AS score FROM tx),
fz AS (SELECT * FROM sc WHERE score >= 88),
fl AS (SELECT a AS x, b AS y FROM fz UNION SELECT b, a FROM fz), fw AS (SELECT x AS node, x AS comp FROM fl UNION SELECT fl.y, fw.comp FROM fw JOIN fl ON fl.x = fw.node),
fc AS (SELECT node, min(comp) AS component FROM fw GROUP BY node)"""


@query(f"WITH RECURSIVE {_FUZZY} SELECT * FROM fz")
def fuzzy_pairs_first_word(spark: SparkSession, d: str) -> DataFrame:
    """Alike forms with the same first word."""
    return resolve.first_word_pairs(_counts(spark, d))


@query(f"WITH RECURSIVE {_FUZZY} SELECT component, count(*) AS size, CAST(sum(c.\"count\") AS BIGINT) AS mentions FROM fc JOIN c ON c.form = fc.node GROUP BY component")
def fuzzy_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of alike forms."""
    from corpusloom.operators.components import components

    counts = written(_counts(spark, d), "counts")
    groups = components(resolve.first_word_pairs(counts), "a", "b")
    return groups.join(counts, groups["node"] == counts["form"]).groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum("count").alias("mentions"))


@query(f"""WITH RECURSIVE {_FUZZY}, rw AS (SELECT occupation, {m.sql_trim('lower(raw_skill)')} AS node FROM norm_map WHERE raw_skill IS NOT NULL AND occupation IS NOT NULL),
sh AS (SELECT node, max(n / total) AS share FROM (SELECT occupation, node, count(*) AS n, sum(count(*)) OVER (PARTITION BY occupation) AS total FROM rw GROUP BY occupation, node) GROUP BY node)
SELECT component, max(share)::DOUBLE AS share, count(*) AS size FROM fc JOIN sh USING (node) GROUP BY component HAVING max(share) >= 0.05""")
def review_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters with a member that 5 % of the rows of an occupation hold."""
    from corpusloom.operators.components import components

    counts = written(_counts(spark, d), "counts")
    groups = components(resolve.first_word_pairs(counts), "a", "b")
    rows = table(spark, d, "norm_map").where("raw_skill IS NOT NULL AND occupation IS NOT NULL").select("occupation", text.join_key(F.col("raw_skill")).alias("node"))
    total = rows.groupBy("occupation").agg(F.count(F.lit(1)).alias("n"))
    share = rows.groupBy("occupation", "node").agg(F.count(F.lit(1)).alias("c")).join(total, "occupation").groupBy("node").agg(F.max(F.col("c") / F.col("n")).alias("share"))
    return groups.join(share, "node").groupBy("component").agg(F.max("share").alias("share"), F.count(F.lit(1)).alias("size")).where("share >= 0.05")


@query("""SELECT form, coalesce(arg_min(v, p), 'none') AS value FROM (SELECT f.form, p.v, p.p FROM (SELECT canonical_skill AS form FROM skill_list) f
LEFT JOIN (SELECT canonical_skill AS k, CASE WHEN length(canonical_skill) % 2 = 0 THEN 'even' ELSE 'odd' END AS v, 1 AS p FROM skill_list WHERE length(canonical_skill) < 20 UNION ALL SELECT canonical_skill, 'short', 0 FROM skill_list WHERE length(canonical_skill) < 10) p ON lower(p.k) = lower(f.form)) GROUP BY form""")
def facet_pattern_match(spark: SparkSession, d: str) -> DataFrame:
    """Exclusive facet by whole-string patterns and precedence."""
    n = F.length("canonical_skill")
    skills = table(spark, d, "skill_list")
    parity = skills.where(n < 20).select(F.col("canonical_skill").alias("pattern"), F.when(n % 2 == 0, "even").otherwise("odd").alias("value"), F.lit(1).alias("precedence"))
    short = skills.where(n < 10).select(F.col("canonical_skill").alias("pattern"), F.lit("short").alias("value"), F.lit(0).alias("precedence"))
    return govern.facet_matches(_skills(spark, d), parity.unionByName(short), "none")


# --- quality of texts -------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE length(text) >= 200")
def ad_prefilter_short(spark: SparkSession, d: str) -> DataFrame:
    """Texts of 200 characters or more."""
    return duplicates.long_enough(table(spark, d, "documents"), "text").select("doc_id")


@query(f"SELECT doc_id, min(doc_id) OVER (PARTITION BY {m.sql_flat('text')}) AS class_id FROM documents WHERE text IS NOT NULL")
def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Classes of exact copies."""
    return duplicates.exact_classes(table(spark, d, "documents"), "doc_id", "text")


_NEAR = f"""w AS (SELECT doc_id, flat, list_filter(string_split(regexp_replace(flat, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM (SELECT doc_id, {m.sql_flat('text')} AS flat FROM documents WHERE text IS NOT NULL)),
head AS (SELECT flat, min(doc_id) AS d FROM w GROUP BY flat),
s AS (SELECT doc_id AS d, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w WHERE len(w) > 0 AND doc_id IN (SELECT d FROM head)),
e AS (SELECT d, len(s) AS n, unnest(s) AS h FROM s),
l AS (SELECT a.d AS x, b.d AS y FROM e a JOIN e b ON a.h = b.h AND a.d <> b.d GROUP BY a.d, b.d, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
r AS (SELECT d AS node, d AS comp FROM head UNION SELECT l.y, r.comp FROM r JOIN l ON l.x = r.node),
cc AS (SELECT node, min(comp) AS comp FROM r GROUP BY node)"""


@query(f"WITH RECURSIVE {_NEAR} SELECT doc_id, cc.comp AS class_id FROM w JOIN head USING (flat) JOIN cc ON cc.node = head.d")
def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Classes of near copies, five words, similarity 0.8."""
    return duplicates.near_classes(table(spark, d, "documents"), "doc_id", "text")


@query("""WITH g AS (SELECT concept_id, count(*) AS size FROM surface_form WHERE concept_id IS NOT NULL GROUP BY concept_id) SELECT size, count(*) AS groups FROM g GROUP BY size""")
def group_size_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of concepts."""
    return ranking.size_histogram(table(spark, d, "surface_form").where("concept_id IS NOT NULL"), "concept_id")
