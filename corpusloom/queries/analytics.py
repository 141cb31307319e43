"""Queries of the statistics: penetration, change, adjacency, graph, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import join_key
from corpusloom.operators import adjacency, cells, ranking
from corpusloom.queries import domain as m
from corpusloom.queries.registry import query
from corpusloom.runtime import written
from corpusloom.sources.tables import table

CELL = cells.CELL


@query(f"WITH {m.SQL_POSTING} SELECT * FROM ads")
def posting_denominator(spark: SparkSession, d: str) -> DataFrame:
    """A1: ads of every cell."""
    return m.ads(spark, d)


@query(f"WITH {m.SQL_POSTING} SELECT year, occupation, count(*) AS n_ads FROM posting_d WHERE coalesce(status, 'ok') = 'ok' GROUP BY ALL")
def posting_denominator_ok_only(spark: SparkSession, d: str) -> DataFrame:
    """Ads whose extraction was ok."""
    return cells.ad_counts(m.posting(spark, d), ok_only=True)


@query(f"WITH {m.SQL_POSTING}, scope AS (SELECT year, occupation FROM ads WHERE n_ads >= 100) SELECT p.year, p.occupation, p.posting_id FROM posting_d p JOIN scope USING (year, occupation)")
def scope_filter(spark: SparkSession, d: str) -> DataFrame:
    """Ads of the cells in scope."""
    scope = m.ads(spark, d).where(F.col("n_ads") >= 100)
    return cells.in_scope(m.posting(spark, d), scope).select(*CELL, "posting_id")


@query(f"WITH {m.SQL_FACTS} SELECT year, occupation, posting_id, concept_id, n_mentions, concept_label, concept_type, primary_category, held FROM facts")
def posting_skill(spark: SparkSession, d: str) -> DataFrame:
    """The fact table."""
    return m.facts(spark, d).select(*CELL, "posting_id", "concept_id", "n_mentions", "concept_label", "concept_type", "primary_category", "held")


@query("""
WITH r AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS occupation, o_orderkey AS posting_id, p_brand AS concept_id,
    CASE l_returnflag WHEN 'A' THEN 'required' WHEN 'N' THEN 'preferred' ELSE 'unclear' END AS requirement
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
), k AS (SELECT *, CASE requirement WHEN 'required' THEN 3 WHEN 'preferred' THEN 2 ELSE 1 END AS rk FROM r)
SELECT year, occupation, posting_id, concept_id, count(*) AS n_mentions, arg_max(requirement, rk) AS requirement FROM k GROUP BY year, occupation, posting_id, concept_id
""")
def posting_skill_requirement_max(spark: SparkSession, d: str) -> DataFrame:
    """A2: strongest requirement per posting and concept."""
    lines, orders, parts = (table(spark, d, t) for t in ("lineitem", "orders", "part"))
    rows = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(parts, lines["l_partkey"] == parts["p_partkey"])
        .select(
            F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderpriority").alias("occupation"), F.col("o_orderkey").alias("posting_id"),
            F.col("p_brand").alias("concept_id"), F.when(F.col("l_returnflag") == "A", "required").when(F.col("l_returnflag") == "N", "preferred").otherwise("unclear").alias("requirement"),
        )
    )
    return cells.posting_concepts(rows, "requirement")


def _bridge(spark: SparkSession, d: str) -> DataFrame:
    skills = table(spark, d, "skill_list")
    names = skills.select(join_key(F.col("canonical_skill")).alias("key"), F.col("canonical_skill").alias("concept_id"))
    others = skills.select("canonical_skill", F.explode("other_names").alias("name"))
    aliases = others.select(join_key(F.col("name")).alias("key"), F.col("canonical_skill").alias("concept_id"))
    return cells.bridge_with_aliases(names, aliases)


def _matched(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "norm_map").where("raw_skill IS NOT NULL AND occupation IS NOT NULL").select("occupation", F.col("raw_skill").alias("form"))
    return cells.matched_mentions(rows, _bridge(spark, d))


_BRIDGE = f"""
names AS (SELECT {m.sql_trim('lower(canonical_skill)')} AS key, canonical_skill AS concept_id FROM skill_list),
alias AS (SELECT {m.sql_trim('lower(a)')} AS key, canonical_skill AS concept_id FROM (SELECT canonical_skill, unnest(other_names) AS a FROM skill_list)),
bridge AS (SELECT * FROM names UNION ALL SELECT * FROM alias WHERE key NOT IN (SELECT key FROM names)),
hit AS (
  SELECT r.occupation, r.key, b.concept_id
  FROM (SELECT occupation, {m.sql_trim('lower(raw_skill)')} AS key FROM norm_map WHERE raw_skill IS NOT NULL AND occupation IS NOT NULL) r LEFT JOIN bridge b USING (key)
)"""


@query(f"WITH {_BRIDGE} SELECT * FROM bridge")
def bridge_alias_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Names, and aliases where no name stands."""
    return _bridge(spark, d)


@query(f"WITH {_BRIDGE} SELECT occupation, count(*) AS mentions, count(concept_id) AS matched, round(100.0::DOUBLE * count(concept_id) / count(*), 2) AS coverage_pct FROM hit GROUP BY occupation")
def bridge_coverage(spark: SparkSession, d: str) -> DataFrame:
    """A3: matched mentions per occupation."""
    return cells.coverage(_matched(spark, d), ["occupation"])


@query(f"""
WITH {_BRIDGE}, c AS (SELECT occupation, key, count(*) AS n FROM hit WHERE concept_id IS NULL GROUP BY occupation, key)
SELECT occupation, key, n, CAST(r AS INTEGER) AS "rank" FROM (SELECT *, row_number() OVER (PARTITION BY occupation ORDER BY n DESC, key) AS r FROM c) WHERE r <= 15
""")
def top_unmatched_per_cell(spark: SparkSession, d: str) -> DataFrame:
    """A3: the most frequent forms without a concept."""
    return cells.top_unmatched(_matched(spark, d), ["occupation"])


def _grain(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        facets = m.facets(spark, d) if name == "facet" else None
        return cells.penetration(m.facts(spark, d), m.ads(spark, d), facets, (name,))

    run.__name__ = f"penetration_{name}"
    run.__doc__ = f"A4, A5, A6: penetration at the {name} grain."
    return query(f"WITH {m.SQL_RATES} SELECT * FROM rates WHERE grain = '{name}'")(run)


for _name in ("concept", "category", "type", "facet"):
    _grain(_name)


@query(f"WITH {m.SQL_RATES} SELECT * FROM rates")
def penetration_all_grains(spark: SparkSession, d: str) -> DataFrame:
    """Penetration at all grains."""
    return m.rates(spark, d)


@query(f"WITH {m.SQL_CHANGES} SELECT * FROM changes")
def change_test(spark: SparkSession, d: str) -> DataFrame:
    """Two-proportion tests between the years."""
    return m.changes(spark, d)


def _view(key: str, denominator: str) -> str:
    return f"""
WITH {m.SQL_FACTS}, t AS (SELECT year, occupation, count(DISTINCT posting_id) AS n_total FROM {denominator} GROUP BY year, occupation),
h AS (SELECT year, occupation, {key}, count(DISTINCT posting_id) AS n_ads FROM facts WHERE {key} <> '' GROUP BY ALL)
SELECT year, occupation, {key}, n_ads, n_total, round(1.0::DOUBLE * n_ads / n_total, 4) AS rate FROM h JOIN t USING (year, occupation)"""


@query(_view("concept_id", "mentions"))
def view_penetration_normed(spark: SparkSession, d: str) -> DataFrame:
    """Store view; ads without a mention don't count."""
    return cells.view_rates(m.facts(spark, d), m.mentions(spark, d), "concept_id")


@query(_view("primary_category", "mentions"))
def view_penetration_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups over the normed denominator."""
    return cells.view_rates(m.facts(spark, d).where(F.col("primary_category") != ""), m.mentions(spark, d), "primary_category")


@query("""
WITH r AS (SELECT occupation, map_id, raw_skill FROM norm_map WHERE raw_skill IS NOT NULL AND occupation IS NOT NULL),
t AS (SELECT occupation, count(DISTINCT map_id) AS n_total FROM r GROUP BY occupation), h AS (SELECT occupation, raw_skill, count(DISTINCT map_id) AS n_ads FROM r GROUP BY ALL)
SELECT 'all' AS year, occupation, raw_skill, n_ads, n_total, round(1.0::DOUBLE * n_ads / n_total, 4) AS rate FROM h JOIN t USING (occupation)
""")
def view_penetration_raw(spark: SparkSession, d: str) -> DataFrame:
    """Store view of raw forms."""
    rows = table(spark, d, "norm_map").where("raw_skill IS NOT NULL AND occupation IS NOT NULL").select(
        F.lit("all").alias("year"), "occupation", F.col("map_id").alias("posting_id"), "raw_skill"
    )
    return cells.view_rates(rows, rows, "raw_skill")


@query(f"WITH {m.SQL_FACTS} SELECT year, occupation, posting_id, string_agg(c, '|' ORDER BY c) AS groups FROM (SELECT DISTINCT year, occupation, posting_id, primary_category AS c FROM facts WHERE primary_category <> '') GROUP BY ALL")
def posting_groups(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct groups of every ad."""
    rows = m.facts(spark, d).where(F.col("primary_category") != "")
    return rows.groupBy(*CELL, "posting_id").agg(F.array_join(F.array_sort(F.collect_set("primary_category")), "|").alias("groups"))


_STATS_COLUMNS = "year, occupation, concept_a, concept_b, count_ab, count_a, count_b, n_ads"


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT {_STATS_COLUMNS} FROM edges")
def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    """All pairs with their counts."""
    return adjacency.joint_counts(m.countable(spark, d), m.ads(spark, d), prune=False)


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT {_STATS_COLUMNS}, support_a, support_b, support_ab, conf_ab, conf_ba, lift, geo_mean_conf FROM edges")
def adjacency_stats(spark: SparkSession, d: str) -> DataFrame:
    """A10: support, confidence, lift of all pairs."""
    return adjacency.measured(adjacency.joint_counts(m.countable(spark, d), m.ads(spark, d), prune=False)).drop("_lift", "_geo")


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT * FROM flagged")
def adjacency_flags(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that pass a floor, all pairs made first."""
    return m.edges(spark, d, prune=False)


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT * FROM flagged")
def adjacency_apriori(spark: SparkSession, d: str) -> DataFrame:
    """The same, rare concepts left out before pairs are made."""
    return m.edges(spark, d)


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT * FROM nodes")
def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Population of the graph."""
    return adjacency.graph_nodes(m.countable(spark, d), m.ads(spark, d), m.TARGET)


def _graph(spark: SparkSession, d: str, facts: DataFrame | None = None, ads: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the graph, from the facts of its year."""
    facts, ads = facts or m.kept_facts(spark, d, m.TARGET), ads or m.kept_ads(spark, d)
    nodes = adjacency.graph_nodes(adjacency.countable(facts), ads, m.TARGET)
    return nodes.select("occupation", "concept_id"), m.edges(spark, d, True, facts, ads).where(F.col("passes_graph") == 1)


_DEGREE = f"""WITH {m.SQL_FACTS}{m.SQL_EDGES},
ends AS (SELECT occupation, concept_a AS c, concept_b AS o FROM graph UNION ALL SELECT occupation, concept_b, concept_a FROM graph),
deg AS (SELECT occupation, c AS concept_id, count(*) AS degree FROM ends GROUP BY ALL)
"""


@query(_DEGREE + "SELECT n.occupation, n.concept_id, coalesce(d.degree, 0) AS degree FROM nodes n LEFT JOIN deg d USING (occupation, concept_id)")
def graph_degree(spark: SparkSession, d: str) -> DataFrame:
    """Edges at each node."""
    nodes, edges = _graph(spark, d)
    return adjacency.degrees(nodes, edges, ["occupation"])


@query(f"""WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT year, occupation, source, string_agg(target, '|' ORDER BY target) AS neighbours FROM (
  SELECT year, occupation, concept_a AS source, concept_b AS target FROM flagged WHERE passes_analysis = 1
  UNION ALL SELECT year, occupation, concept_b, concept_a FROM flagged WHERE passes_analysis = 1) GROUP BY ALL""")
def neighbour_index(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of every concept."""
    links = adjacency.both_ways(m.edges(spark, d).where("passes_analysis = 1"), "concept_a", "concept_b", *CELL)
    return links.groupBy(*CELL, "source").agg(F.array_join(F.array_sort(F.collect_list("target")), "|").alias("neighbours"))


_EXPORT = f"""WITH {m.SQL_RATES}{m.SQL_EDGES},
ends AS (SELECT occupation, concept_a AS c, concept_b AS o FROM graph UNION ALL SELECT occupation, concept_b, concept_a FROM graph),
deg AS (SELECT occupation, c AS concept_id, count(*) AS degree FROM ends GROUP BY ALL),
every AS (SELECT occupation, concept_id FROM nodes UNION SELECT occupation, c FROM ends),
rel AS (SELECT concept_id, min(CASE WHEN facet_id = 'relatedness' THEN value END) AS relatedness, string_agg(CASE WHEN facet_id = 'wave' THEN value END, '|') AS wave FROM facets WHERE value <> 'none' GROUP BY concept_id),
out AS (
  SELECT e.occupation, e.concept_id, coalesce(d.concept_label, '') AS label, coalesce(d.concept_type, '') AS type, coalesce(d.primary_category, '') AS category,
    coalesce(rel.relatedness, 'ai_independent') AS relatedness, coalesce(rel.wave, '') AS wave, coalesce(r.hits, 0) AS "count",
    floor(coalesce(r.rate, 0.0::DOUBLE) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS penetration, floor(coalesce(r.wilson_low, 0.0::DOUBLE) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS ci_low, floor(coalesce(r.wilson_high, 0.0::DOUBLE) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS ci_high, coalesce(deg.degree, 0) AS degree
  FROM every e LEFT JOIN dims d USING (concept_id) LEFT JOIN rel USING (concept_id) LEFT JOIN deg USING (occupation, concept_id)
  LEFT JOIN (SELECT * FROM rates WHERE grain = 'concept' AND year = '{m.TARGET}') r ON r.occupation = e.occupation AND r.key = e.concept_id
)
"""


@query(_EXPORT + "SELECT * FROM out")
def graph_export_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Node rows of the export."""
    facts, ads = m.kept_facts(spark, d, m.TARGET), m.kept_ads(spark, d)
    concept_rates = m.rates(spark, d, ("concept",), facts, ads)
    nodes, edges = _graph(spark, d, facts, ads)
    return adjacency.export_nodes(nodes, written(edges, "edges"), m.dims(spark, d), m.facets(spark, d), concept_rates)


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT occupation, concept_a AS source, concept_b AS target, geo_mean_conf AS weight, lift FROM graph")
def graph_export_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edge rows of the export."""
    return adjacency.export_edges(m.graph_edges(spark, d))


@query(f"WITH {m.SQL_FACTS}{m.SQL_EDGES} SELECT n.occupation, n.nodes, coalesce(e.edges, 0) AS edges FROM (SELECT occupation, count(*) AS nodes FROM nodes GROUP BY occupation) n LEFT JOIN (SELECT occupation, count(*) AS edges FROM graph GROUP BY occupation) e USING (occupation)")
def graph_index(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges per occupation."""
    return adjacency.export_index(*_graph(spark, d))


#: A looser test than the default, so that the small tables have cases.
LOOSE_Z = 0.674489750196082


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    facts, ads = m.kept_facts(spark, d), m.kept_ads(spark, d)
    changes, edges = m.changes(spark, d, ("concept",), facts, ads), m.edges(spark, d, True, facts, ads)
    return adjacency.replacement_anchors(written(changes, "changes"), written(edges, "edges"), m.BASE, m.TARGET, None, 0.10, LOOSE_Z)


_ANCHORS = m.SQL_CHANGES + m.SQL_EDGES + f""",
moved AS (SELECT * FROM changes WHERE grain = 'concept' AND abs(z) > {LOOSE_Z}::DOUBLE),
x AS (SELECT * FROM moved WHERE direction = 'down' AND rate_base >= 0.1::DOUBLE), y AS (SELECT * FROM moved WHERE direction = 'up' AND rate_target >= 0.1::DOUBLE),
tie AS (SELECT year, occupation, concept_a AS s, concept_b AS c, geo_mean_conf AS w FROM flagged WHERE passes_analysis = 1 UNION ALL SELECT year, occupation, concept_b, concept_a, geo_mean_conf FROM flagged WHERE passes_analysis = 1),
anchors AS (
  SELECT x.occupation, x.key AS x_key, y.key AS y_key, xb.c, xb.w AS xc_base, coalesce(xt.w, 0) AS xc_target, coalesce(yb.w, 0) AS yc_base, yt.w AS yc_target,
    round(x.rate_base - x.rate_target + y.rate_target - y.rate_base + yt.w - coalesce(yb.w, 0) + xb.w - coalesce(xt.w, 0), 4) AS score
  FROM x JOIN tie xb ON xb.occupation = x.occupation AND xb.s = x.key AND xb.year = '{m.BASE}'
  JOIN tie yt ON yt.occupation = x.occupation AND yt.c = xb.c AND yt.year = '{m.TARGET}' JOIN y ON y.occupation = x.occupation AND y.key = yt.s
  LEFT JOIN tie xt ON xt.occupation = x.occupation AND xt.s = x.key AND xt.c = xb.c AND xt.year = '{m.TARGET}'
  LEFT JOIN tie yb ON yb.occupation = x.occupation AND yb.s = y.key AND yb.c = xb.c AND yb.year = '{m.BASE}'
  WHERE x.key <> y.key AND xb.c <> x.key AND xb.c <> y.key AND coalesce(xt.w, 0) < xb.w AND yt.w > coalesce(yb.w, 0)
), candidates AS (
  SELECT occupation, x_key, y_key, count(*) AS n_anchors, max(score) AS best_score, array_to_string(list_slice(list(c ORDER BY score DESC, c), 1, 3), '; ') AS top_anchors FROM anchors GROUP BY ALL
)
"""


@query(f"WITH {_ANCHORS} SELECT occupation, x_key, y_key, c, xc_base, xc_target, yc_base, yc_target, score FROM anchors")
def replacement_anchors(spark: SparkSession, d: str) -> DataFrame:
    """X that fell, Y that rose, around C."""
    return _anchors(spark, d).select("occupation", "x_key", "y_key", "c", "xc_base", "xc_target", "yc_base", "yc_target", "score")


@query(f"WITH {_ANCHORS} SELECT * FROM candidates")
def replacement_candidates(spark: SparkSession, d: str) -> DataFrame:
    """One row per X and Y."""
    return adjacency.replacement_candidates(written(_anchors(spark, d), "anchors"))


@query(f"WITH {_ANCHORS} SELECT * FROM candidates ORDER BY n_anchors DESC, best_score DESC, occupation, x_key, y_key LIMIT 12")
def replacement_top12(spark: SparkSession, d: str) -> DataFrame:
    """The twelve with most anchors."""
    return replacement_candidates(spark, d).orderBy(F.desc("n_anchors"), F.desc("best_score"), "occupation", "x_key", "y_key").limit(12)


@query(f"""WITH {m.SQL_RATES}, r AS (SELECT year, occupation, key, rate, row_number() OVER (PARTITION BY year, occupation ORDER BY rate DESC, key) AS k FROM rates WHERE grain = 'concept')
SELECT year, occupation, key, rate, CAST(k AS INTEGER) AS "rank" FROM r WHERE k <= 10""")
def top_concepts_per_occ(spark: SparkSession, d: str) -> DataFrame:
    """Ten concepts of highest rate per cell."""
    rows = m.rates(spark, d, ("concept",)).select(*CELL, "key", "rate")
    return ranking.top_rows(rows, CELL, 10, F.desc("rate"), "key")


@query(f"""WITH {m.SQL_CHANGES}, r AS (SELECT *, row_number() OVER (PARTITION BY occupation ORDER BY abs(diff) DESC, key) AS k FROM changes WHERE grain = 'category' AND diff IS NOT NULL)
SELECT occupation, key, diff, z, significant, CAST(k AS INTEGER) AS "rank" FROM r WHERE k <= 10""")
def top_changes_per_occ(spark: SparkSession, d: str) -> DataFrame:
    """Ten strongest category changes per occupation."""
    rows = m.changes(spark, d, ("category",)).where((F.col("grain") == "category") & F.col("diff").isNotNull()).select("occupation", "key", "diff", "z", "significant")
    return ranking.top_rows(rows, ["occupation"], 10, F.desc(F.abs("diff")), "key")


@query(f"""WITH {m.SQL_CHANGES}, r AS (
  SELECT *, row_number() OVER (PARTITION BY occupation, direction ORDER BY abs(diff) DESC, key) AS k FROM changes WHERE grain = 'concept' AND greatest(rate_base, rate_target) >= 0.1::DOUBLE AND direction <> 'flat')
SELECT occupation, direction, key, diff, CAST(k AS INTEGER) AS "rank" FROM r WHERE k <= 6""")
def top_movers(spark: SparkSession, d: str) -> DataFrame:
    """Six fallers and six risers per occupation."""
    return ranking.movers(m.changes(spark, d, ("concept",)), ["occupation"], 6).select("occupation", "direction", "key", "diff", "rank")


@query(f"""WITH {m.SQL_CHANGES} SELECT occupation, key, rate_base, rate_target, diff, CASE WHEN diff >= 0.03::DOUBLE THEN 'up' WHEN diff <= -0.03::DOUBLE THEN 'down' ELSE 'level' END AS arrow
FROM changes WHERE grain = 'concept' AND greatest(rate_base, rate_target) >= 0.04::DOUBLE""")
def risers_fallers(spark: SparkSession, d: str) -> DataFrame:
    """Concepts worth showing, with an arrow."""
    return ranking.arrows(m.changes(spark, d, ("concept",))).select("occupation", "key", "rate_base", "rate_target", "diff", "arrow")


_MATRIX = ["data_generalist", "forecast_engineer", "records_analyst"]


@query(f"""WITH {m.SQL_RATES} SELECT key, {', '.join(f"coalesce(max(CASE WHEN occupation = '{o}' THEN round(100.0::DOUBLE * rate, 1) END), 0.0::DOUBLE) AS {o}" for o in _MATRIX)}
FROM rates WHERE grain = 'category' AND year = '{m.TARGET}' GROUP BY key""")
def category_matrix_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Categories against occupations."""
    rows = m.rates(spark, d, ("category",)).where(F.col("year") == m.TARGET)
    return ranking.matrix(rows, "key", "occupation", "rate", _MATRIX)


@query(f"""WITH {m.SQL_RATES}, o AS (SELECT count(DISTINCT occupation) AS n FROM ads WHERE year = '{m.TARGET}'),
s AS (SELECT key, max(rate) AS high, min(rate) AS low0, count(DISTINCT occupation) AS present FROM rates WHERE grain = 'concept' AND year = '{m.TARGET}' GROUP BY key)
SELECT key, high, CASE WHEN present < n THEN 0.0::DOUBLE ELSE low0 END AS low, present, round(high - CASE WHEN present < n THEN 0.0::DOUBLE ELSE low0 END, 6) AS spread
FROM s, o WHERE present >= 5 ORDER BY spread DESC, key LIMIT 12""")
def spread_top12(spark: SparkSession, d: str) -> DataFrame:
    """Concepts that differ most between occupations."""
    rows = m.rates(spark, d, ("concept",)).where(F.col("year") == m.TARGET)
    groups = m.ads(spark, d).where(F.col("year") == m.TARGET).count()
    return ranking.spread(rows, "key", "occupation", "rate", groups, 5, 12)


@query(f"""WITH {m.SQL_RATES}, b AS (SELECT d.primary_category AS category, r.key AS label, max(r.rate) AS rate FROM rates r JOIN dims d ON d.concept_id = r.key WHERE r.grain = 'concept' AND d.primary_category <> '' GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY rate DESC, label DESC) AS n FROM b)
SELECT category, string_agg(label, ', ' ORDER BY n) AS top_labels FROM k WHERE n <= 5 GROUP BY category""")
def top5_labels_per_category(spark: SparkSession, d: str) -> DataFrame:
    """The five concepts of highest rate per category."""
    rows = m.rates(spark, d, ("concept",)).select(F.col("key").alias("concept_id"), "rate")
    named = rows.join(m.dims(spark, d), "concept_id").where(F.col("primary_category") != "").select(F.col("primary_category").alias("category"), F.col("concept_id").alias("label"), "rate")
    return ranking.top_labels(named, "category", "label", "rate", 5)


@query(f"""WITH {m.SQL_FACTS}, k AS (SELECT p.year, p.occupation, p.posting_id, coalesce(f.k, 0) AS k FROM posting_d p LEFT JOIN (SELECT year, occupation, posting_id, count(*) AS k FROM facts GROUP BY ALL) f USING (year, occupation, posting_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY year, occupation ORDER BY k) - 1 AS i, count(*) OVER (PARTITION BY year, occupation) AS n FROM k)
SELECT year, occupation, count(*) AS n_ads, round(sum(k) / count(*), 4) AS mean_skills, max(CASE WHEN i = n // 2 THEN k END) AS median_skills, max(k) AS max_skills, count_if(k = 0) AS zero_skill_ads FROM r GROUP BY year, occupation""")
def skills_per_record_stats(spark: SparkSession, d: str) -> DataFrame:
    """Skills per ad."""
    return cells.record_stats(m.facts(spark, d), m.posting(spark, d))


@query("SELECT canonical_skill, count(*) AS mentions FROM normed_occurrences WHERE canonical_skill IS NOT NULL GROUP BY canonical_skill ORDER BY mentions DESC, canonical_skill LIMIT 100")
def top_concepts(spark: SparkSession, d: str) -> DataFrame:
    """The hundred concepts most often named."""
    rows = table(spark, d, "normed_occurrences").where("canonical_skill IS NOT NULL").groupBy("canonical_skill").agg(F.count(F.lit(1)).alias("mentions"))
    return rows.orderBy(F.desc("mentions"), "canonical_skill").limit(100)
