"""Queries of the graph layer: roll-ups, closure, scatter, neighbours, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import components as g
from corpusloom.operators import resolve
from corpusloom.operators.joins import met_pairs
from corpusloom.queries import domain as m
from corpusloom.queries.registry import query
from corpusloom.runtime import written
from corpusloom.sources.tables import table

_FORMS = """forms AS (
  SELECT form, CAST(sum(n) AS BIGINT) AS "count" FROM (
    SELECT unnest(list_concat([canonical_skill], string_split(canonical_skill, ' '))) AS form, n
    FROM (SELECT canonical_skill, count(*) AS n FROM normed_occurrences WHERE canonical_skill IS NOT NULL GROUP BY canonical_skill)
  ) WHERE form <> '' GROUP BY form
)"""
_STOP, _HEADS = m.sql_list(m.STOPWORDS), m.sql_list(m.PARENT_STOP)


def _content(x: str) -> str:
    return f"list_filter({m.sql_tokens(x)}, lambda w: NOT list_contains({_STOP}, w))"


_PAIRS = f"""{_FORMS}, t AS (SELECT form, "count", {_content('form')} AS ct, {m.sql_tokens('form')} AS rt FROM forms),
x AS (SELECT DISTINCT form, unnest(ct) AS w FROM t),
near AS (SELECT DISTINCT a.form AS a, b.form AS b FROM x a JOIN x b ON a.w = b.w AND a.form < b.form),
j AS (
  SELECT a, b, ta.ct AS ca, tb.ct AS cb,
    CASE WHEN list_has_all(tb.ct, ta.ct) AND len(ta.ct) < len(tb.ct) THEN a WHEN list_has_all(ta.ct, tb.ct) AND len(tb.ct) < len(ta.ct) THEN b END AS parent,
    CASE WHEN list_has_all(tb.ct, ta.ct) AND len(ta.ct) < len(tb.ct) THEN b WHEN list_has_all(ta.ct, tb.ct) AND len(tb.ct) < len(ta.ct) THEN a END AS child
  FROM near JOIN t ta ON ta.form = a JOIN t tb ON tb.form = b
), judged AS (
  SELECT j.a, j.b, j.parent, j.child, p.count AS parent_mentions, coalesce(k.count, 0) AS child_mentions,
    CASE WHEN len(ca) = 0 OR len(cb) = 0 THEN 'empty content tokens' WHEN j.parent IS NULL THEN 'not a strict subset'
      WHEN list_has_all({_HEADS}, p.rt) THEN 'parent is all stoplist tokens' WHEN NOT list_has_all(k.rt, p.rt) THEN 'stopword-only subset -> related'
      WHEN p.count IS NULL THEN 'parent never occurs standalone' END AS reason
  FROM j LEFT JOIN t p ON p.form = j.parent LEFT JOIN t k ON k.form = j.child
), rollup AS (SELECT parent, child, parent_mentions, child_mentions FROM judged WHERE reason IS NULL)"""


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of forms that shares a word, with what speaks against it: a report on pairs, so it gives them all."""
    forms = written(m.skill_forms(spark, d), "forms")
    content = written(forms.select("form", F.explode(text.content_tokens(F.col("form"), m.STOPWORDS)).alias("w")), "content")
    near = met_pairs(content, "w", "form").distinct()
    return resolve.judged_edges(near, forms, m.STOPWORDS, m.PARENT_STOP)


def _rollup(spark: SparkSession, d: str) -> DataFrame:
    """Edges from the subset join: parent within child, rarest token first."""
    forms = written(m.skill_forms(spark, d), "forms")
    pairs = resolve.token_pairs(forms, m.STOPWORDS).withColumnsRenamed({"parent": "a", "child": "b"})
    return written(resolve.rollup_edges(resolve.judged_edges(pairs, forms, m.STOPWORDS, m.PARENT_STOP)), "rollup")


@query(f"WITH {_PAIRS} SELECT * FROM rollup")
def rollup_edges(spark: SparkSession, d: str) -> DataFrame:
    """parent's tokens within the child's."""
    return _rollup(spark, d)


@query(f"WITH {_PAIRS} SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason")
def rollup_reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why pairs are no edges."""
    return _judged(spark, d).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PAIRS} SELECT parent, child, parent_mentions, child_mentions FROM rollup WHERE len({m.sql_tokens('parent')}) = 1 AND len({m.sql_tokens('child')}) = 2 AND list_has_all({m.sql_tokens('child')}, {m.sql_tokens('parent')}) AND NOT list_contains({_HEADS}, parent)")
def obvious_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges that need no judgement."""
    return resolve.obvious_edges(_rollup(spark, d), m.PARENT_STOP)


_CLOSURE = _PAIRS + """, walk AS (SELECT parent AS ancestor, child AS descendant, 1 AS depth FROM rollup UNION SELECT w.ancestor, r.child, w.depth + 1 FROM walk w JOIN rollup r ON r.parent = w.descendant),
paths AS (SELECT ancestor, descendant, min(depth) AS depth FROM walk GROUP BY ALL)"""


@query(f"WITH RECURSIVE {_CLOSURE} SELECT ancestor, descendant, CAST(depth AS INTEGER) AS depth FROM paths")
def closure(spark: SparkSession, d: str) -> DataFrame:
    """Ancestors and descendants."""
    return g.closure(_rollup(spark, d))


@query(f"""WITH RECURSIVE {_CLOSURE}, kids AS (SELECT child, count(*) AS p FROM rollup GROUP BY child)
SELECT (SELECT count(DISTINCT parent) FROM rollup) AS parents, (SELECT count(*) FROM rollup) AS edges, count(*) AS children, round(avg(CASE WHEN p > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS multi_parent_rate,
(SELECT count(DISTINCT descendant) FROM paths WHERE depth > 2) AS deep_nodes FROM kids""")
def rollup_shape(spark: SparkSession, d: str) -> DataFrame:
    """Shape of the DAG, after its check for circles."""
    edges = _rollup(spark, d)
    return g.dag_shape(edges, g.closure(edges))


@query(f"""WITH RECURSIVE {m.SQL_FACTS}, {_CLOSURE}, mem AS (SELECT ancestor, descendant AS concept_id FROM paths UNION SELECT DISTINCT ancestor, ancestor FROM paths)
SELECT ancestor, count(DISTINCT posting_id) AS postings FROM mem JOIN facts USING (concept_id) GROUP BY ancestor""")
def closure_family_counts(spark: SparkSession, d: str) -> DataFrame:
    """Postings that name a family."""
    return g.family_counts(g.closure(_rollup(spark, d)), m.facts(spark, d).select("concept_id", "posting_id"))


_RESIDUAL = f"list_filter({m.sql_tokens('child')}, lambda w: NOT list_contains({m.sql_tokens('parent')}, w) AND NOT list_contains({_STOP}, w))"


@query(f"WITH {_PAIRS} SELECT parent, child, array_to_string({_RESIDUAL}, ' ') AS residual FROM rollup")
def residual_tokens(spark: SparkSession, d: str) -> DataFrame:
    """What the child adds."""
    return _rollup(spark, d).select("parent", "child", F.array_join(text.residual_tokens(F.col("parent"), F.col("child"), m.STOPWORDS), " ").alias("residual"))


_SCATTER = _PAIRS + f""", rt AS (SELECT parent, child, unnest({_RESIDUAL}) AS token FROM rollup),
link AS (SELECT DISTINCT x.parent, x.child AS c1, y.child AS c2 FROM rt x JOIN rt y ON x.parent = y.parent AND x.token = y.token),
reach AS (SELECT parent, child AS node, child AS comp FROM rollup UNION SELECT r.parent, l.c2, r.comp FROM reach r JOIN link l ON l.parent = r.parent AND l.c1 = r.node),
lab AS (SELECT parent, node, min(comp) AS comp FROM reach GROUP BY ALL), sz AS (SELECT parent, comp, count(*) AS n FROM lab GROUP BY ALL),
scat AS (SELECT parent, CAST(sum(n) AS BIGINT) AS n_children, count(*) AS n_groups, max(n) AS largest_group, CAST(sum(n) - max(n) AS BIGINT) AS outside, round(1 - max(n) / sum(n), 4) AS scatter_rate FROM sz GROUP BY parent)"""


def _scatter(spark: SparkSession, d: str) -> DataFrame:
    edges = _rollup(spark, d)
    residual = edges.select("parent", "child", F.explode(text.residual_tokens(F.col("parent"), F.col("child"), m.STOPWORDS)).alias("token"))
    return g.scatter(edges.select("parent", "child"), residual)


@query(f"WITH RECURSIVE {_SCATTER} SELECT * FROM scat")
def scatter_score(spark: SparkSession, d: str) -> DataFrame:
    """Children outside a parent's main subject."""
    return _scatter(spark, d)


@query(f"""WITH RECURSIVE {m.SQL_FACTS}, {_SCATTER},
walk AS (SELECT parent AS ancestor, child AS descendant FROM rollup UNION SELECT w.ancestor, r.child FROM walk w JOIN rollup r ON r.parent = w.descendant),
mem AS (SELECT ancestor, descendant AS concept_id FROM walk UNION SELECT DISTINCT ancestor, ancestor FROM walk), fam AS (SELECT ancestor AS parent, count(DISTINCT posting_id) AS postings FROM mem JOIN facts USING (concept_id) GROUP BY ancestor),
s AS (SELECT parent, row_number() OVER (ORDER BY outside DESC, parent) AS scatter_rank FROM scat), c AS (SELECT parent, row_number() OVER (ORDER BY postings DESC, parent) AS closure_rank FROM fam)
SELECT coalesce(s.parent, c.parent) AS parent, CAST(scatter_rank AS INTEGER) AS scatter_rank, CAST(closure_rank AS INTEGER) AS closure_rank FROM (SELECT * FROM s WHERE scatter_rank <= 30) s FULL JOIN (SELECT * FROM c WHERE closure_rank <= 30) c ON s.parent = c.parent""")
def must_read_union(spark: SparkSession, d: str) -> DataFrame:
    """Heads of both rankings."""
    families = g.family_counts(g.closure(_rollup(spark, d)), m.facts(spark, d).select("concept_id", "posting_id"))
    return g.must_read(_scatter(spark, d), families.withColumnRenamed("ancestor", "parent"))


@query(f"""WITH {_FORMS}, s AS (SELECT array_to_string(list_transform(list_filter(string_split(form, ' '), lambda w: w <> ''), lambda w: substring(w, 1, 1)), '') AS acronym, form AS spelled_out, "count" AS gain FROM forms WHERE len(list_filter(string_split(form, ' '), lambda w: w <> '')) >= 2),
r AS (SELECT *, row_number() OVER o AS r, lead(gain) OVER o AS nxt FROM s WINDOW o AS (PARTITION BY acronym ORDER BY gain DESC, spelled_out))
SELECT acronym, spelled_out, gain, coalesce(nxt, 0) AS runner_up, CASE WHEN gain < 10 THEN 'below_limit' WHEN nxt IS NOT NULL AND gain / nxt < 5 THEN 'contested' ELSE 'settled' END AS verdict FROM r WHERE r = 1""")
def acronym_dominance(spark: SparkSession, d: str) -> DataFrame:
    """Expansions that dominate their initials."""
    return resolve.acronym_dominance(m.skill_forms(spark, d))


@query(f"""WITH {_PAIRS}, old AS (SELECT parent, child FROM rollup WHERE length(child) % 7 <> 0), new AS (SELECT parent, child FROM rollup WHERE length(child) % 5 <> 0),
sh AS (SELECT parent FROM old INTERSECT SELECT parent FROM new), b AS (SELECT coalesce(o.parent, n.parent) AS parent, o.child AS oc, n.child AS nc FROM (SELECT DISTINCT * FROM old WHERE parent IN (SELECT parent FROM sh)) o FULL JOIN (SELECT DISTINCT * FROM new WHERE parent IN (SELECT parent FROM sh)) n ON o.parent = n.parent AND o.child = n.child)
SELECT parent, count(oc) AS "before", count(nc) AS "after", count_if(nc IS NULL) AS lost, count_if(oc IS NULL) AS won, round((count_if(nc IS NULL) + count_if(oc IS NULL)) / count(*), 4) AS drift FROM b GROUP BY parent""")
def drift_by_parent(spark: SparkSession, d: str) -> DataFrame:
    """Changed child edges of shared parents between two runs."""
    edges = _rollup(spark, d).select("parent", "child")
    return g.drift(edges.where(F.length("child") % 7 != 0), edges.where(F.length("child") % 5 != 0))


# --- vectors ----------------------------------------------------------------------------

_KNN = """v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.e, b.e), 6) AS similarity FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS k FROM s),
knn AS (SELECT least(a, b) AS a, greatest(a, b) AS b, max(similarity) AS similarity FROM r WHERE k <= 15 GROUP BY 1, 2)"""
_CC = _KNN + """, l AS (SELECT a AS x, b AS y FROM knn WHERE similarity >= 0.35::DOUBLE UNION SELECT b, a FROM knn WHERE similarity >= 0.35::DOUBLE),
w AS (SELECT vec_id AS node, vec_id AS comp FROM v UNION SELECT l.y, w.comp FROM w JOIN l ON l.x = w.node),
cc AS (SELECT node, min(comp) AS component FROM w GROUP BY node)"""
THRESHOLD = 0.35


def _knn(spark: SparkSession, d: str) -> DataFrame:
    return written(g.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", 15), "knn")


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("node"))


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    edges = _knn(spark, d)
    labels = g.threshold_components(edges, THRESHOLD, _nodes(spark, d))
    return written(g.split_oversized(edges, labels, THRESHOLD, 8), "pieces")


@query(f"WITH {_KNN} SELECT * FROM knn")
def knn_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges to the 15 nearest."""
    return _knn(spark, d)


@query(f"WITH RECURSIVE {_CC} SELECT * FROM cc")
def threshold_components(spark: SparkSession, d: str) -> DataFrame:
    """G1: components over the threshold."""
    return g.threshold_components(_knn(spark, d), THRESHOLD, _nodes(spark, d))


# Components at every threshold: a node's piece is its component at the first one where that is small enough.
_PIECES = _CC + """, lv AS (SELECT k, round(0.35 + k * 0.01, 4) AS t FROM (SELECT unnest(range(0, 65)) AS k)),
le AS (SELECT k, a AS x, b AS y FROM knn JOIN lv ON similarity >= t UNION SELECT k, b, a FROM knn JOIN lv ON similarity >= t),
lw AS (SELECT k, vec_id AS node, vec_id AS comp FROM v, lv WHERE k > 0 UNION SELECT lw.k, le.y, lw.comp FROM lw JOIN le ON le.k = lw.k AND le.x = lw.node),
lc AS (SELECT k, node, min(comp) AS comp FROM lw GROUP BY k, node UNION ALL SELECT 0, node, component FROM cc),
sz AS (SELECT k, comp, count(*) AS n FROM lc GROUP BY k, comp),
pc AS (SELECT node, arg_min(comp, k) AS piece, min(k) AS k FROM lc JOIN sz USING (k, comp) WHERE n <= 8 GROUP BY node)"""


@query(f"WITH RECURSIVE {_PIECES} SELECT node, piece, CAST(t AS DOUBLE) AS threshold FROM pc JOIN lv USING (k)")
def split_oversized(spark: SparkSession, d: str) -> DataFrame:
    """Groups of at most eight."""
    return _pieces(spark, d)


@query(f"""WITH RECURSIVE {_CC}, p AS (SELECT x.node, x.component, round(avg(list_cosine_similarity(vx.e, vy.e)), 4) AS m FROM cc x JOIN cc y ON x.component = y.component AND x.node <> y.node JOIN v vx ON vx.vec_id = x.node JOIN v vy ON vy.vec_id = y.node GROUP BY ALL)
SELECT cc.node, cc.component AS piece, coalesce(p.m, 1.0::DOUBLE) AS similarity_within_group FROM cc LEFT JOIN p ON p.node = cc.node""")
def group_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Mean similarity to the own group."""
    labels = g.threshold_components(_knn(spark, d), THRESHOLD, _nodes(spark, d)).withColumnRenamed("component", "piece")
    return g.group_similarity(labels, table(spark, d, "embeddings"), "vec_id", "embedding")


@query(f"""WITH RECURSIVE {_PIECES} SELECT piece, total, "first", size, row_number() OVER (ORDER BY total DESC, "first") - 1 AS group_id
FROM (SELECT piece, CAST(sum(label + 1) AS BIGINT) AS total, min(node) AS "first", count(*) AS size FROM pc JOIN embeddings ON vec_id = node GROUP BY piece)""")
def candidate_groups_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Groups numbered by mentions."""
    weights = table(spark, d, "embeddings").select(F.col("vec_id").alias("node"), (F.col("label") + 1).cast("long").alias("weight"))
    return g.ordered_groups(_pieces(spark, d), weights)
