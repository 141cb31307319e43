"""Queries of ledgers, votes, decisions and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import stats
from corpusloom.operators import govern
from corpusloom.queries import domain as m
from corpusloom.queries.graphs import _PAIRS, _judged, _rollup
from corpusloom.queries.registry import query
from corpusloom.runtime import written
from corpusloom.sources.tables import table

def _skills(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "skill_list").select(F.col("canonical_skill").alias("form"))


# --- ledgers ----------------------------------------------------------------------------


@query("""SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def ledger_latest(spark: SparkSession, d: str) -> DataFrame:
    """The last entry of every key."""
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return govern.latest(rows, ["user_id", "event_type"], "ts", "event_id")


@query("""SELECT occupation, posting_id, status FROM (SELECT *, row_number() OVER (PARTITION BY occupation, posting_id ORDER BY loaded_at DESC, status DESC) AS r FROM posting WHERE occupation IS NOT NULL AND posting_id IS NOT NULL) WHERE r = 1""")
def posting_latest(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of every ad."""
    rows = table(spark, d, "posting").where("occupation IS NOT NULL AND posting_id IS NOT NULL").select("occupation", "posting_id", "status", "loaded_at")
    return govern.latest(rows, ["occupation", "posting_id"], "loaded_at", "status").select("occupation", "posting_id", "status")


@query("SELECT DISTINCT posting_id FROM posting WHERE posting_id IS NOT NULL AND posting_id NOT IN (SELECT posting_id FROM posting WHERE status = 'ok' AND posting_id IS NOT NULL)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    """Ads without an ok result."""
    rows = table(spark, d, "posting").where("posting_id IS NOT NULL")
    return govern.pending(rows.select("posting_id").distinct(), rows, "posting_id", F.col("status") == "ok")


@query("SELECT DISTINCT form FROM surface_form WHERE form IS NOT NULL AND form NOT IN (SELECT form FROM surface_form WHERE form_id % 2 = 0 AND form_id % 3 = 0 AND form IS NOT NULL)")
def embedding_cache_missing(spark: SparkSession, d: str) -> DataFrame:
    """Forms that the cache lacks in a model's revision."""
    rows = table(spark, d, "surface_form").where("form IS NOT NULL")
    cache = rows.where(F.col("form_id") % 2 == 0).select("form", F.when(F.col("form_id") % 3 == 0, "r1").otherwise("r2").alias("revision"))
    return govern.missing_keys(rows, cache, "form", "r1")


@query("SELECT DISTINCT canonical_skill AS form, length(canonical_skill)::DOUBLE AS size, canonical_skill LIKE '% %' AS spaced FROM skill_list")
def embedding_hook(spark: SparkSession, d: str) -> DataFrame:
    """Vectors by a hook in the workers, read back in a revision."""
    forms = _skills(spark, d)
    made = govern.embedded(forms, "form", lambda texts: [[len(t), " " in t] for t in texts], 2).withColumn("revision", F.lit("r1"))
    read = govern.vectors_for(forms, written(made, "vectors"), "form", "r1")
    return read.select("form", F.col("vector")[0].cast("double").alias("size"), (F.col("vector")[1] > 0).alias("spaced"))


@query("SELECT skill_id, (row_number() OVER (ORDER BY skill_id) - 1) // 40 AS chunk FROM skill_list")
def chunk_assignment(spark: SparkSession, d: str) -> DataFrame:
    """L3: chunks of forty in order."""
    return govern.chunked(table(spark, d, "skill_list").select("skill_id"), 40, "skill_id")


@query("""SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('20260828|' || CAST(event_id AS VARCHAR)), event_id) AS r FROM events) WHERE r <= 40""")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Forty rows of every kind, the same on every run."""
    return govern.seeded_sample(table(spark, d, "events").select("event_type", "event_id"), ["event_type"], ["event_id"], 40, 20260828)


@query("""SELECT skill_id FROM (SELECT skill_id, row_number() OVER (ORDER BY md5('20260831|' || CAST(skill_id AS VARCHAR)), skill_id) AS r FROM skill_list WHERE len(other_names) = 0) WHERE r <= 30""")
def gate_sample(spark: SparkSession, d: str) -> DataFrame:
    """Thirty skills outside the pilot (those with other names)."""
    skills = table(spark, d, "skill_list")
    rest = skills.join(skills.where(F.size("other_names") > 0).select("skill_id"), "skill_id", "left_anti").select("skill_id")
    return govern.seeded_sample(rest.withColumn("all", F.lit(1)), ["all"], ["skill_id"], 30, 20260831).select("skill_id")


# --- model answers ----------------------------------------------------------------------


@query("""SELECT event_id AS id, k AS skill FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events WHERE event_id % 5 <> 0)""")
def skill_records_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """Records of either shape; failed ones dropped."""
    k = F.get_json_object("props", "$.k")
    old = F.concat(F.lit('{"id":"'), F.col("event_id"), F.lit('","skills":["'), k, F.lit('"]}'))
    new = F.concat(F.lit('{"id":"'), F.col("event_id"), F.lit('","status":"ok","skills":[{"skill":"'), k, F.lit('"}]}'))
    failed = F.concat(F.lit('{"id":"'), F.col("event_id"), F.lit('","status":"api_error","skills":[]}'))
    n = F.col("event_id") % 5
    lines = table(spark, d, "events").select(F.when(n == 0, failed).when(n < 3, old).otherwise(new).alias("raw"))
    return govern.skill_records(lines, "raw").select(F.col("id").cast("bigint").alias("id"), F.explode("skills").alias("skill"))


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN text IS NULL AND lang IS NULL THEN 'api_error' WHEN lang = 'max_tokens' THEN 'truncated' WHEN text IS NULL THEN 'no_tool_use' ELSE 'ok' END AS status FROM documents) GROUP BY status""")
def extraction_status(spark: SparkSession, d: str) -> DataFrame:
    """M1: outcomes of calls (text as the answer, language as the stop reason)."""
    return table(spark, d, "documents").select(govern.status_of("text", "lang").alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT regexp_replace(posting_id, '[^a-zA-Z0-9_-]', '_', 'g') AS custom_id, 'm' AS model, 900 AS max_tokens, 'user' AS role, 'record' AS tool,
'Title: ' || coalesce(job_title, '') || chr(10) || chr(10) || coalesce(location, '') AS content
FROM (SELECT posting_id, min(job_title) AS job_title, min(location) AS location FROM posting WHERE posting_id IS NOT NULL GROUP BY posting_id)""")
def extraction_requests(spark: SparkSession, d: str) -> DataFrame:
    """M1: one request per ad."""
    ads = table(spark, d, "posting").where("posting_id IS NOT NULL").groupBy(F.col("posting_id").alias("id")).agg(F.min("job_title").alias("job_title"), F.min("location").alias("description"))
    body = govern.extraction_requests(ads, "Name the skills.", '[{"name":"record","input_schema":{"type":"object"}}]', "m", 900)

    def part(path: str) -> Column:
        return F.get_json_object("body", path)

    return body.select(
        "custom_id", part("$.model").alias("model"), part("$.max_tokens").cast("int").alias("max_tokens"), part("$.messages[0].role").alias("role"),
        part("$.tools[0].name").alias("tool"), part("$.messages[0].content").alias("content"),
    )


# --- votes ------------------------------------------------------------------------------

_RUNS = """runs AS (
  SELECT p_partkey AS concept, r AS run, CASE (p_partkey * r + p_size) % 3 WHEN 0 THEN 'tool' WHEN 1 THEN 'method' ELSE 'practice' END AS type,
    (p_partkey + r * p_size) % 5 = 0 AS abstain, CASE (p_partkey + r) % 3 WHEN 0 THEN 'ambiguous' WHEN 1 THEN 'out_of_scope' ELSE 'odd' END AS held_reason, ((p_size + r) % 10) / 10.0::DOUBLE AS confidence
  FROM part, (SELECT unnest([1, 2, 3]) AS r) t
)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("s"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("run"))
    k, s, r = F.col("p_partkey"), F.col("s"), F.col("run")
    t, h = (k * r + s) % 3, (k + r) % 3
    return rows.select(
        k.alias("concept"), "run", F.when(t == 0, "tool").when(t == 1, "method").otherwise("practice").alias("type"), ((k + r * s) % 5 == 0).alias("abstain"),
        F.when(h == 0, "ambiguous").when(h == 1, "out_of_scope").otherwise("odd").alias("held_reason"), (((s + r) % 10) / F.lit(10.0)).alias("confidence"),
    )


_VALID = """valid AS (SELECT * FROM runs WHERE type IN ('tool', 'method')),
t AS (SELECT concept, type, count(*) AS n, min(run) AS f FROM valid GROUP BY ALL),
top AS (SELECT concept, arg_max(type, struct_pack(n := n, f := -f)) AS top, max(n) AS votes, count(*) AS kinds FROM t GROUP BY concept),
h AS (SELECT concept, arg_max(held_reason, struct_pack(n := n, f := -f)) AS why FROM (SELECT concept, held_reason, count(*) AS n, min(run) AS f FROM valid WHERE abstain AND held_reason IN ('insufficient_evidence', 'ambiguous', 'out_of_scope') GROUP BY ALL) GROUP BY concept),
s AS (SELECT concept, count(*) AS valid, count_if(abstain) AS off, round(avg(confidence), 3) AS mean, string_agg(type, '/' ORDER BY run) AS said FROM valid GROUP BY concept),
j AS (SELECT k.concept, coalesce(valid, 0) < 2 AS few, coalesce(off, 0) >= 2 AS off, coalesce(valid, 0) >= 2 AND coalesce(off, 0) < 2 AND votes >= 2 AS won, coalesce(valid, 0) >= 2 AND kinds = 1 AS agreed, top, why, mean, said FROM (SELECT DISTINCT concept FROM runs) k LEFT JOIN top USING (concept) LEFT JOIN s USING (concept) LEFT JOIN h USING (concept)),
votes AS (SELECT concept, CASE WHEN won THEN top ELSE '' END AS type, CASE WHEN few THEN 0.0::DOUBLE ELSE mean END AS confidence, NOT won AS abstain,
  CASE WHEN few THEN 'insufficient_evidence' WHEN won THEN '' WHEN off THEN coalesce(why, 'type_tie') ELSE 'type_tie' END AS held_reason, agreed AS stable,
  CASE WHEN agreed THEN '' ELSE coalesce(said, '') END AS run_variants, CASE WHEN few THEN 'model_unresolved' WHEN off THEN 'model_held' WHEN won THEN 'model' ELSE 'model_tie' END AS source FROM j)"""


def _votes(spark: SparkSession, d: str) -> DataFrame:
    runs = _runs(spark, d)
    return govern.type_votes(runs, "concept", allowed=["tool", "method"], keys=runs)


@query(f"WITH {_RUNS}, {_VALID} SELECT * FROM votes")
def type_vote(spark: SparkSession, d: str) -> DataFrame:
    """Majority over three runs, of which some give no type of the list."""
    return _votes(spark, d)


@query(f"""WITH {_RUNS}, {_VALID}, bad AS (SELECT concept, CASE WHEN concept % 7 = 0 THEN 'odd' WHEN concept % 7 = 1 THEN '' ELSE type END AS type, abstain, CASE WHEN concept % 7 = 2 THEN '' ELSE held_reason END AS held_reason FROM votes)
SELECT concept, CASE WHEN type <> '' AND type NOT IN ('tool', 'method') THEN 'unknown type' WHEN type <> '' AND abstain THEN 'typed and held' WHEN type = '' AND NOT abstain THEN 'neither typed nor held' ELSE 'held without a reason' END AS problem FROM bad
WHERE (type <> '' AND (type NOT IN ('tool', 'method') OR abstain)) OR (type = '' AND NOT abstain) OR (abstain AND held_reason = '')""")
def type_problems(spark: SparkSession, d: str) -> DataFrame:
    """M5: typed rows that contradict themselves."""
    k = F.col("concept") % 7
    bad = _votes(spark, d).withColumns({
        "type": F.when(k == 0, "odd").when(k == 1, "").otherwise(F.col("type")), "held_reason": F.when(k == 2, "").otherwise(F.col("held_reason")),
    })
    return govern.type_problems(bad, "concept", ["tool", "method"])


_CATS = """cats AS (
  SELECT p_partkey AS concept, r AS run, (p_partkey + r * p_size) % 4 = 0 AS unassigned, CASE WHEN p_partkey % 5 <> 0 THEN 'cat_' || ((p_partkey + r) % 3) END AS "primary",
    CASE WHEN (p_partkey + r) % 3 = (p_partkey * r) % 4 THEN ['cat_' || ((p_partkey + r) % 3)] ELSE ['cat_' || ((p_partkey + r) % 3), 'cat_' || ((p_partkey * r) % 4)] END AS categories
  FROM part, (SELECT unnest([1, 2, 3]) AS r) t
)"""


@query(f"""WITH {_CATS}, a AS (SELECT * FROM cats WHERE NOT unassigned),
k AS (SELECT concept, run, unassigned, CASE WHEN unassigned THEN 'UNASSIGNED' ELSE array_to_string(list_sort(categories), '+') END AS said FROM cats),
s AS (SELECT concept, count_if(unassigned) AS off, count(DISTINCT said) AS kinds, string_agg(said, ' | ' ORDER BY run) AS said FROM k GROUP BY concept),
v AS (SELECT concept, list(c ORDER BY c) AS accepted FROM (SELECT concept, c FROM (SELECT concept, unnest(categories) AS c FROM a) GROUP BY concept, c HAVING count(*) >= 2) GROUP BY concept),
p AS (SELECT concept, arg_max("primary", struct_pack(n := n, f := -f)) AS p FROM (SELECT concept, "primary", count(*) AS n, min(run) AS f FROM a WHERE "primary" IN ('cat_0', 'cat_1') GROUP BY ALL) GROUP BY concept),
e AS (SELECT concept, arg_min(categories, run)[1] AS e FROM a GROUP BY concept),
f AS (SELECT s.*, coalesce(p, e) AS p, coalesce(accepted, []) AS accepted FROM s LEFT JOIN v USING (concept) LEFT JOIN p USING (concept) LEFT JOIN e USING (concept)),
o AS (SELECT *, CASE WHEN off >= 2 THEN [] WHEN p IS NULL THEN accepted ELSE list_concat([p], list_filter(accepted, lambda x: x <> p)) END AS l FROM f)
SELECT concept, array_to_string(l[1:2], '|') AS categories, CASE WHEN off >= 2 THEN '' ELSE coalesce(p, '') END AS primary_category, CAST(len(l[1:2]) AS INTEGER) AS n_categories, off >= 2 AS unassigned, kinds = 1 AS stable,
CASE WHEN kinds = 1 THEN '' ELSE said END AS run_variants, 'model' AS source FROM o""")
def category_vote(spark: SparkSession, d: str) -> DataFrame:
    """Majority over category sets, some without a known primary."""
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("s"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("run"))
    k, s, r = F.col("p_partkey"), F.col("s"), F.col("run")
    first, second = (F.concat(F.lit("cat_"), x.cast("string")) for x in ((k + r) % 3, (k * r) % 4))
    cats = rows.select(
        k.alias("concept"), "run", ((k + r * s) % 4 == 0).alias("unassigned"), F.when(k % 5 != 0, first).alias("primary"),
        F.array_distinct(F.array(first, second)).alias("categories"),
    )
    return govern.category_votes(cats, "concept", allowed=["cat_0", "cat_1"])


@query("""SELECT request, category, CAST(row_number() OVER (PARTITION BY request ORDER BY sha256(request || '|' || category), category) AS INTEGER) AS place
FROM (SELECT DISTINCT 'r' || (skill_id % 50) AS request FROM skill_list), (SELECT DISTINCT n_name AS category FROM nation)""")
def category_order(spark: SparkSession, d: str) -> DataFrame:
    """M6: categories in an order of their own for every request."""
    requests = table(spark, d, "skill_list").select(F.concat(F.lit("r"), (F.col("skill_id") % 50).cast("string")).alias("request"))
    return govern.seeded_order(requests, "request", table(spark, d, "nation").select(F.col("n_name").alias("category")), "category")


@query(f"""WITH {_RUNS}, a AS (SELECT concept, type FROM runs WHERE run = 1 AND concept % 10 <> 0), b AS (SELECT concept, type FROM runs WHERE run = 2 AND concept % 11 <> 0)
SELECT coalesce(a.type, 'MISSING') AS "first", coalesce(b.type, 'MISSING') AS "second", count(*) AS n FROM a FULL JOIN b ON a.concept = b.concept GROUP BY ALL""")
def verdict_confusion(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts of two judges, missing ones counted."""
    runs = _runs(spark, d)
    a = runs.where((F.col("run") == 1) & (F.col("concept") % 10 != 0)).select("concept", F.col("type").alias("verdict"))
    b = runs.where((F.col("run") == 2) & (F.col("concept") % 11 != 0)).select("concept", F.col("type").alias("verdict"))
    return govern.confusion(a, b, ["concept"])


@query(f"""WITH {_RUNS}, u AS (SELECT * FROM runs WHERE run = 1) SELECT concept, CASE WHEN concept % 9 = 0 THEN 'fixed' ELSE type END AS type, CASE WHEN concept % 9 = 0 THEN 'override' ELSE 'model' END AS source FROM u""")
def type_override(spark: SparkSession, d: str) -> DataFrame:
    """M5: fixed types go before the model's."""
    runs = _runs(spark, d).where("run = 1").select("concept", "type")
    return govern.with_overrides(runs, runs.where(F.col("concept") % 9 == 0).select("concept", F.lit("fixed").alias("type")), "concept", "type")


# --- decisions --------------------------------------------------------------------------

_DECIDED = _PAIRS + """, dec AS (
  SELECT parent, child, CASE length(child) % 3 WHEN 0 THEN 'reject' WHEN 1 THEN 'rollup' ELSE 'related' END AS verdict, CASE WHEN length(parent) % 2 = 0 THEN 'human' ELSE 'model' END AS "by" FROM rollup WHERE length(child) % 2 = 0
  UNION ALL SELECT 'zz ' || parent, child, 'rollup', 'human' FROM rollup WHERE length(child) % 5 = 0
)"""


def _decisions(edges: DataFrame) -> DataFrame:
    n = F.length("child") % 3
    own = edges.where(F.length("child") % 2 == 0).select(
        "parent", "child", F.when(n == 0, "reject").when(n == 1, "rollup").otherwise("related").alias("verdict"),
        F.when(F.length("parent") % 2 == 0, "human").otherwise("model").alias("by"),
    )
    return own.unionByName(edges.where(F.length("child") % 5 == 0).select(F.concat(F.lit("zz "), F.col("parent")).alias("parent"), "child", F.lit("rollup").alias("verdict"), F.lit("human").alias("by")))


@query(f"WITH {_DECIDED} SELECT r.parent, r.child, dec.verdict, dec.\"by\", coalesce(dec.verdict = 'rollup', true) AS kept FROM rollup r LEFT JOIN dec ON dec.parent = r.parent AND dec.child = r.child")
def decisions_apply(spark: SparkSession, d: str) -> DataFrame:
    """Edges under decisions."""
    edges = _rollup(spark, d).select("parent", "child")
    return govern.applied(edges, _decisions(edges))


@query(f"WITH {_DECIDED} SELECT parent, child, verdict, \"by\" FROM dec WHERE verdict = 'rollup' AND (parent, child) NOT IN (SELECT (parent, child) FROM rollup)")
def decisions_forced(spark: SparkSession, d: str) -> DataFrame:
    """Roll-ups that only decisions make."""
    edges = _rollup(spark, d).select("parent", "child")
    return govern.forced(edges, _decisions(edges))


@query(f"WITH {_DECIDED} SELECT parent, child, parent AS missing FROM dec WHERE parent NOT IN (SELECT form FROM forms) UNION ALL SELECT parent, child, child FROM dec WHERE child NOT IN (SELECT form FROM forms)")
def decisions_stale(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on forms that are gone."""
    return govern.stale(_decisions(_rollup(spark, d).select("parent", "child")), m.skill_forms(spark, d))


_NEW = """, neu AS (SELECT parent, child, 'related' AS verdict, CASE WHEN length(parent) % 3 = 0 THEN 'human' ELSE 'model' END AS "by" FROM rollup WHERE length(child) % 4 <> 1)"""


def _new(edges: DataFrame) -> DataFrame:
    return edges.where(F.length("child") % 4 != 1).select("parent", "child", F.lit("related").alias("verdict"), F.when(F.length("parent") % 3 == 0, "human").otherwise("model").alias("by"))


@query(f"""WITH {_DECIDED}{_NEW}, u AS (SELECT *, 0 AS n FROM dec UNION ALL SELECT *, 1 FROM neu)
SELECT parent, child, verdict, "by" FROM (SELECT *, row_number() OVER (PARTITION BY parent, child ORDER BY CASE "by" WHEN 'human' THEN 1 ELSE 0 END DESC, n DESC, verdict DESC) AS r FROM u) WHERE r = 1""")
def decisions_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Newer wins, no model over a person."""
    edges = _rollup(spark, d).select("parent", "child")
    return govern.upserted(_decisions(edges), _new(edges), ["parent", "child"])


@query(f"WITH {_DECIDED} SELECT \"by\", verdict, count(*) AS n FROM dec GROUP BY ALL")
def decisions_summary(spark: SparkSession, d: str) -> DataFrame:
    """Decisions by author and verdict."""
    return govern.counted_by(_decisions(_rollup(spark, d).select("parent", "child")), "by", "verdict")


@query(f"""WITH {_DECIDED}{_NEW}, u AS (SELECT * FROM dec UNION ALL SELECT * FROM neu) SELECT parent, child, verdict, "by", 'decided twice' AS problem FROM (SELECT *, count(*) OVER (PARTITION BY parent, child) AS c FROM u) WHERE c > 1""")
def decisions_problems(spark: SparkSession, d: str) -> DataFrame:
    """Decisions that break the rules."""
    edges = _rollup(spark, d).select("parent", "child")
    return govern.decision_problems(_decisions(edges).unionByName(_new(edges)))


@query(f"""WITH {_DECIDED} SELECT parent, child, coalesce(dec.verdict, 'MISSING') AS verdict, CAST((row_number() OVER (ORDER BY parent, child) - 1) // 25 AS BIGINT) AS chunk FROM rollup r LEFT JOIN dec USING (parent, child)""")
def adjudication_items(spark: SparkSession, d: str) -> DataFrame:
    """M8: items in requests of 25, missing verdicts filled."""
    edges = _rollup(spark, d).select("parent", "child")
    items = edges.join(_decisions(edges).select("parent", "child", "verdict"), ["parent", "child"], "left").fillna("MISSING", ["verdict"])
    return govern.chunked(items, 25, "parent", "child")


_STRING_PAIRS = """pairs AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE 'a' || (o_custkey % 40) END AS a, CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE 'b' || (o_orderkey % 30) END AS b,
CASE o_orderkey % 5 WHEN 0 THEN 'odd' WHEN 1 THEN 'keep_separate' ELSE 'merge' END AS verdict, CASE o_orderkey % 3 WHEN 0 THEN 'a' || (o_custkey % 40) WHEN 1 THEN 'other' END AS canonical, CASE WHEN o_orderkey % 13 = 0 THEN 'nobody' ELSE 'human' END AS "by" FROM orders)"""


@query(f"""WITH {_STRING_PAIRS}, j AS (SELECT a, b, CASE WHEN a = b THEN 'self pair' WHEN verdict NOT IN ('merge', 'keep_separate') THEN 'unknown verdict' WHEN "by" NOT IN ('human', 'model') THEN 'unknown author'
WHEN verdict = 'merge' AND canonical IS NULL THEN 'no canonical' WHEN verdict = 'merge' AND canonical <> a AND canonical <> b THEN 'canonical not of the pair' WHEN count(*) OVER (PARTITION BY least(a, b), greatest(a, b)) > 1 THEN 'decided twice' END AS problem FROM pairs)
SELECT * FROM j WHERE problem IS NOT NULL""")
def pair_decision_problems(spark: SparkSession, d: str) -> DataFrame:
    """Pair decisions that break the rules."""
    k = F.col("o_orderkey")
    a, b = F.concat(F.lit("a"), (F.col("o_custkey") % 40).cast("string")), F.concat(F.lit("b"), (k % 30).cast("string"))
    pairs = table(spark, d, "orders").select(
        F.when(k % 11 == 0, "x").otherwise(a).alias("a"), F.when(k % 11 == 0, "x").otherwise(b).alias("b"),
        F.when(k % 5 == 0, "odd").when(k % 5 == 1, "keep_separate").otherwise("merge").alias("verdict"),
        F.when(k % 3 == 0, a).when(k % 3 == 1, "other").alias("canonical"), F.when(k % 13 == 0, "nobody").otherwise("human").alias("by"),
    )
    return govern.pair_decision_problems(pairs)


@query(f"WITH {_DECIDED} SELECT d.parent, d.child, r.parent_mentions, r.child_mentions, r.parent IS NOT NULL AS found FROM dec d LEFT JOIN rollup r ON r.parent = d.parent AND r.child = d.child")
def edge_lookup(spark: SparkSession, d: str) -> DataFrame:
    """What the edges know of decided ones, misses told."""
    edges = _rollup(spark, d)
    return govern.keyed(_decisions(edges.select("parent", "child")).select("parent", "child"), edges)


@query(f"""WITH {_DECIDED}, pool AS (SELECT parent, child FROM rollup WHERE (parent, child) NOT IN (SELECT (parent, child) FROM dec)),
pick AS (SELECT parent, child FROM (SELECT *, row_number() OVER (ORDER BY md5('20260828|' || parent || '|' || child), parent, child) AS r FROM pool) WHERE r <= 60)
SELECT parent, child, CASE WHEN length(child) % 3 = 0 THEN 'MISSING' WHEN length(parent) % 2 = 0 THEN 'rollup' ELSE 'related' END AS "first", CASE WHEN length(child) % 4 = 1 THEN 'MISSING' ELSE 'rollup' END AS "second" FROM pick""")
def disagreement_sample(spark: SparkSession, d: str) -> DataFrame:
    """Undecided edges, sampled, with two judges' verdicts."""
    edges = _rollup(spark, d).select("parent", "child")
    first = edges.where(F.length("child") % 3 != 0).withColumn("verdict", F.when(F.length("parent") % 2 == 0, "rollup").otherwise("related"))
    second = edges.where(F.length("child") % 4 != 1).withColumn("verdict", F.lit("rollup"))
    return govern.disagreement_sample(edges, _decisions(edges), first, second, 60, 20260828)


@query(f"""WITH {_PAIRS}, f AS (SELECT parent, child, CASE length(child) % 3 WHEN 0 THEN 'uncertain' WHEN 1 THEN 'rollup' END AS v, CASE WHEN length(child) % 2 = 0 THEN 'reject' END AS w FROM rollup)
SELECT parent, child, CASE WHEN v = 'uncertain' AND w IS NOT NULL THEN w ELSE coalesce(v, 'MISSING') END AS verdict, coalesce(v = 'uncertain' AND w IS NOT NULL, false) AS escalated FROM f""")
def adjudication_escalated(spark: SparkSession, d: str) -> DataFrame:
    """M8: uncertain verdicts asked once again."""
    edges = _rollup(spark, d).select("parent", "child")
    n = F.length("child")
    first = edges.where(n % 3 != 2).withColumn("verdict", F.when(n % 3 == 0, "uncertain").otherwise("rollup"))
    return govern.escalated(first, edges.where(n % 2 == 0).withColumn("verdict", F.lit("reject")), edges, ["parent", "child"])


@query(f"""WITH {_PAIRS} SELECT a, b, parent, child, array_to_string(list_sort(list_filter({m.sql_tokens('parent')}, lambda w: NOT list_contains({m.sql_tokens('child')}, w))), ' ') AS dropped FROM judged WHERE reason = 'stopword-only subset -> related'""")
def rollup_demoted(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that only a dropped stop word made, with the words."""
    rows = _judged(spark, d).where(F.col("reason") == "stopword-only subset -> related")
    return rows.select("a", "b", "parent", "child", F.array_join("dropped", " ").alias("dropped"))


# --- merges and assignments -------------------------------------------------------------

_MEMBERS = """inp AS (SELECT DISTINCT concept_id AS group_id, form FROM surface_form WHERE concept_id IS NOT NULL AND form IS NOT NULL),
mem AS (SELECT group_id, CASE WHEN length(form) % 9 = 0 THEN '' WHEN length(form) % 10 = 0 THEN 'joint' ELSE form END AS label, form, CASE WHEN length(form) % 10 = 0 THEN 'product_and_technology' ELSE 'no_vendor' END AS rel FROM inp WHERE length(form) % 13 <> 0
UNION ALL SELECT group_id, form, form, 'no_vendor' FROM inp WHERE length(form) % 17 = 0 UNION ALL SELECT group_id, form, form || '!', 'no_vendor' FROM inp WHERE length(form) % 19 = 0 UNION ALL SELECT group_id, 'empty ' || form, NULL, 'no_vendor' FROM inp WHERE length(form) % 23 = 0),
u AS (SELECT group_id, form, count(*) AS n FROM mem WHERE form IS NOT NULL GROUP BY ALL), problems AS (
SELECT i.group_id, i.form, 'missing' AS problem FROM inp i LEFT JOIN u ON u.group_id = i.group_id AND u.form = i.form WHERE u.form IS NULL
UNION ALL SELECT u.group_id, u.form, 'invented' FROM u LEFT JOIN inp i ON i.group_id = u.group_id AND i.form = u.form WHERE i.form IS NULL
UNION ALL SELECT group_id, form, 'in two concepts' FROM u WHERE n > 1 UNION ALL SELECT group_id, form, 'empty label' FROM mem WHERE label = '' AND form IS NOT NULL
UNION ALL SELECT group_id, label, 'no members' FROM mem WHERE form IS NULL
UNION ALL SELECT group_id, label, 'merged product and technology' FROM mem WHERE form IS NOT NULL AND rel = 'product_and_technology' GROUP BY ALL HAVING count(*) > 1)"""


def _inputs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "surface_form").where("concept_id IS NOT NULL AND form IS NOT NULL").select(F.col("concept_id").alias("group_id"), "form").distinct()


def _members(inputs: DataFrame) -> DataFrame:
    n = F.length("form")
    plain = F.lit("no_vendor").alias("vendor_relation")
    own = inputs.where(n % 13 != 0).select(
        "group_id", F.when(n % 9 == 0, "").when(n % 10 == 0, "joint").otherwise(F.col("form")).alias("label"), "form",
        F.when(n % 10 == 0, "product_and_technology").otherwise("no_vendor").alias("vendor_relation"),
    )
    twice = inputs.where(n % 17 == 0).select("group_id", F.col("form").alias("label"), "form", plain)
    invented = inputs.where(n % 19 == 0).select("group_id", F.col("form").alias("label"), F.concat("form", F.lit("!")).alias("form"), plain)
    bare = inputs.where(n % 23 == 0).select("group_id", F.concat(F.lit("empty "), "form").alias("label"), F.lit(None).cast("string").alias("form"), plain)
    return own.unionByName(twice).unionByName(invented).unionByName(bare)


@query(f"WITH {_MEMBERS} SELECT * FROM problems")
def partition_violations(spark: SparkSession, d: str) -> DataFrame:
    """Where partitions of groups fail."""
    inputs = _inputs(spark, d)
    return govern.partition_problems(_members(inputs), inputs)


@query(f"""WITH {_MEMBERS}, o AS (SELECT DISTINCT *, list_position(['empty label', 'no members', 'merged product and technology', 'in two concepts', 'missing', 'invented'], problem) AS o FROM problems),
low AS (SELECT group_id, arg_min(problem, o) AS reason, min(o) AS o FROM o GROUP BY group_id), r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY o, form) AS r FROM o),
sh AS (SELECT r.group_id, string_agg(form, '; ' ORDER BY form) AS forms FROM r JOIN low ON low.group_id = r.group_id AND low.o = r.o WHERE r <= 5 GROUP BY r.group_id)
SELECT g.group_id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'failed' END AS status, coalesce(reason, '') AS reason, coalesce(forms, '') AS forms FROM (SELECT DISTINCT group_id FROM inp) g LEFT JOIN low USING (group_id) LEFT JOIN sh USING (group_id)""")
def partition_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Groups as ok or failed, with the reason."""
    inputs = _inputs(spark, d)
    return govern.partition_ledger(_members(inputs), inputs)


@query("SELECT form, form AS label, 'cpt_' || substring(sha256('skill-concept:v1' || chr(31) || lower(form)), 1, 16) AS concept_id, 1.0::DOUBLE AS confidence FROM (SELECT canonical_skill AS form FROM skill_list) WHERE form NOT IN (SELECT normalised_form FROM surface_form WHERE normalised_form IS NOT NULL)")
def singleton_concepts(spark: SparkSession, d: str) -> DataFrame:
    """M3: skills of no group."""
    forms = table(spark, d, "skill_list").select(F.col("canonical_skill").alias("form"))
    members = table(spark, d, "surface_form").where("normalised_form IS NOT NULL").select(F.col("normalised_form").alias("form"))
    return govern.singleton_concepts(forms, members)


_LABEL = "SELECT form, concept_id, coalesce(normalised_form, '') AS label FROM surface_form WHERE form IS NOT NULL"


@query(f"""WITH s AS ({_LABEL}) SELECT 'unassigned' AS problem, count(*) AS n FROM s WHERE concept_id IS NULL
UNION ALL SELECT 'several concepts', count(*) FROM (SELECT form FROM s WHERE concept_id IS NOT NULL GROUP BY form HAVING count(DISTINCT concept_id) > 1)
UNION ALL SELECT 'empty label', count(*) FROM s WHERE label = ''
UNION ALL SELECT 'shared label', count(*) FROM (SELECT label FROM s WHERE concept_id IS NOT NULL GROUP BY label HAVING count(DISTINCT concept_id) > 1)
UNION ALL SELECT 'unstable id', count(*) FROM s WHERE concept_id IS NOT NULL AND concept_id <> 'cpt_' || substring(sha256('skill-concept:v1' || chr(31) || lower(regexp_replace({m.sql_trim('label')}, '{m.SQL_WS}+', ' ', 'g'))), 1, 16)""")
def assignment_violations(spark: SparkSession, d: str) -> DataFrame:
    """M4: checks of a full assignment."""
    rows = table(spark, d, "surface_form").where("form IS NOT NULL").select("form", "concept_id", F.coalesce("normalised_form", F.lit("")).alias("label"))
    return govern.assignment_problems(rows)


_MERGED = """f AS (SELECT DISTINCT substring(concept_id, 1, 5) AS group_id, substring(concept_id, 1, 6) AS concept_id, form, coalesce(normalised_form, '') AS label, CASE WHEN length(concept_id) % 2 = 0 AND form_id % 3 = 0 THEN 'singleton' ELSE 'ok' END AS status FROM surface_form WHERE concept_id IS NOT NULL AND form IS NOT NULL),
c AS (SELECT form, CAST(coalesce(sum("count"), 0) AS BIGINT) AS n FROM surface_form WHERE form IS NOT NULL GROUP BY form),
l AS (SELECT concept_id, label, sum(n) AS w FROM f JOIN c USING (form) GROUP BY ALL), i AS (SELECT concept_id, count(*) - 1 AS collapsed FROM (SELECT DISTINCT concept_id, group_id, label FROM f) GROUP BY concept_id),
merged AS (SELECT s.*, p.label, i.collapsed FROM (SELECT concept_id, count(DISTINCT form) AS n_forms, CAST(sum(n) AS BIGINT) AS mentions, count(DISTINCT group_id) AS n_groups,
  CASE WHEN bool_or(status = 'ok') THEN 'step3-merge' ELSE 'step3-singleton' END AS source, array_to_string(list_sort(list_distinct(list(form))), ' | ') AS forms FROM f JOIN c USING (form) GROUP BY concept_id) s
JOIN (SELECT concept_id, arg_min(label, struct_pack(a := -w, b := length(label), d := label)) AS label FROM l GROUP BY concept_id) p USING (concept_id) JOIN i USING (concept_id))"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "surface_form").where("concept_id IS NOT NULL AND form IS NOT NULL")
    single = (F.length("concept_id") % 2 == 0) & (F.col("form_id") % 3 == 0)
    members = rows.select(
        F.substring("concept_id", 1, 5).alias("group_id"), F.substring("concept_id", 1, 6).alias("concept_id"), "form", F.coalesce("normalised_form", F.lit("")).alias("label"),
        F.when(single, "singleton").otherwise("ok").alias("status"),
    ).distinct()
    counts = table(spark, d, "surface_form").where("form IS NOT NULL").groupBy("form").agg(F.sum(F.coalesce("count", F.lit(0))).alias("count"))
    return govern.merged_concepts(members, counts)


@query(f"WITH {_MERGED} SELECT * FROM merged")
def merged_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Concepts over all groups."""
    return _merged(spark, d)


@query(f"""WITH {_MERGED} SELECT CAST(r AS INTEGER) AS rank, concept_id, label, n_forms, forms FROM (SELECT *, row_number() OVER (ORDER BY n_forms DESC, label, concept_id) AS r FROM merged WHERE n_forms > 1) WHERE r <= 100""")
def merge_report(spark: SparkSession, d: str) -> DataFrame:
    """The concepts of most forms."""
    return govern.merge_report(_merged(spark, d))


_FACETS = f"WITH {m.SQL_FACTS}"


@query(_FACETS + """ SELECT facet_id, concept_id, CASE WHEN facet_id = 'wave' AND length(concept_id) % 8 = 0 THEN 'second' ELSE value END AS value,
CASE WHEN facet_id = 'wave' AND length(concept_id) % 8 = 0 THEN '' ELSE 'm1' END AS model, CASE WHEN facet_id = 'wave' AND length(concept_id) % 8 = 0 THEN 'human' ELSE 'model' END AS "by" FROM facets""")
def correction_apply(spark: SparkSession, d: str) -> DataFrame:
    """A person's corrections over facet values."""
    values = m.facets(spark, d).withColumns({"model": F.lit("m1"), "by": F.lit("model")})
    fixes = m.facets(spark, d).where((F.col("facet_id") == "wave") & (F.length("concept_id") % 8 == 0)).select("facet_id", "concept_id", F.lit("second").alias("value"))
    return govern.corrected(values, fixes).select("facet_id", "concept_id", "value", "model", "by")


@query(_FACETS + " SELECT skill_id, l.label, d.concept_id FROM (SELECT skill_id, canonical_skill AS label FROM skill_list) l JOIN dims d ON d.concept_id = l.label")
def label_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Labels to ids, none left over."""
    wanted = table(spark, d, "skill_list").select("skill_id", F.col("canonical_skill").alias("label"))
    return govern.resolved_labels(wanted, m.dims(spark, d).select(F.col("concept_label").alias("label"), "concept_id")).select("skill_id", "label", "concept_id")


@query(_FACETS + """ SELECT concept_id, facet_id, value FROM facets UNION ALL SELECT canonical_skill, 'vendor', CASE WHEN length(canonical_skill) % 2 = 0 THEN 'house' ELSE 'none' END FROM skill_list""")
def facet_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """A facet added, others untouched."""
    new = table(spark, d, "skill_list").select(F.col("canonical_skill").alias("concept_id"), F.when(F.length("canonical_skill") % 2 == 0, "house").otherwise("none").alias("value"))
    return govern.facet_rewritten(m.facets(spark, d), new, "vendor").select("concept_id", "facet_id", "value")


@query("""WITH a AS (SELECT canonical_skill AS concept_id, CASE length(canonical_skill) % 4 WHEN 0 THEN ['none', 'house'] WHEN 1 THEN ['none'] WHEN 2 THEN ['bad', 'guest'] ELSE ['house', 'house'] END AS vals FROM skill_list),
v AS (SELECT concept_id, unnest(list_distinct(vals)) AS value FROM a), k AS (SELECT * FROM v WHERE value IN ('house', 'guest', 'none'))
SELECT concept_id, value FROM k WHERE value <> 'none' OR concept_id NOT IN (SELECT concept_id FROM k WHERE value <> 'none')""")
def facet_answers(spark: SparkSession, d: str) -> DataFrame:
    """M7: valid values of model answers."""
    n = F.length("canonical_skill") % 4
    answers = table(spark, d, "skill_list").select(
        F.col("canonical_skill").alias("concept_id"),
        F.when(n == 0, F.array(F.lit("none"), F.lit("house"))).when(n == 1, F.array(F.lit("none"))).when(n == 2, F.array(F.lit("bad"), F.lit("guest"))).otherwise(F.array(F.lit("house"), F.lit("house"))).alias("values"),
    )
    return govern.facet_answers(answers, ["house", "guest"])


_ANSWERS = """a AS (SELECT canonical_skill AS concept_id, CASE length(canonical_skill) % 4 WHEN 0 THEN ['none', 'house'] WHEN 1 THEN ['none'] WHEN 2 THEN ['bad', 'guest', 'worse'] ELSE ['house', 'bad', 'bad'] END AS vals FROM skill_list)"""


@query(f"WITH {_ANSWERS}, v AS (SELECT concept_id, unnest(list_distinct(vals)) AS value FROM a) SELECT * FROM v WHERE value NOT IN ('house', 'guest', 'none')")
def facet_invalid(spark: SparkSession, d: str) -> DataFrame:
    """M7: values of model answers that the facet doesn't have."""
    n = F.length("canonical_skill") % 4
    kinds = [["none", "house"], ["none"], ["bad", "guest", "worse"], ["house", "bad", "bad"]]
    given = F.when(n == 0, F.array(*map(F.lit, kinds[0])))
    for k in (1, 2, 3):
        given = given.when(n == k, F.array(*map(F.lit, kinds[k])))
    return govern.facet_invalid(table(spark, d, "skill_list").select(F.col("canonical_skill").alias("concept_id"), given.alias("values")), ["house", "guest"])


@query(_FACETS + " SELECT DISTINCT concept_id FROM facets WHERE concept_id NOT IN (SELECT concept_id FROM facets WHERE facet_id = 'wave' AND length(concept_id) % 3 <> 0)")
def facet_pending(spark: SparkSession, d: str) -> DataFrame:
    """M7: concepts that a resumed run asks for."""
    values = m.facets(spark, d)
    return govern.facet_pending(values.select("concept_id"), values.where(F.length("concept_id") % 3 != 0), "wave")


_TAXO = """t AS (SELECT CASE WHEN n_nationkey % 6 = 0 THEN 'Cat-' || n_nationkey WHEN n_nationkey % 8 = 1 THEN 'cat_9' ELSE 'cat_' || n_nationkey END AS id,
CASE WHEN n_nationkey % 7 = 0 THEN n_name || ' Tool set' ELSE n_name || ' toolset' END AS label, CASE WHEN n_nationkey % 9 = 0 THEN '  ' ELSE 'about ' || n_name END AS definition,
CASE n_regionkey WHEN 0 THEN 'load_bearing' WHEN 1 THEN 'coverage' WHEN 2 THEN 'other' WHEN 3 THEN 'coverage' END AS role, 'cat_' || (n_nationkey + 1) AS g, n_nationkey AS k FROM nation),
ex AS (SELECT id, k, CASE WHEN k % 10 = 3 THEN '' ELSE 'shape' END AS shape, CASE WHEN k % 4 = 0 THEN g WHEN k % 4 = 2 THEN NULL ELSE 'cat_9' END AS goes_to FROM t UNION ALL SELECT id, k, 'second', 'cat_9' FROM t WHERE k % 5 <> 0)"""


@query(f"""WITH {_TAXO} SELECT id, 'id form' AS problem FROM t WHERE NOT regexp_full_match(id, 'cat_[a-z0-9]+(_[a-z0-9]+)*') UNION ALL SELECT id, 'id twice' FROM t GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, 'no definition' FROM t WHERE trim(definition) = '' UNION ALL SELECT id, 'label names a type' FROM t WHERE regexp_matches(lower(label), '\\b(tool|library|language|method|practice|knowledge)\\b')
UNION ALL SELECT id, 'unknown role' FROM t WHERE role IS NULL OR role NOT IN ('load_bearing', 'coverage') UNION ALL SELECT id, 'fewer than two excludes' FROM t WHERE k % 5 = 0
UNION ALL SELECT id, 'exclude without shape' FROM ex WHERE shape = '' UNION ALL SELECT id, 'exclude without goes_to' FROM ex WHERE goes_to IS NULL UNION ALL SELECT id, 'goes_to unknown' FROM ex WHERE goes_to IS NOT NULL AND goes_to NOT IN (SELECT id FROM t)""")
def taxonomy_violations(spark: SparkSession, d: str) -> DataFrame:
    """Categories that break the rules."""
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    own = F.concat(F.lit("cat_"), k.cast("string"))
    first = F.struct(
        F.when(k % 10 == 3, "").otherwise("shape").alias("concept_shape"),
        F.when(k % 4 == 0, F.concat(F.lit("cat_"), (k + 1).cast("string"))).when(k % 4 != 2, "cat_9").alias("goes_to"),
    )
    second = F.struct(F.lit("second").alias("concept_shape"), F.lit("cat_9").alias("goes_to"))
    cats = table(spark, d, "nation").select(
        F.when(k % 6 == 0, F.concat(F.lit("Cat-"), k.cast("string"))).when(k % 8 == 1, "cat_9").otherwise(own).alias("id"),
        F.concat("n_name", F.when(k % 7 == 0, " Tool set").otherwise(" toolset")).alias("label"),
        F.when(k % 9 == 0, "  ").otherwise(F.concat(F.lit("about "), "n_name")).alias("definition"),
        F.when(r == 0, "load_bearing").when(r == 1, "coverage").when(r == 2, "other").when(r == 3, "coverage").alias("role"),
        F.when(k % 5 == 0, F.array(first)).otherwise(F.array(first, second)).alias("excludes"),
    )
    return govern.taxonomy_problems(cats)


@query("SELECT p_partkey, least(greatest(1.2::DOUBLE * (p_size / 100.0::DOUBLE), 0.02::DOUBLE), 0.4::DOUBLE) AS allowed FROM part")
def drift_limits(spark: SparkSession, d: str) -> DataFrame:
    """Allowed drift for a change of the corpus."""
    return table(spark, d, "part").select("p_partkey", stats.drift_limit(F.col("p_size") / F.lit(100.0)).alias("allowed"))
