"""Queries of readers, writers and configuration: what is written is what is read."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.queries import domain as m
from corpusloom.queries.registry import query
from corpusloom.runtime import shared_folder
from corpusloom.sources import files
from corpusloom.sources.tables import table


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, source AS company, text AS description, coalesce(year, 'none') AS year, 'o' || (doc_id % 7) AS occupation FROM documents""")
def ads_read_back(spark: SparkSession, d: str) -> DataFrame:
    """Ads of JSON lines, the cell from the path."""
    path = _place(spark, "ads")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("company"), F.col("text").alias("description"), F.coalesce("year", F.lit("none")).alias("y"), (F.col("doc_id") % 7).alias("o"))
    for y, o in docs.select("y", "o").distinct().collect():  # a few dozen cells, a file each
        docs.where((F.col("y") == y) & (F.col("o") == o)).drop("y", "o").coalesce(1).write.json(f"{path}/{y}/o{o}.jsonl")
    return files.read_ads(spark, path).select("id", "company", "description", "year", "occupation")


@query("""SELECT doc_id, lang, source, n_chars FROM documents""")
def csv_read_back(spark: SparkSession, d: str) -> DataFrame:
    """Rows to CSV with a header and back; empty stands for null."""
    path = _place(spark, "csv")
    files.write_csv(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), path)
    return spark.read.option("header", True).schema("doc_id long, lang string, source string, n_chars long").csv(path)


@query("""SELECT occupation, year, canonical_skill, n_ads, n_total, round(n_ads / n_total::DOUBLE, 4) AS rate FROM (SELECT occupation, year, canonical_skill, count(DISTINCT job_id) AS n_ads FROM normed_occurrences GROUP BY ALL) s
JOIN (SELECT occupation, year, count(DISTINCT job_id) AS n_total FROM normed_occurrences GROUP BY ALL) t USING (occupation, year)""")
def store_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """The query store dropped and built anew, read through its view."""
    name = f"store_{uuid.uuid4().hex}"
    rows = table(spark, d, "normed_occurrences")
    files.rebuild_store(spark, {"normed_occurrences": rows.limit(5)}, name)
    files.rebuild_store(spark, {"normed_occurrences": rows}, name, {"normed_occurrences": ["year"]})
    return spark.table(f"{name}.v_penetration_normed")


@query("SELECT 'b' || n_nationkey AS name, n_name AS first_id, n_regionkey % 2 = 0 AS results_saved FROM nation WHERE n_nationkey < 6")
def batch_state(spark: SparkSession, d: str) -> DataFrame:
    """Batches submitted, some of them fetched."""
    state = files.BatchState(spark, _place(spark, "state"))
    for r in table(spark, d, "nation").where("n_nationkey < 6").collect():
        state.submitted(f"b{r['n_nationkey']}", {"1": r["n_name"]})
        if r["n_regionkey"] % 2 == 0:
            state.saved(f"b{r['n_nationkey']}")
    return state.state().select("name", F.col("ids")["1"].alias("first_id"), "results_saved")


_SETTINGS = {"aliases": "3", "blocking": "1.2", "orthography": "7"}


@query("""SELECT substring(sha256('aliases:3' || chr(10) || 'blocking:1.2' || chr(10) || 'orthography:7'), 1, 16) AS versions, substring(sha256('{"a": [1, 2], "version": "5"}'), 1, 16) AS content, '5' AS version""")
def config_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions of configurations, and one read from YAML, TOML and JSON alike."""
    with tempfile.TemporaryDirectory() as folder:  # read by the driver only
        for name, said in (("c.yml", 'version: "5"\na: [1, 2]\n'), ("c.toml", 'version = "5"\na = [1, 2]\n'), ("c.json", '{"a": [1, 2], "version": "5"}')):
            (Path(folder) / name).write_text(said, encoding="utf-8")
        read = [files.load_config(Path(folder) / name) for name in ("c.yml", "c.toml", "c.json")]
    rows = [(files.versions_hash(_SETTINGS), files.content_hash(c), c["version"]) for c in read]
    return spark.createDataFrame(rows, "versions string, content string, version string").distinct()


@query(f"SELECT 'level1:v1+map.' || substring(sha256(string_agg(k || chr(9) || v, chr(10) ORDER BY k)), 1, 12) AS version FROM (VALUES {', '.join(f'({k!r}, {v!r})' for k, v in m.ACRONYMS.items())}) t(k, v)")
def normaliser_version(spark: SparkSession, d: str) -> DataFrame:
    """Version of the level-1 form, from its logic and its map."""
    return spark.createDataFrame([(text.map_version("level1:v1", m.ACRONYMS),)], "version string")


@query("""SELECT r_regionkey, '<tr><th>' || r_name || '</th><td style="background:' || CASE r_regionkey WHEN 4 THEN '#b22234;color:#ffffff' WHEN 0 THEN '#ffffff;color:#000000' ELSE 'other' END || '">' || CAST(r_regionkey AS VARCHAR) || '.0</td></tr>' AS row
FROM region WHERE r_regionkey IN (0, 4)""")
def heat_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a heat-map table, from white to the full colour."""
    regions = sorted((r["r_regionkey"], r["r_name"]) for r in table(spark, d, "region").collect())
    page = files.heat_table([(name, [float(k)]) for k, name in regions], ["n"])
    lines = [x for x in page.replace("</tr>", "</tr>\n").splitlines() if "<td" in x]
    rows = [(k, line) for (k, _), line in zip(regions, lines) if k in (0, 4)]
    return spark.createDataFrame(rows, "r_regionkey int, row string")
