"""Readers and writers of the pipeline's files."""

from __future__ import annotations

import hashlib
import html
import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.runtime import shared_folder

AD_SCHEMA = "id string, job_title string, company string, description string, date string, source_url string, location string"


def read_ads(spark: SparkSession, folder: str, broken: str = "fail") -> DataFrame:
    """Job ads of ``<folder>/<year>/<occupation>.jsonl`` with the cell from the path.

    Blank lines are skipped.  A line that is no JSON object, or has no id, stops
    the read; with ``broken="keep"`` it comes out as a row whose ``broken``
    column holds the line, so that nothing is lost unseen.
    """
    lines = spark.read.text(f"{folder}/*/*.jsonl").where(F.trim("value") != "")
    path = F.col("_metadata.file_path")
    ad = F.from_json("value", AD_SCHEMA)
    # A cell may also be a folder of parts under the name of the file.
    cell = r"/([^/]+)/([^/]+)\.jsonl(/[^/]*)?$"
    rows = lines.select("value", ad.alias("ad"), F.regexp_extract(path, cell, 1).alias("year"), F.regexp_extract(path, cell, 2).alias("occupation"))
    if broken == "keep":
        return rows.select("ad.*", "year", "occupation", F.when(F.col("ad.id").isNull(), F.col("value")).alias("broken"))
    if broken != "fail":
        raise ValueError("broken: fail or keep")
    stop = F.raise_error(F.concat(F.lit("a line is no ad with an id: "), F.substring("value", 1, 80)))
    return rows.withColumn("ad", F.when(F.col("ad.id").isNull(), stop.cast("void")).otherwise(F.col("ad"))).select("ad.*", "year", "occupation")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``raw``: lines of record files as they are, for readers of several shapes."""
    return spark.read.text(path).withColumnRenamed("value", "raw").where(F.trim("raw") != "")


def read_dim(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """``(key, value)`` of a CSV, trimmed; of several rows of a key the last in the file stands (S3)."""
    rows = spark.read.option("header", True).csv(path).withColumn("_n", F.monotonically_increasing_id())
    return rows.groupBy(key).agg(F.max_by(F.trim(F.coalesce(value, F.lit(""))), "_n").alias(value))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header in column order; null as empty."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_graphs(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """One JSON document per occupation, in a folder of its name."""
    n = nodes.groupBy("occupation").agg(F.collect_list(F.struct(*[c for c in nodes.columns if c != "occupation"])).alias("nodes"))
    e = edges.groupBy("occupation").agg(F.collect_list(F.struct(*[c for c in edges.columns if c != "occupation"])).alias("edges"))
    doc = n.join(e, "occupation", "left").select("occupation", F.to_json(F.struct("occupation", "nodes", "edges")).alias("value"))
    doc.write.mode("overwrite").partitionBy("occupation").text(path)


def append_ledger(df: DataFrame, path: str, batch: int) -> None:
    """Adds rows to an append-only ledger under a growing batch number."""
    df.withColumn("seq", F.lit(batch)).write.mode("append").parquet(path)


def append_vectors(df: DataFrame, path: str, revision: str, dimension: int) -> None:
    """Adds vectors of a model revision to an insert-only cache; a wrong shape is refused."""
    if not df.where(F.size("vector") != dimension).isEmpty():
        raise ValueError(f"vectors must have {dimension} numbers")
    df.withColumn("revision", F.lit(revision)).write.mode("append").partitionBy("revision").parquet(path)


class BatchState:
    """What was submitted and fetched, as an append-only ledger in a shared folder, so that a stopped run goes on.

    One row per event, numbered; the last event of a batch is its state.
    """

    SCHEMA = "name string, ids map<string,string>, results_saved boolean, seq long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def state(self) -> DataFrame:
        """``(name, ids, results_saved)``, a row per batch; ids are those of its submission."""
        last = F.struct("seq")
        return self._rows().groupBy("name").agg(
            F.max_by("ids", F.when(F.col("ids").isNotNull(), F.col("seq"))).alias("ids"), F.max_by("results_saved", last).alias("results_saved")
        )

    def _append(self, name: str, ids: Mapping[str, str] | None, saved: bool) -> None:
        number = (self._rows().agg(F.max("seq")).first()[0] or 0) + 1
        self.spark.createDataFrame([(name, dict(ids) if ids is not None else None, saved, number)], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def submitted(self, name: str, ids: Mapping[str, str]) -> None:
        self._append(name, ids, False)

    def saved(self, name: str) -> None:
        self._append(name, None, True)

    def open(self) -> list[str]:
        return sorted(r["name"] for r in self.state().where(~F.col("results_saved")).collect())


#: Views of the query store over its tables: share of a cell's ads that name a skill or a group.
STORE_VIEWS = {
    "v_penetration_raw": ("raw_occurrences", "raw_skill", "raw_occurrences"),
    "v_penetration_normed": ("normed_occurrences", "canonical_skill", "normed_occurrences"),
    "v_penetration_groups": ("grouped_occurrences", "skill_group", "normed_occurrences"),
}


def rebuild_store(spark: SparkSession, tables: Mapping[str, DataFrame], database: str = "skills", by: Mapping[str, list[str]] | None = None, folder: str | None = None) -> dict[str, int]:
    """Drops and writes the tables of the query store and its views; their numbers of rows.

    A new database lies in ``folder``, else in the shared folder.  Where a row store would keep indexes, a table may be laid out in folders
    ``by`` columns that queries filter on.  Views stand only over tables given.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder or shared_folder(spark)}/{database}'")
    for view in STORE_VIEWS:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{view}")
    for name, df in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        df.write.partitionBy(*(by or {}).get(name, [])).mode("overwrite").saveAsTable(f"{database}.{name}")
    for view, (rows, key, ads) in STORE_VIEWS.items():
        if rows in tables and ads in tables:
            spark.sql(
                f"CREATE VIEW {database}.{view} AS SELECT s.occupation, s.year, s.{key}, s.n_ads, t.n_total, round(s.n_ads / t.n_total, 4) AS rate "
                f"FROM (SELECT occupation, year, {key}, count(DISTINCT job_id) AS n_ads FROM {database}.{rows} GROUP BY occupation, year, {key}) s "
                f"JOIN (SELECT occupation, year, count(DISTINCT job_id) AS n_total FROM {database}.{ads} GROUP BY occupation, year) t "
                "ON s.occupation = t.occupation AND s.year = t.year"
            )
    return {name: spark.table(f"{database}.{name}").count() for name in tables}


def store_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Tables of the query store as views of their names, for one session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def content_hash(content: Mapping[str, Any]) -> str:
    """Version of a configuration: hash of its canonical JSON."""
    return hashlib.sha256(json.dumps(content, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()[:16]


def file_hash(path: str | Path) -> str:
    """Version of a file as it stands."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()[:16]


def versions_hash(versions: Mapping[str, str]) -> str:
    """Version of several configurations together: hash of their names and versions, a line each."""
    lines = "\n".join(f"{name}:{version}" for name, version in sorted(versions.items()))
    return hashlib.sha256(lines.encode()).hexdigest()[:16]


def load_config(path: str | Path, versioned: bool = True) -> dict[str, Any]:
    """A YAML, TOML or JSON configuration; a ``version`` is required unless ``versioned`` is false."""
    p = Path(path)
    said = p.read_text(encoding="utf-8")
    if p.suffix == ".toml":
        import tomllib

        content = tomllib.loads(said)
    elif p.suffix in (".yml", ".yaml"):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError(f"{p}: reading YAML needs the package yaml") from e
        content = yaml.safe_load(said)
    else:
        content = json.loads(said)
    if not isinstance(content, dict) or versioned and content.get("version") in (None, ""):
        raise ValueError(f"{p}: a version is required")
    return content


def heat_colour(value: float, most: float) -> tuple[str, str]:
    """Background and text colour of a heat-map cell."""
    share = 0.0 if most <= 0 else max(0.0, min(1.0, value / most))
    low, high = (255, 255, 255), (178, 34, 52)
    r, g, b = (round(a + (z - a) * share) for a, z in zip(low, high))
    bright = (0.299 * r + 0.587 * g + 0.114 * b) / 255
    return f"#{r:02x}{g:02x}{b:02x}", "#000000" if bright > 0.55 else "#ffffff"


def heat_table(rows: list[tuple[str, list[float]]], columns: list[str]) -> str:
    """An HTML table of a small matrix."""
    most = max((v for _, values in rows for v in values), default=0.0)
    head = "".join(f"<th>{html.escape(c)}</th>" for c in ["", *columns])
    body = []
    for label, values in rows:
        cells = []
        for v in values:
            back, ink = heat_colour(v, most)
            cells.append(f'<td style="background:{back};color:{ink}">{v:.1f}</td>')
        body.append(f"<tr><th>{html.escape(label)}</th>{''.join(cells)}</tr>")
    return f"<table><tr>{head}</tr>{''.join(body)}</table>"
