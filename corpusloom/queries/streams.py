"""Queries over streams: what comes in batches gives what one table gives."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import join_key
from corpusloom.queries import domain as m
from corpusloom.queries.registry import query
from corpusloom.runtime import shared_folder
from corpusloom.streaming import ingest

_BRIDGE = f"bridge AS (SELECT {m.sql_trim('lower(canonical_skill)')} AS key, min(canonical_skill) AS concept_id FROM skill_list GROUP BY 1)"


@query(f"""WITH {m.SQL_FACTS}, {_BRIDGE} SELECT year, occupation, posting_id, b.concept_id, count(*) AS n_mentions FROM mentions JOIN bridge b ON b.key = {m.sql_trim('lower(mentions.concept_id)')} GROUP BY ALL""")
def streamed_facts(spark: SparkSession, d: str) -> DataFrame:
    """2.9, A2: the fact table out of three batches, ads and their mentions spread over all of them."""
    place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = m.mentions(spark, d).select("year", "occupation", "posting_id", F.col("concept_id").alias("form"))
    skills = m.dims(spark, d).select(join_key(F.col("concept_id")).alias("key"), "concept_id").groupBy("key").agg(F.min("concept_id").alias("concept_id"))
    batch = F.pmod(F.xxhash64("posting_id", "form"), F.lit(3))
    for number in range(3):
        rows.where(batch == number).write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{place}/in")
        ingest.into_facts(stream, skills, f"{place}/facts", f"{place}/checkpoint").awaitTermination()
    return ingest.merged_facts(spark.read.parquet(f"{place}/facts"))


@query("""SELECT time_bucket(INTERVAL '1 day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def windowed_events(spark: SparkSession, d: str) -> DataFrame:
    """2.9: events per day and kind, by the windows of the stream, read as a batch."""
    from corpusloom.sources.tables import table

    counts = ingest.windowed_counts(table(spark, d, "events").select("ts", "event_type"), "ts", ["event_type"])
    return counts.select(F.col("window.start").alias("day"), "event_type", "n")
