"""Incremental ingest: new ads as a stream into the fact table.

The batch operators stay the single definition of every result; a stream adds
deduplicated mentions, and only the cells it touched are counted anew.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.cells import CELL, matched_mentions, posting_concepts


def new_mentions(stream: DataFrame, key: list[str], time: str, late: str = "7 days") -> DataFrame:
    """Each mention once, as far back as ``late``; rows and state behind the watermark are dropped.

    Where mentions come later than that, leave this out and give ``into_facts``
    the key and a mention table instead.
    """
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, by: list[str], size: str = "1 day", late: str = "7 days") -> DataFrame:
    """Mentions per window and key, final once the watermark has passed; later rows are dropped.

    Over a mention table of ``into_facts``, read as a batch, every row counts.
    """
    return stream.withWatermark(time, late).groupBy(F.window(time, size), *by).agg(F.count(F.lit(1)).alias("n"))


def into_facts(
    stream: DataFrame, bridge: DataFrame, facts: str, checkpoint: str, touched: Callable[[DataFrame], None] | None = None,
    key: list[str] | None = None, mentions: str | None = None,
) -> StreamingQuery:
    """Appends fact rows under their batch number, so a repeated batch replaces itself.

    ``touched`` gets the cells of each batch, for recounting only these.  With
    ``key`` and ``mentions`` each mention counts once however late it comes: it
    is looked up in the table of all mentions of earlier batches, which grows
    with them.  An ad's concept may have a row in several batches;
    ``merged_facts`` reads the table at its grain.
    """
    if (key is None) != (mentions is None):
        raise ValueError("key and mentions go together")

    def put(rows: DataFrame, number: int, path: str) -> None:
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    def new_only(batch: DataFrame, number: int) -> DataFrame:
        kept = batch.sparkSession.read.schema(T.StructType([*batch.schema.fields, T.StructField("batch", T.IntegerType())]))
        fresh = batch.dropDuplicates(key)
        if number:
            earlier = kept.parquet(mentions).where(F.col("batch") < number).select(*(F.col(k).alias(f"_met_{k}") for k in key))
            met = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_met_{k}")) for k in key))
            fresh = fresh.join(earlier, met, "left_anti")
        put(fresh, number, mentions)
        return kept.parquet(mentions).where(F.col("batch") == number).drop("batch")

    def add(batch: DataFrame, number: int) -> None:
        if key is not None:
            batch = new_only(batch, number)
        put(posting_concepts(matched_mentions(batch, bridge).where(F.col("concept_id").isNotNull())), number, facts)
        if touched is not None:
            touched(batch.select(*CELL).distinct())

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged_facts(facts: DataFrame) -> DataFrame:
    """The fact table of ``into_facts`` with one row per cell, posting and concept over all batches."""
    return facts.groupBy(*CELL, "posting_id", "concept_id").agg(F.sum("n_mentions").alias("n_mentions"))
