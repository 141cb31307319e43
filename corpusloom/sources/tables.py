"""Parquet tables of a data folder, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.runtime import shipped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; columns are pruned by the plan."""
    return shipped(spark).read.parquet(f"{folder}/{name}.parquet")
