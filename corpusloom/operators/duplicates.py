"""Quality prefilter of texts: short ones, exact copies, near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators.components import components
from corpusloom.operators.joins import HOT, met_pairs
from corpusloom.runtime import spread, written


def long_enough(df: DataFrame, body: str, least: int = 200) -> DataFrame:
    return df.where(F.length(body) >= least)


def exact_classes(df: DataFrame, row_id: str, body: str) -> DataFrame:
    """``(row_id, class_id)``: the smallest id among rows of the same folded text."""
    texts = spread(df.select(F.col(row_id).alias("d"), F.col(body).alias("t")))
    rows = written(texts.select("d", F.sha2(text.evidence_flatten(F.col("t")), 256).alias("h")).where(F.col("h").isNotNull()), "hashes")
    heads = rows.groupBy("h").agg(F.min("d").alias("class_id"))
    return rows.join(heads, "h").select(F.col("d").alias(row_id), "class_id")


def shingles(df: DataFrame, body: str, words: int = 5) -> DataFrame:
    """``s``: distinct hashes of runs of ``words`` folded words; a shorter text is one run."""
    w = F.filter(F.split(F.regexp_replace(text.evidence_flatten(F.col(body)), r"[^\p{L}\p{N}]+", " "), " "), lambda x: x != "")
    n = F.size("w")
    runs = F.when(n < words, F.array(F.array_join("w", " "))).otherwise(
        F.transform(F.sequence(F.lit(1), n - (words - 1)), lambda i: F.array_join(F.slice("w", i, words), " "))
    )
    return df.withColumn("w", w).where(n > 0).withColumn("s", F.array_distinct(F.transform(runs, lambda x: F.xxhash64(x)))).drop("w")


def near_classes(df: DataFrame, row_id: str, body: str, words: int = 5, least: float = 0.8, hot: int = HOT) -> DataFrame:
    """``(row_id, class_id)``: texts linked by shingle similarity of ``least`` or more.

    Exact: copies collapse first; of each distinct text only its rarest
    shingles are joined, as many as similar texts must share one of (prefix
    filter); lengths and the similarity itself decide.  One row per text, copies
    are not expanded into pairs.
    """
    exact = written(exact_classes(df, row_id, body), "exact")
    heads = exact.where(F.col(row_id) == F.col("class_id")).select(F.col(row_id).alias("d"))
    reps = written(shingles(spread(df.select(F.col(row_id).alias("d"), body)).join(heads, "d", "left_semi"), body, words).select("d", "s"), "shingles")
    single = reps.select("d", F.size("s").alias("n"), F.explode("s").alias("h"))
    held = single.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") > 1)
    # Shingles of one text only sort first and join nobody, so they only move the ranks.
    shared = single.join(held, "h")
    own = shared.groupBy("d").agg(F.count(F.lit(1)).alias("k")).select("d", "k")
    rank = F.row_number().over(Window.partitionBy("d").orderBy("f", "h"))
    prefix = (
        shared.withColumn("r", rank).join(own, "d")
        .withColumn("r", F.col("r") + F.col("n") - F.col("k"))
        .where(F.col("r") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - F.lit(1e-9)) + 1)
        .select("h", "d", "n")
    )
    met = met_pairs(written(prefix, "prefix"), "h", "d", "n", hot=hot)
    ratio = F.least("a_n", "b_n") / F.greatest("a_n", "b_n")
    pairs = met.where(ratio >= least - 1e-9).select(F.col("a").alias("d"), F.col("b").alias("e")).distinct()
    # Only ids travel until the pairs are distinct; then the arrays meet them once.
    sized = written(pairs, "pairs").join(reps, "d").join(reps.withColumnsRenamed({"d": "e", "s": "t"}), "e")
    both = F.size(F.array_intersect("s", "t"))
    links = sized.where(both >= F.lit(least) * (F.size("s") + F.size("t") - both) - F.lit(1e-9)).select("d", "e")
    classes = components(links, "d", "e", reps.select(F.col("d").alias("node")))
    return exact.join(classes.withColumnsRenamed({"node": "class_id", "component": "near"}), "class_id", "left").select(
        row_id, F.coalesce("near", "class_id").alias("class_id")
    )
