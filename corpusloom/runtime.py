"""Session, shared folder and spreading of work."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shipped(spark: SparkSession) -> SparkSession:
    """``spark`` with this package sent to its workers, once per context, so that
    row functions run where it isn't installed."""
    context = spark.sparkContext
    if not getattr(context, "_corpusloom_shipped", False):
        root = Path(__file__).resolve().parent
        # Only the driver reads this folder; Spark serves the archive to the executors.
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder) / "corpusloom.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._corpusloom_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder, which
    goes when the process ends; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    known = getattr(context, "_corpusloom_folder", None)
    if known is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        made = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        known = context._corpusloom_folder = "file://" + made
    return known


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str = "step", by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared folder and read again, in folders per value of ``by``.

    Cuts the lineage, survives the loss of executors, and makes a result that
    several later steps read be computed once.  The table stays until
    ``forget`` or the end of the folder, since a result may be read at any time.
    """
    spark = shipped(df.sparkSession)
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Deletes all tables that this application has written to the shared folder."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """``df`` in at least ``least`` partitions (default: the cores at hand).

    For costly row functions over a table of few files; a table with enough
    partitions stays as it is, without a shuffle.  ``df`` must be a plain scan.
    """
    least = least or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)



def cores() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))


def tasks(spark: SparkSession) -> int:
    """Tasks for costly row functions after a shuffle: a number asked for by
    count is kept, where adaptive execution would merge small partitions."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
