"""Session helpers: one place that decides where shared scratch data may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: str = "*", app: str = "bibweave") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # small test tables: keep several tasks where a cluster would have thousands
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    whose executors share the driver's disk, may fall back to a temporary
    folder; on a cluster a missing setting is an error, never a local path.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="bibweave-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A written table outlives lost executors, and the read side gets fresh
    statistics for join planning.
    """
    path = run_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Divide rows over the session's number of shuffle partitions.

    For rows that are few in bytes but costly to work on: adaptive execution
    merges small shuffle partitions, a stated number it leaves alone. The hash
    of a hash differs from the partitioning the rows may already have, so the
    step is not taken for a repetition and removed.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*columns))
