"""Session settings the jobs rely on, and the shared folder for data written between stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution decides broadcasts by measured size and splits skewed join partitions. The force flag lets it
# split a hot key even where a later stage would have reused the partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Spark 4.1 can plan a grouping over a union without a shuffle because both sides are partitioned alike, and lose that
# property again when it reuses one of the shuffles: a group then comes out once per side. Off, the shuffle is planned.
UNIONS = {"spark.sql.unionOutputPartitioning": "false"}


def adaptive(spark: SparkSession) -> SparkSession:
    """Apply the settings above; cluster-specific sizes (partitions, thresholds) are left alone."""
    for key, value in {**ADAPTIVE, **UNIONS}.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str | None:
    """`spark.checkpoint.dir`; a local folder for a local session without it, none for a cluster without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run that all executors can reach."""
    root = shared_root(spark)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """A result that several steps read, written once and read back: a lost executor costs a read, not the lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)


def measured(df: DataFrame) -> DataFrame:
    """A written table for the side of a join that Spark may broadcast: marked to be shuffled unless its rows are small.

    Spark plans by the size of the files, which can be a hundredth of that of the rows in them, and adaptive execution
    keeps a planned broadcast whatever its stages measure: the driver would have to hold all of a large table.
    """
    limit, least = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold(), 8 * len(df.columns)
    # the count comes from the files' footers; only rows that are few enough are looked at
    if df.count() * least <= limit:
        size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + least)).first()[0]
        if (size or 0) <= limit:
            return df
    return df.hint("merge")
