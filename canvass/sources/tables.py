"""Tables as parquet snapshots: written beside the current one, visible once complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.session import written


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it isn't there."""
    fs, folder = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended."""
    fs, folder = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(folder)


def _snapshots(spark: SparkSession, path: str, complete: bool) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("snapshot=")]
    done = lambda p: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(int(p.getName().split("=")[1]) for p in found if not complete or done(p))


def read_table(spark: SparkSession, path: str, snapshot: int | None = None) -> DataFrame:
    """The newest complete snapshot, or a given one: an unfinished write is never read."""
    number = snapshot if snapshot is not None else _snapshots(spark, path, complete=True)[-1]
    return spark.read.parquet(f"{path}/snapshot={number}")


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_snapshots(spark, path, complete=True))


def write_table(df: DataFrame, path: str) -> int:
    """Write the next snapshot. A plan may read the current snapshot of the same table."""
    number = max(_snapshots(df.sparkSession, path, complete=False), default=0) + 1
    df.write.parquet(f"{path}/snapshot={number}")
    return number


def append_rows(df: DataFrame, path: str) -> None:
    """Add the rows as a folder of their own; what is stored already is not read or moved."""
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    loads = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    number = max([int(n.split("=")[1]) for n in loads if n.startswith("load=")], default=0) + 1
    df.write.parquet(f"{path}/load={number}")


def write_loads(df: DataFrame, path: str) -> None:
    """Replace all loads by one. The plan must not read them."""
    df.withColumn("load", F.lit(1)).write.mode("overwrite").partitionBy("load").parquet(path)


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Overwrite only the partitions present in `df`."""
    # a key's rows come from few tasks, so a partition is few files; large keys are split again by their size
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def replace_keys(df: DataFrame, path: str, key: str, values: list[str]) -> None:
    """Replace the partitions of the given keys: those without rows in `df` go. Rows of other keys are an error.

    New rows are in place before anything goes, so a run that is cut short leaves old or new rows of a key, never none
    that should be there; run again, it ends the same.
    """
    rows = written(df, "replaced-keys")
    found = {r[0] for r in rows.select(key).distinct().limit(len(values) + 1).collect()}
    if found - set(values):
        raise ValueError(f"rows of other keys than those to replace: {sorted(map(str, found - set(values)))}")
    if found:
        replace_partitions(rows, path, key)
    for value in sorted(set(values) - found):
        for folder in names(df.sparkSession, path):
            if folder == f"{key}={value}":
                fs, place = file_system(df.sparkSession, f"{path}/{folder}")
                fs.delete(place, True)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save a table bucketed and sorted by `key`, so that repeated joins on it need no shuffle. Its rows are dealt out by
    the same key first, so a bucket is one file."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
