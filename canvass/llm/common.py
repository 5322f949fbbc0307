"""What the operators share: tables, the shared folder, and counters merged over all tasks."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Key of a row without one: sorts before all others, as NULL does.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below `spark.checkpoint.dir`. Only a local session without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df`, written once to the shared folder and read back: later steps don't compute it again."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def python_ready(spark: SparkSession, rows: int = 2000) -> None:
    """Before Python runs in tasks: the package goes to the executors, once per application, and Arrow batches get `rows`
    rows; with long texts, the default of 10,000 is a lot of memory for a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def pieces(batch: pa.RecordBatch, column: int, limit: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    if batch.column(column).nbytes <= limit:
        yield batch
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)


def merged_counts(parts: DataFrame, chunk: str, counts: str) -> DataFrame:
    """Sum of little-endian uint32 counter arrays per chunk, each task streaming through its chunks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(blob, "<u4").astype(np.uint64)
                total[k] = np.minimum(total[k] + part, 2**32 - 1) if k in total else part
        for k, v in total.items():
            blob = v.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blob], pa.binary())], ["chunk", "counts"])

    return (
        parts.select(F.col(chunk).alias("chunk"), F.col(counts).alias("counts"))
        .repartition("chunk")
        .mapInArrow(add, "chunk int, counts binary")
    )
