"""A table with one row per key, kept up to date by many small batches of changed rows.

A batch is written as it is, in a folder of its own (`changes/batch=N`), so its cost follows the batch. Every few batches
the changes are merged into the hash buckets they touch; other buckets keep their files. A version (`places/version=N`)
says for each bucket which merge holds it and is complete or not seen at all. A reader takes the newest version and the
changes after it; of rows with one key the one of the latest batch counts.

A batch that is run again writes the same folders with the same rows, so replays change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.sources.tables import complete, names


@dataclass
class KeyedTable:
    """`schema` is that of the rows; `every` is the number of batches between merges."""

    spark: SparkSession
    path: str
    schema: str
    keys: list[str]
    buckets: int = 64
    every: int = 8

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Rows of new or changed keys, each key once."""
        rows.withColumn("bucket", self._bucket()).write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")
        merged = self._version(below=batch)
        if batch - (-1 if merged is None else merged) >= self.every:
            self.merge(batch)

    def _version(self, below: int | None = None) -> int | None:
        """The newest complete version, if any."""
        found = sorted(int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/places") if n.startswith("version="))
        for number in reversed([n for n in found if below is None or n < below]):
            if complete(self.spark, f"{self.path}/places/version={number}"):
                return number
        return None

    def _places(self, version: int | None) -> dict[int, int]:
        """The merge that holds each bucket: as many rows as there are buckets."""
        if version is None:
            return {}
        return {r["bucket"]: r["merge"] for r in self.spark.read.parquet(f"{self.path}/places/version={version}").collect()}

    def _changes(self, after: int | None, upto: int | None = None) -> DataFrame:
        """Changed rows with their batch, of the batches that came after a version."""
        found = sorted(int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/changes") if n.startswith("batch="))
        wanted = [n for n in found if (after is None or n > after) and (upto is None or n <= upto)]
        wanted = [n for n in wanted if complete(self.spark, f"{self.path}/changes/batch={n}")]
        if not wanted:
            return self.spark.createDataFrame([], f"{self.schema}, bucket int, batch int")
        rows = self.spark.read.schema(f"{self.schema}, bucket int, batch int").option("basePath", f"{self.path}/changes")
        return rows.parquet(*[f"{self.path}/changes/batch={n}" for n in wanted])

    def _merged(self, places: dict[int, int]) -> DataFrame:
        schema = f"{self.schema}, merge int, bucket int"
        if not places:
            return self.spark.createDataFrame([], schema)
        root = f"{self.path}/merged"
        rows = self.spark.read.schema(schema).option("basePath", root)
        return rows.parquet(*[f"{root}/merge={m}/bucket={b}" for b, m in sorted(places.items())])

    def _latest(self, merged: DataFrame, changes: DataFrame) -> DataFrame:
        rows = merged.withColumn("batch", F.lit(-1)).drop("merge").unionByName(changes)
        values = [c for c in rows.columns if c not in (*self.keys, "bucket", "batch")]
        newest = rows.groupBy("bucket", *self.keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
        return newest.select("bucket", *self.keys, *[F.col(f"v.{c}").alias(c) for c in values])

    def merge(self, batch: int) -> None:
        """Rewrite the buckets that the batches since the last version touch."""
        before = self._version(below=batch)
        places, changes = self._places(before), self._changes(before, batch)
        touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]
        rows = self._latest(self._merged({b: m for b, m in places.items() if b in touched}), changes)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/merged/merge={batch}")
        now = places | dict.fromkeys(touched, batch)
        manifest = self.spark.createDataFrame(sorted(now.items()), "bucket int, merge int")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/places/version={batch}")

    def read(self) -> DataFrame:
        version = self._version()
        columns = [f.strip().split(" ")[0] for f in self.schema.split(",")]
        return self._latest(self._merged(self._places(version)), self._changes(version)).select(*columns)
