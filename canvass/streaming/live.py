"""Submissions as a stream: raw append, running option counts, late rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from canvass.functions.measures import percent
from canvass.operators.upsert import NEW_IDS_FROM, number_rows
from canvass.sources.keyed import KeyedTable
from canvass.sources.responses import stage
from canvass.sources.tables import names


def raw_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-line files landing in a folder, as (raw)."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).withColumnRenamed("value", "raw")


def votes(responses: DataFrame) -> DataFrame:
    """One row per counted choice, of a batch or a stream.

    Text answers and write-ins do not count; list entries count one by one; NULL and '' do not. Unlike the
    set-based tally this counts numbers and booleans as well.
    """
    scalar = F.when(F.col("a.kind") == "other", F.array(F.try_variant_get("a.answer", "$", "string")))
    return (
        responses.select("poll_id", F.explode("answers").alias("a"))
        .where(~F.coalesce(F.col("a.type") == "text", F.lit(False)) & ~F.col("a.write_in"))
        .select(
            F.coalesce("poll_id", F.lit("default")).alias("poll_id"),
            F.col("a.question").alias("question_key"),
            F.explode(F.coalesce("a.elements", scalar)).alias("option_value"),
        )
        .where(F.col("option_value") != "")
    )


def option_counts(responses: DataFrame) -> DataFrame:
    """Running count per (poll, question, option). Counts are combined before the shuffle, so a hot option is cheap."""
    return votes(responses).groupBy("poll_id", "question_key", "option_value").agg(F.count("*").alias("votes"))


def option_stats(counts: DataFrame) -> DataFrame:
    """Whole-number share of the votes of a question, rounded half up, from the counter table."""
    totals = counts.groupBy("poll_id", "question_key").agg(F.sum("votes").alias("total"))
    share = percent(F.col("votes"), F.col("total"), 0).cast("long")
    return counts.join(totals, ["poll_id", "question_key"]).select(
        "poll_id", "question_key", F.col("option_value").alias("label"), "votes", share.alias("percentage")
    )


def run_raw_append(raw: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the staged submissions, one folder per batch, with ids of the new range.

    A batch that is run again overwrites its own folder with the same ids; the checkpoint keeps track of the files.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        start = NEW_IDS_FROM
        for earlier in range(number - 1, -1, -1):  # ids grow with the batches: the last one with rows decides
            newest = spark.read.parquet(f"{table}/batch={earlier}").agg(F.max("ingestion_id")).first()[0]
            if newest is not None:
                start = newest + 1
                break
        numbered = number_rows(batch, start, "ingestion_id")
        stage(numbered).withColumn("inserted_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{table}/batch={number}"
        )

    stream = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return stream.trigger(availableNow=True).start()


#: A state store on disk that uploads the changes of a batch, not all of its state.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
COUNTERS = "poll_id string, question_key string, option_value string, votes bigint"


def counter_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    return KeyedTable(spark, path, COUNTERS, ["poll_id", "question_key", "option_value"], **options)


def run_option_counts(responses: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Keep the counters up to date: a batch brings only the counters it changed, with their new totals.

    Totals come from the keyed state, so a batch that is run again brings the same rows.
    """
    for key, value in STATE.items():
        responses.sparkSession.conf.set(key, value)
    counted = option_counts(responses).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return counted.foreachBatch(table.apply).trigger(availableNow=True).start()


def without_repeats(responses: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop submissions delivered twice within the delay. Only event time is a watermark, never a poll id."""
    timed = responses.withColumn("submitted_time", F.col("submitted_at").cast("timestamp"))
    return timed.withWatermark("submitted_time", delay).dropDuplicatesWithinWatermark(["ingestion_id"])


class Intake:
    """Deliveries (delivery_id, raw) that may come more than once, taken in once each.

    `accepted` holds the staged submissions, one folder per batch; `seen` their ids by day of submission; `aside` what
    can't be told apart from a repeat: submissions older than the watermark, and those without a time or with one after
    `until`. The watermark of a batch is `days` before the latest submission of the batches before it, so only
    the ids of the days since then are read, however long the stream runs. A batch that is run again reads what came
    before it and writes the same folders.
    """

    ACCEPTED, SEEN = "accepted", "seen"

    def __init__(self, spark: SparkSession, path: str, days: int, until: str | None = None):
        self.spark, self.path, self.days = spark, path, days
        self.until = F.expr("localtimestamp() + interval 1 day") if until is None else F.lit(until).cast("timestamp_ntz")

    def take(self, deliveries: DataFrame, number: int) -> None:
        folder = lambda name: f"{self.path}/{name}"
        staged = stage(deliveries.select("delivery_id", "raw"))
        staged.write.mode("overwrite").parquet(f"{folder('landed')}/batch={number}")
        staged = self.spark.read.schema(staged.schema).parquet(f"{folder('landed')}/batch={number}")
        mark = self._mark(number - 1)
        timed = F.coalesce(F.col("submitted_at") <= self.until, F.lit(False))
        old = F.lit(False) if mark is None else F.col("submitted_at") < F.date_sub(F.lit(mark), self.days)
        reason = F.when(~timed, "undated").when(old, "late")
        staged = staged.withColumn("reason", reason)
        # of a delivery's copies in one batch the least document counts
        aside = staged.where("reason IS NOT NULL")
        aside.write.mode("overwrite").parquet(f"{folder('aside')}/batch={number}")
        rows = staged.where("reason IS NULL").drop("reason")
        first = rows.groupBy("delivery_id").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "delivery_id"]), "raw").alias("r"))
        first = first.select("delivery_id", "r.*")
        seen = self._seen(mark, number)
        if seen is not None:
            first = first.join(seen, "delivery_id", "left_anti")
        first.write.mode("overwrite").parquet(f"{folder(self.ACCEPTED)}/batch={number}")
        taken = self.spark.read.schema(first.schema).parquet(f"{folder(self.ACCEPTED)}/batch={number}")
        ids = taken.select("delivery_id", F.to_date("submitted_at").alias("day"))
        ids.write.mode("overwrite").partitionBy("day").parquet(f"{folder(self.SEEN)}/batch={number}")
        newest = taken.select(F.greatest(F.max(F.to_date("submitted_at")), F.lit(mark).cast("date")).alias("day"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{folder('marks')}/batch={number}")

    def _mark(self, number: int):
        """The latest day of submission up to a batch; each batch's mark takes in those before."""
        return self.spark.read.parquet(f"{self.path}/marks/batch={number}").first()["day"] if number >= 0 else None

    def _seen(self, mark, number: int) -> DataFrame | None:
        """Ids of the days since the watermark, of the batches before this one. Batches whose last day is older hold
        none: their mark says so, and they are passed over."""
        if mark is None:
            return None
        first = mark - timedelta(days=self.days)
        folders = []
        for earlier in range(number - 1, -1, -1):
            days = [n for n in names(self.spark, f"{self.path}/{self.SEEN}/batch={earlier}") if n.startswith("day=")]
            folders += [f"{self.path}/{self.SEEN}/batch={earlier}/{d}" for d in days if d[4:] >= str(first)]
            if (latest := self._mark(earlier)) is not None and latest < first:
                break
        return self.spark.read.schema("delivery_id bigint").parquet(*folders) if folders else None

    def run(self, deliveries: DataFrame, checkpoint: str) -> StreamingQuery:
        stream = deliveries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.take)
        return stream.trigger(availableNow=True).start()

    def accepted(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.ACCEPTED}").drop("batch")

    def aside(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/aside").drop("batch")


def deliveries(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of (delivery_id, raw) landing in a folder."""
    reader = spark.readStream.schema("delivery_id bigint, raw string")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
