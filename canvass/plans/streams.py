"""Stream jobs over the adapter's documents: written as files, read back as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.session import shared_dir
from canvass.sources.adapter import Survey
from canvass.sources.responses import stage
from canvass.streaming import live


def live_option_counts(survey: Survey) -> DataFrame:
    """Counters after all files are taken in, a few files a batch."""
    folder = shared_dir(survey.spark, "live-counts")
    survey.landed.select("raw").repartition(6).write.text(f"{folder}/landing")
    arriving = live.raw_stream(survey.spark, f"{folder}/landing", files_per_batch=2)
    table = live.counter_table(survey.spark, f"{folder}/counts", buckets=8, every=2)
    live.run_option_counts(stage(arriving), table, f"{folder}/checkpoint").awaitTermination()
    return table.read()


def live_option_stats(survey: Survey) -> DataFrame:
    return live.option_stats(live_option_counts(survey))


def delivered_once(survey: Survey) -> DataFrame:
    """Where each delivery ended up. First come the submissions from 10 January on, every tenth of them twice; then the
    earlier ones, and another tenth of the first once more. The watermark is 14 days behind the latest submission."""
    spark, folder = survey.spark, shared_dir(survey.spark, "deliveries")
    key = F.col("ingestion_id")
    day = F.to_date(F.get_json_object("raw", "$.submitted_at").try_cast("timestamp"))
    rows = survey.landed.select(key.alias("delivery_id"), "raw", (day >= F.lit("2024-01-10").cast("date")).alias("first"))
    again = lambda r: F.col("delivery_id") % 10 == r
    waves = [rows.where("first"), rows.where("not first").union(rows.where(F.col("first") & again(4)))]
    waves[0] = waves[0].union(rows.where(F.col("first") & again(3)))
    intake = live.Intake(spark, f"{folder}/intake", days=14, until="2024-12-31")
    for n, wave in enumerate(waves):
        wave.select("delivery_id", "raw").write.mode("append").parquet(f"{folder}/landing/wave={n}")
        arriving = live.deliveries(spark, f"{folder}/landing/*")
        intake.run(arriving, f"{folder}/checkpoint").awaitTermination()
    accepted = intake.accepted().groupBy("delivery_id").agg(F.count("*").alias("n")).withColumn("place", F.lit("accepted"))
    aside = intake.aside().groupBy("delivery_id", F.col("reason").alias("place")).agg(F.count("*").alias("n"))
    return accepted.unionByName(aside).select("delivery_id", "place", "n")
