"""Raw submissions: landing, typed staging, and the two row forms of their answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.text import not_blank, normalised
from canvass.sources.schemas import SUBMISSION


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per line, kept as text."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def stage(raw: DataFrame) -> DataFrame:
    """Type the documents once: (ingestion_id, raw) → poll, device, market, time and the answer list.

    `answers` is an array of structs whose `answer` stays VARIANT; `kind` is its run-time type and `elements` the
    text of a string (one entry) or of each entry of a list. Other kinds have no elements, so the set-based queries
    never see them. Written to parquet, later jobs read only the columns they use and parse no JSON again.
    """
    kept = [c for c in raw.columns if c not in ("poll_id", "submitted_at")]
    return raw.select(*kept, once(F.from_json("raw", SUBMISSION))).select(
        *kept,
        "poll_id",
        F.expr("try_cast(submitted_at AS timestamp_ntz)").alias("submitted_at"),
        "device_id",
        "external_id",
        "market_name",
        "variant",
        F.transform(F.transform("answers", _fields), _answer).alias("answers"),
    )


def once(doc: Column) -> Column:
    """The fields of a parsed document as columns. As a generator it is not merged into the expressions that use the
    fields, which would parse the text again for each of them."""
    return F.inline(F.array(doc))


def _fields(entry: Column, pos: Column) -> Column:
    answer = F.variant_get(entry, "$.answer", "variant")
    return F.struct(
        pos.alias("pos"),
        F.try_variant_get(entry, "$.question", "string").alias("question"),
        answer.alias("answer"),
        F.schema_of_variant(answer).alias("schema"),
        F.try_variant_get(entry, "$.type", "string").alias("type"),
        F.to_json(F.variant_get(entry, "$.write_in", "variant")).alias("write_in"),
    )


def _answer(f: Column) -> Column:
    schema, answer = f["schema"], f["answer"]
    return F.struct(
        f["pos"].alias("pos"),
        f["question"].alias("question"),
        answer.alias("answer"),
        F.when(schema == "STRING", "string")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema != "VOID", "other")
        .otherwise("none")
        .alias("kind"),
        F.when(schema == "STRING", F.array(F.variant_get(answer, "$", "string")))
        .when(schema.startswith("ARRAY"), F.try_variant_get(answer, "$", "array<string>"))
        .alias("elements"),
        f["type"].alias("type"),
        F.coalesce(~f["write_in"].isin("false", "null", "0", '""'), F.lit(False)).alias("write_in"),
    )


def rejects(raw: DataFrame) -> DataFrame:
    """Documents that are no JSON object with a poll id."""
    doc = F.from_json("raw", "poll_id string")
    return raw.where(F.try_parse_json("raw").isNull() | doc["poll_id"].isNull())


def answers(responses: DataFrame, *keep: str) -> DataFrame:
    """One row per answer with its page position; submissions without answers vanish."""
    return responses.select("ingestion_id", "poll_id", *keep, F.explode("answers").alias("a")).select(
        "ingestion_id",
        "poll_id",
        *keep,
        F.col("a.pos").alias("pos"),
        F.col("a.question").alias("question_key"),
        F.col("a.kind").alias("kind"),
        F.col("a.elements").alias("elements"),
        F.col("a.type").alias("type"),
        F.col("a.write_in").alias("write_in"),
    )


def elements(responses: DataFrame, *keep: str) -> DataFrame:
    """One row per chosen value: strings as they are, lists one row per entry, other kinds none."""
    rows = answers(responses, *keep)
    return rows.select(
        *[c for c in rows.columns if c != "elements"], F.explode("elements").alias("answer_value")
    )


def option_keys(kind: Column, value: Column) -> Column:
    """The (source, value) pairs an answer can match: the catalog by exact text, typed text also normalised."""
    exact = F.struct(F.lit("catalog").alias("option_source"), value.alias("option_value"))
    typed = F.struct(F.lit("response").alias("option_source"), normalised(value).alias("option_value"))
    return F.when((kind == "string") & not_blank(value), F.array(exact, typed)).otherwise(F.array(exact))
