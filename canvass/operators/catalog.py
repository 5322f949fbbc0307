"""Read queries over questions, options and taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["poll_id", "question_key"]
# Question types that are classified option by option.
CHOICE_TYPES = ["single", "multi"]


def survey_catalog(questions: DataFrame, options: DataFrame, poll_id: str | None = None) -> DataFrame:
    """Catalog options with their question; text questions drop out because they have none."""
    rows = questions.join(options.where("option_source = 'catalog'"), KEYS)
    if poll_id is not None:
        rows = rows.where(F.col("poll_id") == poll_id)
    return rows.select(
        *KEYS,
        "question_type",
        "question_text",
        "option_id",
        "option_value",
        "option_label",
        "option_description",
        "is_catch_all",
        "sort_order",
    ).orderBy(*KEYS, F.asc_nulls_last("sort_order"), "option_value")


def catalog_documents(catalog: DataFrame) -> DataFrame:
    """The catalog as one JSON list per poll, in catalog order. A definition bounds the list."""
    entry = F.struct(
        "question_key",
        F.coalesce("sort_order", F.lit(2**62)).alias("o"),
        "option_value",
        "question_text",
        "option_label",
        "is_catch_all",
    )
    shaped = F.transform(
        F.sort_array(F.collect_list(entry)),
        lambda e: F.struct(
            e["question_key"], e["question_text"], e["option_value"], e["option_label"], e["is_catch_all"]
        ),
    )
    return catalog.groupBy("poll_id").agg(F.count("*").alias("total_rows"), F.to_json(shaped).alias("options"))


def taxonomy_rows(
    taxonomy: DataFrame,
    options: DataFrame,
    poll_id: str | None = None,
    bucket: str | None = None,
    min_confidence: float | None = None,
    option_source: str | None = None,
    first_level: str | None = None,
) -> DataFrame:
    """Taxonomy rows with their option; every filter is optional."""
    if poll_id is not None:
        options = options.where(F.col("poll_id") == poll_id)
    if option_source in ("catalog", "response"):
        options = options.where(F.col("option_source") == option_source)
    if bucket is not None:
        taxonomy = taxonomy.where(F.lower("bucket") == bucket.lower())
    if min_confidence is not None:
        taxonomy = taxonomy.where(F.col("confidence") >= min_confidence)
    if first_level is not None:
        taxonomy = taxonomy.where(F.get("taxonomy_levels", F.lit(0)) == first_level)
    named = options.select("option_id", *KEYS, "option_value", "option_source")
    return (
        taxonomy.join(named, "option_id")
        .select(
            *KEYS,
            "option_value",
            "option_source",
            "bucket",
            "taxonomy_path",
            "taxonomy_depth",
            "taxonomy_levels",
            "demographic_key",
            "demographic_value",
            "demographic_type",
            "confidence",
            "is_approved",
            "updated_at",
        )
        .orderBy("poll_id", "bucket", "question_key", "option_value")
    )


def taxonomy_counts(taxonomy: DataFrame) -> DataFrame:
    return (
        taxonomy.where("bucket = 'demographic'")
        .groupBy("demographic_key", "demographic_value", "demographic_type")
        .agg(F.count("*").alias("options"))
    )


def text_answers(
    options: DataFrame,
    questions: DataFrame,
    taxonomy: DataFrame,
    poll_id: str | None = None,
    unclassified_only: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Typed answers in key order: all, or the first `limit` of them."""
    rows = options.where("option_source = 'response'")
    if poll_id is not None:
        rows = rows.where(F.col("poll_id") == poll_id)
    if unclassified_only:
        rows = rows.join(taxonomy, "option_id", "left_anti")
    named = questions.select(*KEYS, "question_text", "question_type")
    ordered = (
        rows.join(named, KEYS)
        .select("option_id", *KEYS, "option_value", "question_text", "question_type")
        .orderBy(*KEYS, "option_value", "option_id")
    )
    return ordered if limit is None else ordered.limit(limit)


def catalog_view(questions: DataFrame, options: DataFrame) -> DataFrame:
    """The retired one-table shape of the catalog."""
    return questions.select(*KEYS, "question_text").join(options.where("option_source = 'catalog'"), KEYS).select(
        *KEYS, "question_text", "option_value", "option_label", "is_catch_all", "updated_at"
    )


def seed_dimensions(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Questions (all single choice until the next sync) and options from the retired shape."""
    questions = flat.groupBy(*KEYS).agg(F.max("question_text").alias("question_text"))
    return (
        questions.withColumn("question_type", F.lit("single")),
        flat.select(*KEYS, "option_value", F.lit("catalog").alias("option_source"), "option_label", "is_catch_all"),
    )


def rekey_taxonomy(by_value: DataFrame, options: DataFrame) -> DataFrame:
    """Taxonomy rows keyed by (poll, question, value) moved to option ids; rows without an option are dropped."""
    named = options.select("option_id", *KEYS, "option_value")
    return by_value.join(named, [*KEYS, "option_value"]).drop(*KEYS, "option_value")
