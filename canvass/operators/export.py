"""One row per submission: readable answers, identity source and demographics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.text import blank_to_null, not_blank
from canvass.operators.catalog import KEYS

DEMOGRAPHICS = [
    "age_band",
    "generation",
    "income_hh",
    "net_worth_hh",
    "education",
    "occupation_category",
    "marital_status",
    "home_owner",
    "ethnic_group",
    "has_children_hh",
    "gender",
    "state",
    "dma",
    "affinity_investor",
    "affinity_homeowner",
]


def _wording(questions: DataFrame, options: DataFrame) -> DataFrame:
    """One row per poll: names (question → text) and labels ((question, value) → label, catch-all).

    An authored definition bounds both maps.
    """
    names = (
        questions.groupBy(*KEYS)
        .agg(F.max("question_text").alias("text"))
        .groupBy("poll_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("question_key", "text"))).alias("names"))
    )
    label = F.struct(F.max("option_label").alias("label"), F.bool_or("is_catch_all").alias("catch_all"))
    labels = (
        options.where("option_source = 'catalog'")
        .groupBy(*KEYS, "option_value")
        .agg(label.alias("label"))
        .groupBy("poll_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.struct("question_key", "option_value").alias("key"), "label"))
            ).alias("labels")
        )
    )
    return names.join(labels, "poll_id", "full")


def _answers() -> Column:
    """map(question text, answers joined by ', ') of one submission; catch-alls and blanks dropped, keys sorted."""
    values = F.flatten(
        F.transform(
            "answers",
            lambda a: F.transform(
                F.coalesce(a["elements"], F.array().cast("array<string>")),
                lambda v: F.struct(a["question"].alias("question_key"), v.alias("option_value")),
            ),
        )
    )
    labelled = F.transform(
        values,
        lambda v: F.struct(
            F.coalesce(F.try_element_at("names", v["question_key"]), v["question_key"]).alias("q"),
            F.coalesce(F.try_element_at("labels", v)["label"], v["option_value"]).alias("label"),
            F.coalesce(F.try_element_at("labels", v)["catch_all"], F.lit(False)).alias("catch_all"),
        ),
    )
    shown = F.filter(labelled, lambda p: ~p["catch_all"] & p["q"].isNotNull() & not_blank(p["label"]))
    return F.array_sort(F.array_distinct(F.transform(shown, lambda p: F.struct(p["q"], p["label"]))))


def answer_maps(responses: DataFrame, questions: DataFrame, options: DataFrame) -> DataFrame:
    """The submissions with their answers as a map, formed inside the row: the wording of the poll is joined to it."""
    pairs = responses.join(_wording(questions, options), "poll_id", "left").withColumn("pairs", _answers())
    texts = F.transform(
        F.array_distinct(F.col("pairs.q")),
        lambda q: F.struct(
            q.alias("key"),
            F.array_join(F.filter("pairs", lambda p: p["q"] == q).getField("label"), ", ").alias("value"),
        ),
    )
    return pairs.withColumn("answers", F.map_from_entries(texts)).drop("names", "labels", "pairs")


def response_demographics(
    responses: DataFrame,
    questions: DataFrame,
    options: DataFrame,
    identity: DataFrame,
    demographics: DataFrame,
) -> DataFrame:
    """The export. The market is the publication seen in the events, else the one in the payload."""
    market = blank_to_null(F.col("market_name")).alias("payload_market")
    base = answer_maps(responses, questions, options).select(
        "ingestion_id", "poll_id", "submitted_at", market, "answers"
    )
    who = identity.select("ingestion_id", "hem", "hem_source", "publication_name")
    # Unresolved submissions would all meet in one NULL partition; their id, never a 64-digit hash, spreads them.
    spread = F.coalesce("hem", F.col("ingestion_id").cast("string"))
    persons = demographics.select(F.col("hem").alias("respondent"), *DEMOGRAPHICS)
    empty = F.create_map().cast("map<string,string>")
    return (
        base.join(who, "ingestion_id", "left")
        .withColumn("respondent", spread)
        .join(persons, "respondent", "left")
        .select(
            "ingestion_id",
            "poll_id",
            "submitted_at",
            F.coalesce("publication_name", "payload_market").alias("market_name"),
            F.col("hem_source").alias("identity_source"),
            *DEMOGRAPHICS,
            F.coalesce("answers", empty).alias("answers"),
        )
    )
