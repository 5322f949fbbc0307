"""Answers → options → taxonomy → one profile per device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.sources.responses import elements, option_keys

# Profile property of each taxonomy bucket that carries paths.
PATH_PROPERTIES = {"consumption": "consumption_insights", "preference": "preference_insights"}

RULE = ["bucket", "taxonomy_path", "demographic_key", "demographic_value"]


def answer_options(responses: DataFrame, options: DataFrame, keep_blank_device: bool = False) -> DataFrame:
    """Every answer of a known device resolved to option ids: (ingestion_id, device_id, pos, option_id).

    The three routes (single choice, normalised text, list entry) are one explode and one join: each value carries
    the keys it may match, so the submissions are read once. The next step regroups by submission, so a hot option
    can be split by the adaptive skew join; the options side is broadcast only if measured to be small.
    """
    known = responses.where(F.col("device_id").isNotNull())
    if not keep_blank_device:
        known = known.where(F.col("device_id") != "")
    keyed = (
        elements(known, "device_id")
        .where(F.col("answer_value").isNotNull())
        .select(
            "ingestion_id",
            "device_id",
            "pos",
            "poll_id",
            "question_key",
            F.explode(option_keys(F.col("kind"), F.col("answer_value"))).alias("k"),
        )
        .select("ingestion_id", "device_id", "pos", "poll_id", "question_key", "k.*")
    )
    dim = options.select("option_id", "poll_id", "question_key", "option_source", "option_value")
    return keyed.join(dim, ["poll_id", "question_key", "option_source", "option_value"]).select(
        "ingestion_id", "device_id", "pos", "option_id"
    )


def _offered(taxonomy: DataFrame, options: DataFrame) -> DataFrame:
    """Rules on options that are no catch-all (a NULL flag counts as one, as in the profile view)."""
    return taxonomy.join(options.where(~F.col("is_catch_all")).select("option_id"), "option_id", "left_semi")


def _unconditional() -> Column:
    return F.col("condition_sequence").isNull() | (F.size("condition_sequence") == 0)


def unconditional_taxonomy(answered: DataFrame, taxonomy: DataFrame, options: DataFrame) -> DataFrame:
    """One row per answered option and rule without prerequisites."""
    rules = _offered(taxonomy, options).where(_unconditional()).select("option_id", *RULE)
    return answered.join(rules, "option_id").select("ingestion_id", "device_id", *RULE)


def applied_rules(
    answered: DataFrame, taxonomy: DataFrame, options: DataFrame, strict_order: bool = False
) -> DataFrame:
    """Rules that hold for a submission, with and without prerequisites.

    Rules without any are a plain join: one row per answer and rule. Only answers that a conditional rule names, as its
    target or as a prerequisite, are regrouped by submission; they are a bounded group (one document) and travel as one
    list, so one shuffle on the unique submission id replaces a self join, a window and a second grouping.
    A rule with prerequisites holds, once, if all are answered and their first positions strictly ascend; a single
    prerequisite is a presence test. With `strict_order` the answer itself must come after its last prerequisite.
    """
    offered = _offered(taxonomy, options)
    plain = offered.where(_unconditional()).select("option_id", *RULE)
    always = answered.join(plain, "option_id").select("ingestion_id", "device_id", *RULE)
    return always.union(_conditional(answered, offered.where(~_unconditional()), strict_order))


def _conditional(answered: DataFrame, offered: DataFrame, strict_order: bool) -> DataFrame:
    rules = offered.select("option_id", *RULE, F.col("condition_sequence").alias("needs"))
    used = rules.select("option_id").union(rules.select(F.explode("needs"))).distinct()
    picked = (
        answered.join(used, "option_id", "left_semi")
        .groupBy("ingestion_id", "device_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "option_id"))).alias("picked"))
    )
    targets = picked.select(
        "ingestion_id",
        "device_id",
        "picked",
        F.explode(F.array_distinct(F.col("picked.option_id"))).alias("option_id"),
    )

    def first_pos(option_id: Column) -> Column:
        # F.get gives NULL, not an error, for a prerequisite that was not answered
        return F.get(F.filter("picked", lambda p: p["option_id"] == option_id), F.lit(0))["pos"]

    wanted = F.concat("needs", F.array("option_id")) if strict_order else F.col("needs")
    positions = F.transform(wanted, first_pos)
    joined = targets.join(rules, "option_id").withColumn("positions", positions)
    # strictly ascending and complete: equal to its own sorted distinct values, none of them NULL
    ascending = (F.array_sort(F.array_distinct("positions")) == F.col("positions")) & F.forall(
        "positions", lambda p: p.isNotNull()
    )
    return joined.where(ascending).select("ingestion_id", "device_id", *RULE)


def conditional_taxonomy(
    answered: DataFrame, taxonomy: DataFrame, options: DataFrame, strict_order: bool = False
) -> DataFrame:
    return _conditional(answered, _offered(taxonomy, options).where(~_unconditional()), strict_order)


def approved(taxonomy: DataFrame) -> DataFrame:
    """Only rules a person has approved; the profile takes all rules unless given this."""
    return taxonomy.where("is_approved")


def profile_sync(
    responses: DataFrame, options: DataFrame, taxonomy: DataFrame, keep_blank_device: bool = False
) -> DataFrame:
    """(device_id, user_property, user_property_value): path lists as JSON text, demographics one row per value."""
    rules = applied_rules(answer_options(responses, options, keep_blank_device), taxonomy, options)
    demographic = F.col("bucket") == "demographic"
    prop = F.when(demographic, F.col("demographic_key"))
    for bucket, name in PATH_PROPERTIES.items():
        prop = prop.when((F.col("bucket") == bucket) & F.col("taxonomy_path").isNotNull(), F.lit(name))
    facts = rules.select(
        "device_id",
        demographic.alias("single"),
        prop.alias("user_property"),
        F.when(demographic, F.col("demographic_value")).alias("value"),
        F.when(~demographic, F.col("taxonomy_path")).alias("path"),
    ).where(F.col("user_property").isNotNull())
    # Distinct first, so the list of a shared device holds each path once: it is bounded by the taxonomy.
    lists = facts.distinct().groupBy("device_id", "single", "user_property", "value").agg(
        F.to_json(F.sort_array(F.collect_list("path"))).alias("paths")
    )
    value = F.when(F.col("single"), F.col("value")).otherwise(F.col("paths"))
    return lists.select("device_id", "user_property", value.alias("user_property_value"))


def profile_summary(profile: DataFrame) -> DataFrame:
    return profile.groupBy("user_property").agg(
        F.count("*").alias("row_cnt"), F.countDistinct("device_id").alias("devices")
    )


def device_attributes(
    responses: DataFrame, options: DataFrame, taxonomy: DataFrame, device_id: str | None = None
) -> DataFrame:
    """Simple profile: single-choice catalog answers only, paths or 'key = value', no conditions."""
    if device_id is not None:
        responses = responses.where(F.col("device_id") == device_id)
    chosen = (
        elements(responses, "device_id")
        .where(F.col("kind") == "string")
        .select("device_id", "poll_id", "question_key", F.col("answer_value").alias("option_value"))
        .distinct()
    )
    dim = options.where("option_source = 'catalog'").select("option_id", "poll_id", "question_key", "option_value")
    attribute = F.coalesce(
        "taxonomy_path", F.concat(F.col("demographic_key"), F.lit(" = "), F.col("demographic_value"))
    )
    return (
        chosen.join(dim, ["poll_id", "question_key", "option_value"])
        .join(taxonomy, "option_id")
        .select("device_id", "bucket", attribute.alias("profile_attribute"))
        .distinct()
    )
