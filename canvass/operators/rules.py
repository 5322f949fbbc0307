"""Audits of submissions against their survey's own rules, evaluated inside each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.text import base_poll_id, eligible, id_list
from canvass.sources.responses import elements


def _given(responses: DataFrame) -> DataFrame:
    """Submissions with a map question → answer. Answers without a value are as good as absent; of two answers to one
    question the first counts."""
    present = F.filter("answers", lambda a: a["kind"] != "none")
    entries = F.transform(
        present,
        lambda a: F.struct(
            a["question"].alias("key"),
            F.struct(
                a["kind"].alias("kind"),
                a["elements"].alias("elements"),
                a["write_in"].alias("write_in"),
                F.to_json(a["answer"]).alias("json"),
            ).alias("value"),
        ),
    )
    named = responses.select("ingestion_id", "poll_id", F.filter(entries, lambda e: e["key"].isNotNull()).alias("e"))
    first = F.filter("e", lambda e, i: F.array_position("e.key", e["key"]) == i + 1)
    return named.select("ingestion_id", "poll_id", F.map_from_entries(first).alias("given"))


def _asked(responses: DataFrame, logic: DataFrame) -> DataFrame:
    """One row per submission and question of `logic`, with the answers the audit looks at."""
    return _looked_up(_given(responses).join(logic, "poll_id"))


def _looked_up(rows: DataFrame) -> DataFrame:
    """Add the question's answer and those that its page's rule, its own rule and its carried list refer to."""
    answer_to = lambda key: F.try_element_at("given", F.coalesce(F.col(key), F.lit("")))
    return rows.select(
        *[c for c in rows.columns if c != "given"],
        answer_to("question_key").alias("answer"),
        answer_to("page_show_if.question").alias("page_answer"),
        answer_to("show_if.question").alias("rule_answer"),
        answer_to("options_from").alias("earlier"),
    )


def _holds(rule: Column, answer: Column) -> Column:
    """A show-if rule on the answer it names. Unknown operators and absent rules hold."""
    is_list = F.coalesce(answer["kind"] == "array", F.lit(False))
    listed = F.coalesce(F.array_contains(rule["list"], answer["json"]), F.lit(False)) & ~is_list
    texts = F.transform(answer["elements"], lambda e: F.to_json(e.cast("variant")))
    op = rule["op"]
    return (
        F.when(rule.isNull(), True)
        .when(op == "equals", F.coalesce(answer["json"] == rule["value"], F.lit(False)) & ~is_list)
        .when(op == "in", listed)
        .when(op == "not_in", rule["list"].isNotNull() & ~listed)
        .when(op == "is_set", F.coalesce(answer["json"] != '""', F.lit(False)))
        .when(op == "array_contains", is_list & F.coalesce(F.arrays_overlap(texts, rule["list"]), F.lit(False)))
        .otherwise(True)
    )


def _page_open() -> Column:
    return F.col("page_no").isNotNull() & _holds(F.col("page_show_if"), F.col("page_answer"))


def _rule_open() -> Column:
    return _holds(F.col("show_if"), F.col("rule_answer"))


ROW = ["ingestion_id", "poll_id", "question_key"]


def hidden_answers(responses: DataFrame, logic: DataFrame) -> DataFrame:
    """Answers to questions that were not on show, with the reason; polls without a definition are left out."""
    defined = logic.select("poll_id").distinct()
    answered = (
        _given(responses)
        .join(defined, "poll_id", "left_semi")
        .select("ingestion_id", "poll_id", "given", F.explode(F.map_keys("given")).alias("question_key"))
    )
    rows = _looked_up(answered.join(logic, ["poll_id", "question_key"], "left"))
    reason = (
        F.when(F.col("question_type").isNull(), "unknown question")
        .when(~_page_open(), "page hidden")
        .when(~_rule_open(), "question hidden")
    )
    return rows.select(*ROW, reason.alias("reason")).where(F.col("reason").isNotNull())


def incomplete_required(responses: DataFrame, logic: DataFrame) -> DataFrame:
    """Required questions on show that were not answered, with too few choices and no catch-all among them, or whose
    write-in choice came without text: a single answer then keeps the choice's own value, a list has nothing typed."""
    picked = F.col("answer.elements")
    caught = F.filter("options", lambda o: o["is_catch_all"])
    catch_all = F.coalesce(F.arrays_overlap(picked, caught["value"]), F.lit(False)) | F.coalesce(
        F.col("answer.write_in") & F.array_contains(caught["write_in"], True), F.lit(False)
    )
    bare = F.arrays_overlap(picked, F.filter("options", lambda o: o["write_in"])["value"])
    nothing_typed = F.size(F.array_except(picked, F.col("options.value"))) == 0
    flagged = F.coalesce(F.col("answer.write_in"), F.lit(False))
    least = F.greatest(F.coalesce("min_select", F.lit(1)), F.lit(1))
    multi = F.col("question_type") == "multi"
    absent = F.col("answer").isNull()
    no_choice = absent | (F.col("answer.kind") != "array") | (F.size(picked) == 0)
    reason = (
        F.when(multi & no_choice, "missing")
        .when(multi & ~catch_all & (F.size(picked) < least), "too few")
        .when(~multi & (absent | (F.col("answer.json") == '""')), "missing")
        .when(F.coalesce(bare | (multi & flagged & nothing_typed), F.lit(False)), "blank write-in")
    )
    shown = _asked(responses, logic.where("is_required")).where(_page_open() & _rule_open())
    return shown.select(*ROW, reason.alias("reason")).where(F.col("reason").isNotNull())


def not_offered_options(responses: DataFrame, logic: DataFrame) -> DataFrame:
    """Choices that a carried-forward list did not offer; catch-alls, exclusives and typed text are always allowed."""
    always = F.filter("options", lambda o: o["is_catch_all"] | o["exclusive"])["value"]
    offered = F.concat(always, F.coalesce("earlier.elements", F.array().cast("array<string>")))
    extra = F.array_except(F.col("answer.elements"), offered)
    listed = F.when(F.col("answer.write_in"), F.array_intersect(extra, F.col("options.value"))).otherwise(extra)
    carried = _asked(responses, logic.where("options_from IS NOT NULL")).where(F.col("answer").isNotNull())
    return carried.select(*ROW, F.explode(listed).alias("option_value"))


def exclusive_conflicts(responses: DataFrame, logic: DataFrame) -> DataFrame:
    """List answers in which an exclusive choice stands beside others."""
    sole = F.filter("options", lambda o: o["exclusive"])["value"]
    picked = F.col("answer.elements")
    found = F.array_sort(F.array_intersect(sole, picked))
    with_sole = logic.where(F.exists("options", lambda o: o["exclusive"]))
    several = _asked(responses, with_sole).where((F.size(picked) > 1) & F.arrays_overlap(picked, sole))
    return several.select(
        *ROW, F.array_join(found, ", ").alias("exclusive"), F.size(picked).cast("long").alias("choices")
    )


def write_ins(responses: DataFrame, options: DataFrame) -> DataFrame:
    """Text typed into a write-in choice: values of a write-in answer that are no catalog option."""
    typed = elements(responses).where("write_in").withColumnRenamed("answer_value", "option_value")
    catalog = options.where("option_source = 'catalog'").select("poll_id", "question_key", "option_value")
    return typed.join(catalog, ["poll_id", "question_key", "option_value"], "left_anti").select(
        "ingestion_id", "poll_id", "question_key", F.col("option_value").alias("write_in_text")
    )


def open_polls(respondents: DataFrame, tokens: DataFrame, polls: DataFrame) -> DataFrame:
    """Polls a respondent may still take: eligible by token, and not completed under its id or base id.

    respondents (respondent_id, completed text), tokens (respondent_id, flag, token), polls (poll_id, flag).
    """
    listed = F.array_distinct(
        F.flatten(F.transform(id_list(F.col("completed")), lambda v: F.array(v, base_poll_id(v))))
    )
    done = respondents.select("respondent_id", F.explode(listed).alias("done")).distinct()
    candidates = (
        tokens.where(eligible(F.col("token")))
        .select("respondent_id", "flag")
        .distinct()
        .join(polls.select("poll_id", "flag"), "flag")
        .select("respondent_id", "poll_id", base_poll_id(F.col("poll_id")).alias("base"))
    )
    by_id = done.withColumnRenamed("done", "poll_id")
    by_base = done.withColumnRenamed("done", "base")
    return (
        candidates.join(by_id, ["respondent_id", "poll_id"], "left_anti")
        .join(by_base, ["respondent_id", "base"], "left_anti")
        .select("respondent_id", "poll_id")
    )


def page_funnel(clicks: DataFrame) -> DataFrame:
    """Distinct respondents per poll and button: Q1 … Qn in page order, then Submit.

    A respondent counts once per button however often it is pressed.
    """
    page = F.regexp_extract("button", "^Q([0-9]+)$", 1)
    submitted = F.col("button") == "Submit"
    step = F.when(submitted, F.lit(2**31 - 1)).otherwise(F.try_to_number(page, F.lit("999999999")).cast("int"))
    return (
        clicks.where((page != "") | submitted)
        .groupBy("poll_id", "button")
        .agg(F.countDistinct("respondent_id").alias("respondents"))
        .withColumn("step", step)
    )
