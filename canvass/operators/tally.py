"""Counts of answers per question, their percents, and ordered pairs of answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions.measures import percent
from canvass.sources.responses import answers


def _counts(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts per (poll, question, kind, value) and the page order of each question.

    Both come from one aggregation over the answers; the order reads its (small) result again, so the shuffle is
    reused. Answers without elements keep one row: they count for the order but not for the tally.
    """
    rows = answers(responses).select(
        "poll_id", "question_key", "kind", "pos", F.posexplode_outer("elements").alias("i", "answer_value")
    )
    grouped = rows.groupBy("poll_id", "question_key", "kind", "answer_value").agg(
        F.count("i").alias("response_count"), F.min("pos").alias("first_pos")
    )
    order = grouped.groupBy("poll_id", "question_key").agg(F.min("first_pos").alias("question_order"))
    return grouped.where("response_count > 0").drop("first_pos"), order


def _totals(responses: DataFrame) -> DataFrame:
    return responses.groupBy("poll_id").agg(F.count("*").alias("total_responses"))


def _labelled(counts: DataFrame, questions: DataFrame, options: DataFrame) -> DataFrame:
    names = questions.select("poll_id", "question_key", "question_text")
    labels = options.where("option_source = 'catalog'").select(
        "poll_id", "question_key", F.col("option_value").alias("answer_value"), "option_label"
    )
    return counts.join(names, ["poll_id", "question_key"], "left").join(
        labels, ["poll_id", "question_key", "answer_value"], "left"
    )


def _one_poll(responses: DataFrame, poll_id: str | None) -> DataFrame:
    return responses if poll_id is None else responses.where(F.col("poll_id") == poll_id)


def response_tally(
    responses: DataFrame, questions: DataFrame, options: DataFrame, poll_id: str | None = None
) -> DataFrame:
    """Tally with percent of submissions (a multi-choice question can sum to more than 100)."""
    responses = _one_poll(responses, poll_id)
    counts, _ = _counts(responses)
    return (
        _labelled(counts, questions, options)
        .join(_totals(responses), "poll_id")
        .select(
            "poll_id",
            "total_responses",
            F.coalesce("question_text", "question_key").alias("question"),
            F.coalesce("option_label", "answer_value").alias("answer"),
            "response_count",
            percent(F.col("response_count"), F.col("total_responses")).alias("pct"),
        )
    )


def report_tally(
    responses: DataFrame, questions: DataFrame, options: DataFrame, poll_id: str | None = None
) -> DataFrame:
    """Tally in survey order; `question_key` is kept to order equal question texts."""
    responses = _one_poll(responses, poll_id)
    counts, order = _counts(responses)
    return (
        _labelled(counts, questions, options)
        .join(_totals(responses), "poll_id")
        .join(order, ["poll_id", "question_key"], "left")
        .select(
            "poll_id",
            "total_responses",
            "question_key",
            F.coalesce("question_text", "question_key").alias("question"),
            "question_order",
            F.coalesce("option_label", "answer_value").alias("answer"),
            "response_count",
        )
    )


#: Buckets that the answers of a question are dealt out to by their digest.
DIGEST_BUCKETS = 4096


def tally_documents(tally: DataFrame, size: int) -> DataFrame:
    """The tally nested per question as JSON: [{answer, count, pct}, …] by descending count, `size` answers a document.

    A question's answers are numbered by digest and text: rank inside a bucket of the digest plus the bucket's offset.
    So a document has at most `size` answers however many the question has, and no task sees all of them. Documents without
    answers are left out.
    """
    group = ["poll_id", "question"]
    digest = F.conv(F.substring(F.md5(F.coalesce("answer", F.lit(""))), 1, 7), 16, 10).cast("int")
    rows = tally.withColumn("bucket", digest % DIGEST_BUCKETS)
    # at most DIGEST_BUCKETS rows a question
    sizes = rows.groupBy(*group, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.toDF("of_poll", "of_question", "of_bucket", "offset")
    rank = F.row_number().over(Window.partitionBy(*group, "bucket").orderBy("answer"))
    same = F.expr("poll_id <=> of_poll AND question <=> of_question AND bucket = of_bucket")
    rows = rows.withColumn("rank", rank).join(offsets, same)
    rows = rows.withColumn("part", F.floor((F.col("offset") + F.col("rank") - 1) / size).cast("int"))
    entry = F.struct(
        (-F.col("response_count")).alias("o"),
        F.col("answer").alias("answer"),
        F.col("response_count").alias("count"),
        F.col("pct").alias("pct"),
    )
    return rows.groupBy("poll_id", "total_responses", "question", "part").agg(
        F.to_json(
            F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["answer"], e["count"], e["pct"]))
        ).alias("answers")
    )


def answer_patterns(
    responses: DataFrame, options: DataFrame, poll_id: str | None = None, top: int | None = None
) -> DataFrame:
    """Ordered pairs of string answers to two questions with their counts, per poll: all, or the `top` most frequent.

    Pairs are formed inside each document, so no self join; they are counted before option ids are looked up.
    Ties are broken by the pair itself.
    """
    responses = _one_poll(responses, poll_id)
    texts = F.filter("answers", lambda a: a["kind"] == "string")

    def pairs_of(first):
        later = F.filter(texts, lambda b: (b["pos"] > first["pos"]) & (b["question"] != first["question"]))
        return F.transform(
            later,
            lambda b: F.struct(
                first["question"].alias("q1_key"),
                first["elements"][0].alias("q1_option"),
                b["question"].alias("q2_key"),
                b["elements"][0].alias("q2_option"),
            ),
        )

    pairs = responses.select("poll_id", F.explode(F.flatten(F.transform(texts, pairs_of))).alias("p")).select(
        "poll_id", "p.*"
    )
    pair = ["q1_key", "q1_option", "q2_key", "q2_option"]
    counted = pairs.groupBy("poll_id", *pair).agg(F.count("*").alias("co_count"))
    best = counted
    if top is not None:
        # row_number up to a fixed k: Spark keeps at most k rows per poll and task before the shuffle
        ranked = Window.partitionBy("poll_id").orderBy(F.desc("co_count"), *pair)
        best = counted.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).drop("rank")
    catalog = options.where("option_source = 'catalog'").select("poll_id", "question_key", "option_value", "option_id")
    for side in ("q1", "q2"):
        named = catalog.select(
            "poll_id",
            F.col("question_key").alias(f"{side}_key"),
            F.col("option_value").alias(f"{side}_option"),
            F.col("option_id").alias(f"{side}_option_id"),
        )
        best = best.join(named, ["poll_id", f"{side}_key", f"{side}_option"], "left")
    return best.select(
        "poll_id", "q1_key", "q1_option_id", "q1_option", "q2_key", "q2_option_id", "q2_option", "co_count"
    )
