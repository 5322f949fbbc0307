"""Survey definitions, classifier replies and form data derived from the test tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.sources.adapter import CHANNELS, Survey, device
from canvass.sources.responses import once

# The definition of the adapter's own polls: two conditional pages, a carried-forward list, an exclusive choice.
POLL_DEFINITION = {
    "version": 3,
    "pages": [
        {"page_id": "first", "groups": [{"questions": ["status", "flags"]}]},
        {
            "page_id": "second",
            "show_if_answer": {"question": "flags", "op": "array_contains", "values": ["A"]},
            "groups": [{"questions": ["rating"]}],
        },
        {
            "page_id": "third",
            "show_if_answer": {"question": "status", "op": "not_in", "values": ["P"]},
            "groups": [{"questions": ["note", "channel"]}],
        },
    ],
    "questions": {
        "status": {
            "type": "single",
            "question": "Order status?",
            "required": True,
            "options": [{"value": "O"}, {"value": "F"}, {"value": "P", "is_catch_all": True}],
        },
        "flags": {
            "type": "multi",
            "required": True,
            "min_select": 2,
            "options": [{"value": "A"}, {"value": "N", "exclusive": True}, {"value": "R", "is_catch_all": True}],
        },
        "note": {
            "type": "text",
            "question": "Brand note?",
            "show_if_answer": {"question": "status", "op": "equals", "values": "F"},
        },
        "rating": {"type": "rating", "question": "How was it?"},
        "channel": {
            "type": "single",
            "question": "Which channel?",
            "required": True,
            "options_from": "status",
            "options": [
                {"value": "Web"},
                {"value": "Store"},
                {"value": "Phone", "is_catch_all": True},
                {"value": "Other", "write_in": True},
            ],
        },
    },
}


def poll_items(survey: Survey) -> DataFrame:
    """One definition per poll; poll_3 lacks the rating question and is encoded twice."""
    short = {**POLL_DEFINITION, "questions": {k: v for k, v in POLL_DEFINITION["questions"].items() if k != "rating"}}
    poll = F.concat(F.lit("poll_"), F.substring("o_orderpriority", 1, 1))
    return (
        survey.table("orders")
        .select(poll.alias("id"))
        .distinct()
        .withColumn(
            "definition",
            F.when(F.col("id") == "poll_3", F.lit(json.dumps(json.dumps(short)))).otherwise(
                F.lit(json.dumps(POLL_DEFINITION))
            ),
        )
    )


def _list(*entries: Column) -> Column:
    return F.array(*entries)


def _option(value: Column, **fields) -> Column:
    types = {"is_catch_all": "boolean", "exclusive": "boolean"}
    as_col = lambda k, v: v if isinstance(v, Column) else F.lit(v).cast(types.get(k, "string"))
    return F.struct(value.alias("value"), *[as_col(k, v).alias(k) for k, v in fields.items()])


def catalog_items(survey: Survey) -> DataFrame:
    """One catalog item per part: most with a definition, some encoded twice, cut off, or in the retired layout."""
    key, size = F.col("p_partkey"), F.col("p_size")
    brand, kind = F.col("p_brand"), F.col("p_type")
    groups = lambda *names: _list(F.struct(_list(*[F.lit(n) for n in names]).alias("questions")))
    definition = F.to_json(
        F.struct(
            size.alias("version"),
            F.struct(
                _list(
                    _option(brand, label=brand, is_catch_all=None, exclusive=None),
                    _option(F.lit("None"), label=None, is_catch_all=True, exclusive=True),
                ).alias("brands")
            ).alias("option_sets"),
            _list(
                F.struct(F.lit("a").alias("page_id"), groups("kind").alias("groups")),
                F.struct(F.lit("b").alias("page_id"), groups("opinion", "why").alias("groups")),
            ).alias("pages"),
            F.struct(
                F.struct(
                    F.lit("multi").alias("type"),
                    F.concat(F.lit("Which "), kind, F.lit("?")).alias("question"),
                    F.lit("").alias("help_text"),
                    F.lit(True).alias("required"),
                    F.lit(2).alias("min_select"),
                    F.lit("brands").alias("options"),
                ).alias("kind"),
                F.struct(
                    F.lit("matrix").alias("type"),
                    F.lit("Opinion").alias("question"),
                    F.lit("per row").alias("help_text"),
                    F.split("p_name", " ").alias("rows"),
                    F.lit("kind").alias("rows_from"),
                    (size % 2 == 0).alias("required"),
                    (size % 3 != 0).alias("show_results"),
                    _list(
                        _option(F.lit("Good"), label="Good", description="fine"),
                        _option(F.lit("Bad"), label="Not good", description=None),
                    ).alias("options"),
                ).alias("opinion"),
                F.struct(
                    F.lit("text").alias("type"),
                    F.lit("Why?").alias("question"),
                    size.alias("max_length"),
                    F.concat(F.lit("about "), F.col("p_name")).alias("placeholder"),
                    F.lit(False).alias("auto_advance"),
                ).alias("why"),
            ).alias("questions"),
        )
    )
    twice = F.to_json(definition.cast("variant"))
    old = key % 10 == 7
    legacy = F.to_json(
        F.struct(
            F.lit("q1").alias("id"),
            F.concat(F.lit("Pick "), brand).alias("prompt"),
            _list(_option(kind, label=kind), _option(brand, label="B")).alias("options"),
        )
    )
    item = F.struct(
        F.concat(F.lit("survey_"), key.cast("string")).alias("id"),
        F.when(key % 10 == 5, twice)
        .when(key % 10 == 8, F.substring(definition, 1, 80))
        .when(~old, definition)
        .alias("definition"),
        F.when(old, legacy).alias("1"),
        F.when(old, F.lit('{"question_key":"q2","question":"none","options":[]}')).alias("2"),
        F.when(old & (key % 20 == 7), F.lit('{"id":"q3", oops')).alias("3"),
    )
    # once: else a condition on the definition builds it a second time, in the few tasks that read the file
    return survey.spread("part", "p_partkey").select(once(item))


def replies(survey: Survey) -> DataFrame:
    """One classifier reply per part: plain, fenced, or a message document; some cannot be read."""
    key = F.col("p_partkey")
    absent = F.lit(None).cast("string")

    def entry(bucket: str, path=absent, name=absent, value=absent, kind=absent) -> Column:
        return F.struct(
            F.lit(bucket).alias("bucket"),
            path.alias("taxonomy_path"),
            name.alias("demographic_key"),
            value.alias("demographic_value"),
            kind.alias("demographic_type"),
            F.lit(0.5).alias("confidence"),
        )

    preference = entry("preference", F.concat_ws("|", F.lit("Parts"), "p_brand", "p_type"))
    size = entry("demographic", absent, F.lit("size"), F.col("p_size").cast("string"), F.lit("NUMBER"))
    brand = entry("consumption", F.concat(F.lit("Brands|"), "p_brand"))
    empty = entry("demographic", F.lit("Lost|Path"))
    found = (
        F.when(key % 4 == 1, F.array(preference))
        .when(key % 4 == 2, F.array(size))
        .when(key % 4 == 3, F.array(brand, empty))
        .otherwise(F.slice(F.array(empty), 1, 0))
    )
    document = F.to_json(
        F.array(
            F.struct(
                F.concat(F.lit("poll_"), (key % 5 + 1).cast("string")).alias("poll_id"),
                F.lit("channel").alias("question_key"),
                F.element_at(F.array(*[F.lit(v) for v in CHANNELS]), (key % 3 + 1).cast("int")).alias("option_value"),
                found.alias("taxonomies"),
            )
        )
    )
    fenced = F.concat(F.lit("```json\n"), document, F.lit("\n```"))
    message = F.to_json(
        F.struct(
            F.array(
                F.struct(F.lit("tool").alias("type"), F.lit("ignored").alias("text")),
                F.struct(F.lit("text").alias("type"), fenced.alias("text")),
            ).alias("content")
        )
    )
    return survey.spread("part", "p_partkey").select(
        F.when(key % 10 == 9, F.concat(F.lit("Sorry: "), document))
        .when(key % 3 == 1, fenced)
        .when(key % 3 == 2, message)
        .otherwise(document)
        .alias("reply")
    )


def respondents(survey: Survey) -> DataFrame:
    key = F.col("c_custkey")
    return survey.table("customer").select(
        F.concat(F.lit("cust_"), key.cast("string")).alias("respondent_id"),
        F.when(key % 4 == 0, F.lit('["poll_1", "poll_2_segment-a"]'))
        .when(key % 4 == 1, F.lit(" poll_3, poll_1_segment-b ,,"))
        .when(key % 4 == 2, F.lit("[]"))
        .alias("completed"),
    )


def tokens(survey: Survey) -> DataFrame:
    key = F.col("c_custkey")
    values = ["on", "off", " Control ", "on-le", None, "", "No", "ON"]
    listed = F.array(*[F.lit(v) for v in values])
    entries = [
        F.struct(
            F.lit(f"flag_{i}").alias("flag"),
            F.element_at(listed, ((key + i) % len(values) + 1).cast("int")).alias("token"),
        )
        for i in range(1, 6)
    ]
    return survey.table("customer").select(
        F.concat(F.lit("cust_"), key.cast("string")).alias("respondent_id"), F.explode(F.array(*entries)).alias("t")
    ).select("respondent_id", "t.*")


def poll_flags(survey: Survey) -> DataFrame:
    """Polls on offer with their flag; poll 3 is offered as a variant."""
    number = F.substring("o_orderpriority", 1, 1)
    suffix = F.when(number == "3", "_segment-z").otherwise("")
    return survey.table("orders").select(number.alias("n"), suffix.alias("s")).distinct().select(
        F.concat(F.lit("poll_"), "n", "s").alias("poll_id"), F.concat(F.lit("flag_"), "n").alias("flag")
    )


def clicks(survey: Survey) -> DataFrame:
    kind = F.col("event_type")
    button = F.when(kind == "view", "Q1").when(kind == "click", "Q2").when(kind == "signup", "Q3")
    button = button.when(kind == "purchase", "Submit").otherwise("Close")
    return survey.table("events").select(
        F.concat(F.lit("poll_"), (F.col("user_id") % 5 + 1).cast("string")).alias("poll_id"),
        device(F.col("user_id")).alias("respondent_id"),
        button.alias("button"),
    )
