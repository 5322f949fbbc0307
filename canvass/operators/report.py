"""Reports per poll: a tally block above a grid with one row per submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.measures import cell, percent_text

# Report columns as (heading, export column), in report order.
META_COLUMNS = [("Response ID", "ingestion_id"), ("Submitted At", "submitted_at"), ("Market", "market_name")]
DEMOGRAPHIC_COLUMNS = [
    ("Age Band", "age_band"),
    ("Generation", "generation"),
    ("Household Income", "income_hh"),
    ("Net Worth", "net_worth_hh"),
    ("Education", "education"),
    ("Occupation", "occupation_category"),
    ("Marital Status", "marital_status"),
    ("Home Owner", "home_owner"),
    ("Ethnicity", "ethnic_group"),
    ("Has Children", "has_children_hh"),
    ("Gender", "gender"),
    ("State", "state"),
    ("DMA", "dma"),
    ("Affinity: Investor", "affinity_investor"),
    ("Affinity: Homeowner", "affinity_homeowner"),
]
DIVIDER = "RESPONSES + DEMOGRAPHICS"

# Order of the rows inside one poll's report.
POSITION = ["section", "question_no", "line", "rank", "row_key"]


def question_order(tally: DataFrame) -> DataFrame:
    """(poll, question text, sort key): smallest page position, then question key; unknown positions last."""
    place = F.struct(
        F.lit(0).alias("extra"),
        F.coalesce("question_order", F.lit(2**31 - 1)).cast("int").alias("pos"),
        F.col("question_key").alias("key"),
    )
    return tally.where(F.col("question").isNotNull()).groupBy("poll_id", "question").agg(F.min(place).alias("place"))


def question_lists(tally: DataFrame, export: DataFrame | None = None) -> DataFrame:
    """poll → its questions in survey order; questions only found in the export follow by name.

    Questions come from definitions, so a poll's list is short however many submissions it has.
    """
    places = question_order(tally)
    if export is not None:
        found = export.select("poll_id", F.explode(F.map_keys("answers")).alias("question")).distinct()
        last = F.struct(F.lit(1).alias("extra"), F.lit(0).alias("pos"), F.col("question").alias("key"))
        places = places.join(found, ["poll_id", "question"], "full").withColumn("place", F.coalesce("place", last))
    ordered = F.sort_array(F.collect_list(F.struct("place", "question"))).getField("question")
    return places.groupBy("poll_id").agg(ordered.alias("questions"))


def _cells(export: DataFrame, columns: list[tuple[str, str]]) -> list[Column]:
    types = dict(export.dtypes)
    return [cell(F.col(name), types[name]) for _, name in columns]


def ordered_questions(tally: DataFrame, export: DataFrame, poll_id: str) -> list[str]:
    """The question list of one poll, for a grid with real columns: one row, as long as the poll's definition."""
    row = question_lists(tally, export).where(F.col("poll_id") == poll_id).first()
    return row["questions"] if row else []


def response_grid(export: DataFrame, questions: list[str], poll_id: str | None = None) -> DataFrame:
    """Wide grid of one poll: ids, one column per question in the given order, then the demographics."""
    if poll_id is not None:
        export = export.where(F.col("poll_id") == poll_id)
    meta, demographic = _cells(export, META_COLUMNS), _cells(export, DEMOGRAPHIC_COLUMNS)
    return export.select(
        *[c.alias(name) for c, (name, _) in zip(meta, META_COLUMNS)],
        *[F.coalesce(F.col("answers")[q], F.lit("")).alias(q) for q in questions],
        *[c.alias(name) for c, (name, _) in zip(demographic, DEMOGRAPHIC_COLUMNS)],
    )


def _row(section: int, cells: Column, no=0, line=0, rank=0, key="") -> list[Column]:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return [
        F.col("poll_id"),
        F.lit(section).alias("section"),
        as_col(no).cast("int").alias("question_no"),
        as_col(line).cast("int").alias("line"),
        as_col(rank).cast("long").alias("rank"),
        as_col(key).cast("string").alias("row_key"),
        cells.cast("array<string>").alias("cells"),
    ]


def _text(*values) -> Column:
    return F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]).cast("array<string>")


def tally_block(tally: DataFrame, polls: DataFrame, now: str) -> DataFrame:
    """Heading, total, and per question its answers by descending count (equal counts by answer)."""
    totals = polls.join(tally.groupBy("poll_id").agg(F.max("total_responses").alias("total")), "poll_id", "left")
    count = F.coalesce("total", F.lit(0)).cast("string")
    top = F.array(
        F.struct(F.lit(0).alias("line"), _text(F.col("poll_id")).alias("cells")),
        F.struct(
            F.lit(1).alias("line"), _text("Total Responses:", count, f"Last Updated: {now} ET").alias("cells")
        ),
    )
    heading = totals.select("poll_id", F.explode(top).alias("t")).select(
        *_row(0, F.col("t.cells"), line=F.col("t.line"))
    )
    lists = question_lists(tally).select("poll_id", F.posexplode("questions").alias("no", "question"))
    titles = F.array(
        F.struct(F.lit(0).alias("line"), _text().alias("cells")),
        F.struct(F.lit(1).alias("line"), _text(F.concat(F.lit('Q: "'), "question", F.lit('"'))).alias("cells")),
        F.struct(F.lit(2).alias("line"), _text("Answer", "Count", "%").alias("cells")),
    )
    titled = lists.select("poll_id", "no", F.explode(titles).alias("t")).select(
        *_row(1, F.col("t.cells"), F.col("no"), F.col("t.line"))
    )
    shown = _text(
        F.coalesce("answer", F.lit("")),
        F.col("response_count").cast("string"),
        percent_text(F.col("response_count"), F.col("total_responses")),
    )
    counted = tally.join(lists, ["poll_id", "question"]).select(
        *_row(1, shown, F.col("no"), 3, -F.col("response_count"), F.coalesce("answer", F.lit("")))
    )
    return heading.unionByName(titled).unionByName(counted)


def survey_reports(tally: DataFrame, export: DataFrame, now: str, polls: DataFrame | None = None) -> DataFrame:
    """All reports at once: (poll_id, position columns, cells). Sorting by `POSITION` gives a poll's report.

    Rows carry sort keys instead of a row number, so no poll is numbered in one task; the writer sorts by range.
    `polls` limits the reports to a mapping and keeps polls without submissions.
    """
    if polls is None:
        polls = tally.select("poll_id").union(export.select("poll_id")).distinct()
    else:
        polls = polls.select("poll_id").distinct()
        tally = tally.join(polls, "poll_id", "left_semi")
        export = export.join(polls, "poll_id", "left_semi")
    lists = polls.join(question_lists(tally, export), "poll_id", "left").withColumn(
        "questions", F.coalesce("questions", F.array().cast("array<string>"))
    )
    headings = lambda columns: F.array(*[F.lit(h) for h, _ in columns])
    gap = F.array(
        *[
            F.struct(F.lit(i).alias("line"), c.alias("cells"))
            for i, c in enumerate([_text(), _text(), _text(DIVIDER), _text()])
        ]
    )
    divider = polls.select("poll_id", F.explode(gap).alias("t")).select(
        *_row(2, F.col("t.cells"), line=F.col("t.line"))
    )
    header = lists.select(
        *_row(3, F.concat(headings(META_COLUMNS), "questions", headings(DEMOGRAPHIC_COLUMNS)))
    )
    values = F.concat(
        F.array(*_cells(export, META_COLUMNS)),
        F.transform("questions", lambda q: F.coalesce(F.try_element_at("answers", q), F.lit(""))),
        F.array(*_cells(export, DEMOGRAPHIC_COLUMNS)),
    )
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("submitted_at"))
    rows = export.join(lists, "poll_id").select(
        *_row(
            4,
            values,
            rank=F.coalesce(since, F.lit(2**63 - 1)),
            key=F.lpad(F.col("ingestion_id").cast("string"), 20, "0"),
        )
    )
    return tally_block(tally, polls, now).unionByName(divider).unionByName(header).unionByName(rows)


def write_reports(reports: DataFrame, path: str) -> None:
    """Replace the reports of the polls in `reports`; other polls' folders stay.

    Range partitioning spreads a large poll over many tasks while file order follows report order.
    """
    order = ["poll_id", *POSITION]
    (
        reports.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("poll_id")
        .parquet(path)
    )
