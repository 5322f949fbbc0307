"""Batch jobs over stored tables. Each reads complete snapshots and writes the next one, so it can be run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.text import require_poll_id
from canvass.operators import classify, export, identity, parity, report, tally, upsert
from canvass.session import adaptive, written
from canvass.sources import definitions, schemas
from canvass.sources.responses import stage
from canvass.sources.tables import (
    append_rows,
    bucketed,
    path_exists,
    read_table,
    replace_keys,
    replace_partitions,
    table_exists,
    write_loads,
    write_table,
)


def _now() -> Column:
    return F.localtimestamp()


class Store:
    """Tables below one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = adaptive(spark), root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        if schema is not None and not table_exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], schema)
        return read_table(self.spark, self.path(name))

    def write(self, name: str, df: DataFrame) -> None:
        write_table(df, self.path(name))

    def partitioned(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def demographics(self) -> DataFrame:
        return self.partitioned("demographics").drop("load")

    def responses(self) -> DataFrame | None:
        return self.partitioned("responses").drop("load") if path_exists(self.spark, self.path("responses")) else None


QUESTION_TABLE = f"{schemas.QUESTIONS}, updated_at timestamp_ntz"


def load_responses(store: Store, raw: DataFrame) -> None:
    """Stage (ingestion_id, raw) documents; of those that share an id one is kept, and only ids not there yet are added."""
    staged = stage(raw.groupBy("ingestion_id").agg(F.min("raw").alias("raw")))
    stored = store.responses()
    append_rows(staged if stored is None else parity.catch_up(staged, stored, "ingestion_id"), store.path("responses"))


def sync_catalog(store: Store, items: DataFrame) -> DataFrame:
    """Definitions → questions and options; returns the polls to classify next."""
    questions = store.read("questions", QUESTION_TABLE)
    options = store.read("options", schemas.OPTION_TABLE)
    # each definition is read once, however often the plans below name its rows
    rows = written(definitions.expanded(items), "definitions")
    store.write("questions", upsert.upsert_questions(questions, definitions.expanded_questions(rows), _now()))
    store.write("options", upsert.upsert_options(options, definitions.expanded_options(rows), _now()))
    return classify.unclassified_polls(
        store.read("questions"), store.read("options"), store.read("taxonomy", schemas.TAXONOMY_TABLE)
    )


def prepare_text(store: Store, lines: int) -> DataFrame:
    """Add the typed answers as options; returns the classifier's inputs of about `lines` answers each, if any.

    The classifications in use are stored once, beside them.
    """
    questions, options = store.read("questions"), store.read("options")
    candidates = classify.text_option_candidates(store.responses(), questions)
    store.write("options", upsert.add_text_options(options, candidates, _now()))
    taxonomy = store.read("taxonomy", schemas.TAXONOMY_TABLE)
    store.write("taxonomy_reference", classify.taxonomy_reference(taxonomy))
    return classify.text_prompts(store.read("options"), questions, taxonomy, lines)


def store_replies(store: Store, replies: DataFrame, source: str) -> DataFrame:
    """Classifier replies → taxonomy; returns the replies that could not be read."""
    parsed = classify.parsed_replies(replies)
    taxonomy = store.read("taxonomy", schemas.TAXONOMY_TABLE)
    rows = classify.classification_rows(parsed)
    store.write("taxonomy", upsert.upsert_taxonomy(taxonomy, rows, store.read("options"), source, _now()))
    return classify.rejected_replies(parsed)


def refresh_identity(store: Store, events: DataFrame, poll_id: str | None = None, pad_days: int = 1) -> None:
    """Replace the identity rows of one poll, which has none any more if its submissions are gone, or of every poll with
    submissions."""
    if poll_id is not None:
        require_poll_id(poll_id)
    rows = identity.respondent_identity(store.responses(), events, poll_id, pad_days).withColumn("resolved_at", _now())
    if poll_id is None:
        replace_partitions(rows, store.path("identity"), "poll_id")
    else:
        replace_keys(rows, store.path("identity"), "poll_id", [poll_id])


def catch_up_until_equal(source: Callable[[], DataFrame], store: Store, name: str, key: str, rounds: int) -> int:
    """Copy rows that the source has and the stored copy lacks, again until none are missing; the source may grow
    meanwhile. Returns the rounds that copied rows. More than `rounds` of them is an error: the copy doesn't come closer."""
    for n in range(rounds + 1):
        rows = source()
        if path_exists(store.spark, store.path(name)):
            rows = parity.catch_up(rows, store.partitioned(name).drop("load"), key)
        missing = written(rows, "missing")
        if missing.isEmpty():
            return n
        append_rows(missing, store.path(name))
    raise RuntimeError(f"{name}: rows still missing after {rounds} rounds")


#: Key that each person table is bucketed by.
PERSON_KEYS = {"email": "sha256", "person": "id", "place": "id"}


def cluster_persons(store: Store, tables: dict[str, DataFrame], prefix: str, buckets: int) -> None:
    """Store the person tables bucketed by the key they are joined on: e-mail by hash, the others by person. Done once a
    load; every rebuild after that shuffles the respondents, never these tables."""
    for name, key in PERSON_KEYS.items():
        bucketed(tables[name], f"{prefix}_{name}", key, buckets, store.path(f"{prefix}/{name}"))


def clustered_persons(store: Store, prefix: str) -> dict[str, DataFrame]:
    return {name: store.spark.table(f"{prefix}_{name}") for name in PERSON_KEYS}


def rebuild_demographics(store: Store, email: DataFrame, person: DataFrame, place: DataFrame) -> None:
    write_loads(
        identity.respondent_demographics(store.partitioned("identity"), email, person, place), store.path("demographics")
    )


def extend_demographics(store: Store, email: DataFrame, person: DataFrame, place: DataFrame) -> bool:
    """Append respondents that are not stored yet. Without any, the person tables are not scanned; returns if they were."""
    unseen = written(identity.unseen_respondents(store.partitioned("identity"), store.demographics()), "unseen")
    if unseen.isEmpty():
        return False
    append_rows(identity.respondent_demographics(unseen, email, person, place), store.path("demographics"))
    return True


def write_reports(store: Store, now: str, mapping: DataFrame | None = None) -> None:
    """Reports of all polls, or of the mapped ones, one folder per poll."""
    responses, questions, options = store.responses(), store.read("questions"), store.read("options")
    store.write(
        "export",
        export.response_demographics(
            responses, questions, options, store.partitioned("identity"), store.demographics()
        ),
    )
    store.write("tally", tally.report_tally(responses, questions, options))
    polls = None if mapping is None else mapping.select("poll_id")
    rows = report.survey_reports(store.read("tally"), store.read("export"), now, polls)
    report.write_reports(rows, store.path("reports"))
