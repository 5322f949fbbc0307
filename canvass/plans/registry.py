"""Every named query over the adapter's tables: name → function of a `Survey`."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions import hashes
from canvass.functions.text import path_depth, path_levels, require_poll_id
from canvass.operators import (
    catalog,
    checks,
    classify,
    export,
    identity,
    parity,
    profile,
    report,
    rules,
    tally,
    upsert,
)
from canvass.plans import jobs, streams
from canvass.session import measured, shared_dir, written
from canvass.sources import adapter_items as items
from canvass.sources import commits, definitions
from canvass.sources import responses as source
from canvass.sources.adapter import Survey
from canvass.sources.tables import append_rows

NOW = "03/06/2025, 08:00:00"
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _stamp():
    return F.lit("2024-06-01").cast("timestamp_ntz")


def _json(column: str):
    return F.to_json(F.col(column)).alias(column)


# Submissions ---------------------------------------------------------------------------------------------------


@query
def staged_responses(s: Survey) -> DataFrame:
    """Documents assembled, parsed and typed, without the written table the other queries share."""
    return source.stage(s.raw).select(
        "ingestion_id",
        "poll_id",
        "submitted_at",
        "device_id",
        "external_id",
        "market_name",
        F.size("answers").cast("long").alias("answers"),
    )


@query
def answer_rows(s: Survey) -> DataFrame:
    return source.answers(s.responses).drop("elements")


@query
def answer_elements(s: Survey) -> DataFrame:
    return source.elements(s.responses).select("ingestion_id", "poll_id", "question_key", "pos", "kind", "answer_value")


# Profile -------------------------------------------------------------------------------------------------------


def _answered(s: Survey) -> DataFrame:
    return profile.answer_options(s.responses, s.options)


@query
def answer_options(s: Survey) -> DataFrame:
    return _answered(s)


@query
def unconditional_taxonomy(s: Survey) -> DataFrame:
    return profile.unconditional_taxonomy(_answered(s), s.taxonomy, s.options)


@query
def conditional_taxonomy(s: Survey) -> DataFrame:
    return profile.conditional_taxonomy(_answered(s), s.taxonomy, s.options)


@query
def conditional_taxonomy_strict(s: Survey) -> DataFrame:
    return profile.conditional_taxonomy(_answered(s), s.taxonomy, s.options, strict_order=True)


@query
def profile_sync(s: Survey) -> DataFrame:
    return profile.profile_sync(s.responses, s.options, s.taxonomy)


@query
def profile_sync_approved(s: Survey) -> DataFrame:
    return profile.profile_sync(s.responses, s.options, profile.approved(s.taxonomy))


@query
def profile_summary(s: Survey) -> DataFrame:
    return profile.profile_summary(profile_sync(s))


@query
def device_attributes(s: Survey) -> DataFrame:
    return profile.device_attributes(s.responses, s.options, s.taxonomy)


# Tally and patterns --------------------------------------------------------------------------------------------


@query
def response_tally(s: Survey) -> DataFrame:
    return tally.response_tally(s.responses, s.questions, s.options)


@query
def tally_documents(s: Survey) -> DataFrame:
    return tally.tally_documents(response_tally(s), size=10)


@query
def report_tally(s: Survey) -> DataFrame:
    return tally.report_tally(s.responses, s.questions, s.options)


@query
def answer_patterns(s: Survey) -> DataFrame:
    return tally.answer_patterns(s.responses, s.options, top=50)


# Catalog, taxonomy and classification --------------------------------------------------------------------------


@query
def survey_catalog(s: Survey) -> DataFrame:
    return catalog.survey_catalog(s.questions, s.options)


@query
def catalog_documents(s: Survey) -> DataFrame:
    return catalog.catalog_documents(survey_catalog(s))


@query
def taxonomy_rows(s: Survey) -> DataFrame:
    return catalog.taxonomy_rows(s.taxonomy, s.options).withColumn("taxonomy_levels", _json("taxonomy_levels"))


@query
def taxonomy_filtered(s: Survey) -> DataFrame:
    return catalog.taxonomy_rows(
        s.taxonomy, s.options, bucket="Consumption", min_confidence=0.8, option_source="catalog", first_level="Returns"
    ).select("poll_id", "option_value", "taxonomy_path", "confidence")


@query
def taxonomy_counts(s: Survey) -> DataFrame:
    return catalog.taxonomy_counts(s.taxonomy)


@query
def answer_pairs(s: Survey) -> DataFrame:
    return tally.answer_patterns(s.responses, s.options)


@query
def text_answers(s: Survey) -> DataFrame:
    return catalog.text_answers(s.options, s.questions, s.taxonomy)


@query
def unclassified_text(s: Survey) -> DataFrame:
    return classify.unclassified_text(s.options, s.questions, s.taxonomy)


@query
def text_option_candidates(s: Survey) -> DataFrame:
    return classify.text_option_candidates(s.responses, s.questions)


@query
def catalog_view(s: Survey) -> DataFrame:
    return catalog.catalog_view(s.questions, s.options)


@query
def flat_catalog_rows(s: Survey) -> DataFrame:
    """The retired catalog, exported as JSON arrays of rows with upper-case keys (one file a poll), and read back."""
    rows = catalog.catalog_view(s.questions, s.options)
    names = ["poll_id", "question_key", "question_text", "option_value", "option_label"]
    entry = F.struct(*[F.col(n).alias(n.upper()) for n in names])
    path = f"{shared_dir(s.spark, 'flat-catalog')}/export"
    exported = rows.groupBy("poll_id").agg(F.to_json(F.collect_list(entry)).alias("value"))
    exported.write.partitionBy("poll_id").text(path)
    return definitions.read_flat_catalog(s.spark, f"{path}/*/*.txt")


@query
def seeded_questions(s: Survey) -> DataFrame:
    return catalog.seed_dimensions(catalog.catalog_view(s.questions, s.options))[0]


@query
def seeded_options(s: Survey) -> DataFrame:
    return catalog.seed_dimensions(catalog.catalog_view(s.questions, s.options))[1]


@query
def rekeyed_taxonomy(s: Survey) -> DataFrame:
    by_value = classify.classification_rows(_replies(s))
    return catalog.rekey_taxonomy(by_value, s.options).select(
        "option_id", "bucket", "taxonomy_path", "demographic_key", "demographic_value", "confidence"
    )


@query
def unclassified_polls(s: Survey) -> DataFrame:
    return classify.unclassified_polls(s.questions, s.options, s.taxonomy)


@query
def unclassified_options(s: Survey) -> DataFrame:
    return classify.unclassified_options(s.options, s.taxonomy)


@query
def classification_status(s: Survey) -> DataFrame:
    return classify.classification_status(s.questions, s.options, s.taxonomy)


@query
def options_to_classify(s: Survey) -> DataFrame:
    return classify.options_to_classify(s.questions, s.options)


@query
def existing_taxonomies(s: Survey) -> DataFrame:
    return classify.existing_taxonomies(s.taxonomy)


@query
def option_prompts(s: Survey) -> DataFrame:
    return classify.option_prompts(s.questions, s.options).select("poll_id", "user_message")


@query
def text_prompts(s: Survey) -> DataFrame:
    prompts = classify.text_prompts(s.options, s.questions, s.taxonomy, lines=20)
    return prompts.select("poll_id", "batch", "user_message")


@query
def taxonomy_reference(s: Survey) -> DataFrame:
    return classify.taxonomy_reference(s.taxonomy)


def _replies(s: Survey) -> DataFrame:
    return classify.parsed_replies(items.replies(s))


@query
def classification_rows(s: Survey) -> DataFrame:
    return classify.classification_rows(_replies(s)).withColumn("taxonomy_levels", _json("taxonomy_levels"))


@query
def classification_summary(s: Survey) -> DataFrame:
    return classify.classification_summary(_replies(s))


@query
def rejected_replies(s: Survey) -> DataFrame:
    return classify.rejected_replies(_replies(s))


@query
def taxonomy_rule(s: Survey) -> DataFrame:
    rule = upsert.taxonomy_rule(
        s.options,
        require_poll_id("poll_4"),
        "flags",
        "A",
        "preference",
        0.8,
        taxonomy_path="Orders|Returned",
        condition_option_ids=[410001],
    )
    return rule.select(
        "option_id",
        "bucket",
        "taxonomy_path",
        "taxonomy_depth",
        _json("taxonomy_levels"),
        "confidence",
        _json("condition_sequence"),
    )


# Definitions and upserts ---------------------------------------------------------------------------------------


@query
def catalog_questions(s: Survey) -> DataFrame:
    return definitions.questions(items.catalog_items(s))


@query
def catalog_options(s: Survey) -> DataFrame:
    return definitions.options(items.catalog_items(s))


@query
def catalog_rejects(s: Survey) -> DataFrame:
    return definitions.rejects(items.catalog_items(s))


@query
def catalog_pages(s: Survey) -> DataFrame:
    return definitions.page_questions(items.catalog_items(s)).drop("page_show_if", "group_no")


@query
def upserted_questions(s: Survey) -> DataFrame:
    """The survey's questions after loading its own definitions: texts and flags change, nothing is added twice."""
    target = s.questions.select(
        "poll_id",
        "question_key",
        "question_type",
        "question_text",
        "is_required",
        "min_select",
        F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"),
    )
    rows = definitions.questions(items.poll_items(s)).select(
        "poll_id", "question_key", "question_type", "question_text", "is_required", "min_select"
    )
    return upsert.upsert_questions(target, rows, _stamp())


@query
def upserted_options(s: Survey) -> DataFrame:
    rows = definitions.options(items.poll_items(s))
    merged = upsert.upsert_options(s.options, rows, _stamp())
    new = F.col("option_id") >= upsert.NEW_IDS_FROM
    return merged.select(
        F.when(new, F.lit(-1).cast("long")).otherwise(F.col("option_id")).alias("option_id"),
        *[c for c in merged.columns if c != "option_id"],
    )


@query
def added_text_options(s: Survey) -> DataFrame:
    """Typed answers added to a catalog without any."""
    target = s.options.where("option_source = 'catalog'")
    merged = upsert.add_text_options(target, classify.text_option_candidates(s.responses, s.questions), _stamp())
    return merged.select("poll_id", "question_key", "option_value", "option_source", "is_catch_all", "updated_at")


@query
def new_option_ids(s: Survey) -> DataFrame:
    """Ids given to new options: as many as rows, from the start of the new range without a gap."""
    target = s.options.where("option_source = 'catalog'")
    merged = upsert.add_text_options(target, classify.text_option_candidates(s.responses, s.questions), _stamp())
    return merged.where(F.col("option_id") >= upsert.NEW_IDS_FROM).agg(
        F.count("*").alias("added"),
        F.countDistinct("option_id").alias("ids"),
        F.min("option_id").alias("first_id"),
        (F.max("option_id") - F.min("option_id") + 1).alias("span"),
    )


@query
def upserted_taxonomy(s: Survey) -> DataFrame:
    rows = classify.classification_rows(_replies(s))
    target = s.taxonomy.withColumn("classified_by", F.lit("person"))
    merged = upsert.upsert_taxonomy(target, rows, s.options, "catalog", _stamp())
    return merged.select(
        "option_id",
        "bucket",
        "taxonomy_path",
        "taxonomy_depth",
        "demographic_key",
        "demographic_value",
        "confidence",
        _json("condition_sequence"),
        "classified_by",
        "is_approved",
        "updated_at",
    )


def _typed_rows(s: Survey) -> DataFrame:
    """Classified typed answers, in capitals as a model may return them."""
    typed = s.options.where("option_source = 'response'")
    path, none = F.concat(F.lit("Brands|"), F.col("option_value")), F.lit(None).cast("string")
    return typed.select(
        "poll_id",
        "question_key",
        F.upper("option_value").alias("option_value"),
        F.lit("preference").alias("bucket"),
        path.alias("taxonomy_path"),
        path_depth(path).alias("taxonomy_depth"),
        path_levels(path).alias("taxonomy_levels"),
        *[none.alias(f"demographic_{x}") for x in ("key", "value", "type")],
        F.lit(0.5).alias("confidence"),
    )


@query
def upserted_text_taxonomy(s: Survey) -> DataFrame:
    """Rows of typed answers merged twice: the second time changes nothing."""
    merged = s.taxonomy.withColumn("classified_by", F.lit("person"))
    for _ in range(2):
        merged = upsert.upsert_taxonomy(merged, _typed_rows(s), s.options, "response", _stamp())
    return merged.select("option_id", "bucket", "taxonomy_path", "demographic_key", "confidence", "classified_by", "updated_at")


@query
def upserted_flat_taxonomy(s: Survey) -> DataFrame:
    """The retired form: the rows of one poll are there, with less confidence."""
    rows = _typed_rows(s).drop("demographic_key", "demographic_value", "demographic_type")
    stored = rows.where("poll_id = 'poll_1'").withColumn("confidence", F.lit(0.1))
    stored = stored.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    merged = upsert.upsert_flat_taxonomy(stored, rows, _stamp())
    return merged.select("poll_id", "question_key", "option_value", "bucket", "taxonomy_path", "taxonomy_depth", "confidence", "updated_at")


# Identity, demographics, export --------------------------------------------------------------------------------


@query
def event_window(s: Survey) -> DataFrame:
    return identity.event_window(s.responses)


@query
def device_user(s: Survey) -> DataFrame:
    return identity.device_user(s.responses, s.events)


@query
def device_publication(s: Survey) -> DataFrame:
    return identity.device_publication(s.responses, s.events)


@query
def identity_candidates(s: Survey) -> DataFrame:
    return identity.identity_candidates(s.responses, s.events)


@query
def respondent_identity(s: Survey) -> DataFrame:
    return identity.respondent_identity(s.responses, s.events)


@query
def identity_summary(s: Survey) -> DataFrame:
    return identity.identity_summary(respondent_identity(s))


def _demographics(s: Survey, who: DataFrame) -> DataFrame:
    return identity.respondent_demographics(who, s.email, s.person, s.place)


@query
def respondent_demographics(s: Survey) -> DataFrame:
    return _demographics(s, respondent_identity(s))


@query
def clustered_demographics(s: Survey) -> DataFrame:
    """Demographics from person tables that are bucketed by the keys of the joins."""
    store, prefix = jobs.Store(s.spark, shared_dir(s.spark, "store")), f"persons_{uuid.uuid4().hex}"
    jobs.cluster_persons(store, {"email": s.email, "person": s.person, "place": s.place}, prefix, buckets=8)
    return identity.respondent_demographics(respondent_identity(s), **jobs.clustered_persons(store, prefix))


@query
def demographics_coverage(s: Survey) -> DataFrame:
    return identity.demographics_coverage(respondent_demographics(s))


@query
def audience_profile(s: Survey) -> DataFrame:
    return identity.audience_profile(s.responses, s.events, s.email, s.person)


@query
def pending_responses(s: Survey) -> DataFrame:
    """Submissions whose device no event has resolved, in recently active polls."""
    resolved = respondent_identity(s).where("hem IS NOT NULL")
    return identity.pending_responses(s.responses, resolved).select("ingestion_id", "poll_id", "submitted_at")


@query
def unseen_respondents(s: Survey) -> DataFrame:
    """Respondents missing from a table that holds only one gender so far."""
    who = written(respondent_identity(s), "identity")
    stored = _demographics(s, who).where("gender = 'F'")
    return identity.unseen_respondents(who, stored).select("hem").distinct()


def _export(s: Survey) -> DataFrame:
    who = written(respondent_identity(s), "identity")
    return export.response_demographics(s.responses, s.questions, s.options, who, _demographics(s, who))


@query
def response_demographics(s: Survey) -> DataFrame:
    return _export(s).withColumn("answers", _json("answers"))


@query
def response_grid(s: Survey) -> DataFrame:
    """The wide grid with the questions of all polls, as found in the tally and the export."""
    rows = written(_export(s), "export")
    lists = report.question_lists(report_tally(s), rows).orderBy("poll_id").collect()
    names = dict.fromkeys(name for poll in lists for name in poll["questions"])
    return report.response_grid(rows, list(names))


@query
def question_lists(s: Survey) -> DataFrame:
    return report.question_lists(report_tally(s), _export(s)).withColumn("questions", _json("questions"))


@query
def survey_reports(s: Survey) -> DataFrame:
    counted, rows = written(report_tally(s), "tally"), written(_export(s), "export")
    rows = report.survey_reports(counted, rows, NOW)
    return rows.withColumn("cells", _json("cells"))


@query
def stored_reports(s: Survey) -> DataFrame:
    """The report files of all mapped polls, written twice: the second report replaces the first one whole."""
    counted, rows = written(report_tally(s), "tally"), written(_export(s), "export")
    path, mapping = shared_dir(s.spark, "reports"), s.responses.select("poll_id").distinct()
    for now in ("earlier", NOW):
        report.write_reports(report.survey_reports(counted, rows, now, mapping), path)
    return s.spark.read.parquet(path).select("poll_id", *report.POSITION, _json("cells"))


@query
def email_hashes(s: Survey) -> DataFrame:
    """Hashes of the customers' e-mail addresses, whatever their case and the blanks around them."""
    address = F.concat(F.lit(" "), "c_name", F.lit("@Mail.Example "))
    return s.table("customer").select(F.col("c_custkey").alias("id"), hashes.email_hash(address).alias("hem"))


# Streaming -----------------------------------------------------------------------------------------------------


@query
def live_option_counts(s: Survey) -> DataFrame:
    return streams.live_option_counts(s)


@query
def live_option_stats(s: Survey) -> DataFrame:
    return streams.live_option_stats(s)


@query
def delivered_once(s: Survey) -> DataFrame:
    return streams.delivered_once(s)


# Copies and checks ---------------------------------------------------------------------------------------------


def _copy(s: Survey) -> DataFrame:
    """A copy made before the last submissions, with a changed document now and then."""
    key = F.col("ingestion_id")
    changed = F.when(key % 1000 == 7, F.concat("raw", F.lit(" "))).otherwise(F.col("raw"))
    return s.landed.where(key % 100 != 99).withColumn("raw", changed)


@query
def copy_parity(s: Survey) -> DataFrame:
    return parity.copy_parity("submissions", s.landed, _copy(s), "ingestion_id").unionByName(
        parity.copy_parity("options", s.options, s.options, "option_id")
    )


@query
def catch_up(s: Survey) -> DataFrame:
    return parity.catch_up(s.landed, _copy(s), "ingestion_id").select("ingestion_id")


@query
def copy_differences(s: Survey) -> DataFrame:
    return parity.copy_differences(s.landed, _copy(s), "ingestion_id")


@query
def differing_ranges(s: Survey) -> DataFrame:
    return parity.differing_ranges(s.landed, _copy(s), "ingestion_id", leaf=6, step=4)


@query
def id_conflicts(s: Survey) -> DataFrame:
    return parity.conflicts(s.landed, _copy(s), "ingestion_id")


@query
def id_faults(s: Survey) -> DataFrame:
    """Order lines under a key that is not unique."""
    lines = s.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"))
    return parity.id_faults(lines, "line_id")


@query
def rolled_back(s: Survey) -> DataFrame:
    rows = parity.rollback_rows(s.landed, _copy(s), "ingestion_id")
    return rows.select("ingestion_id", F.col("raw").endswith(" ").alias("changed"))


def _committed(s: Survey):
    """Questions and options committed together, then changed together: no typed answers, and another wording."""
    tables = commits.Tables(s.spark, shared_dir(s.spark, "commits"))
    at = [datetime(2024, m, 1) for m in (1, 2)]
    tables.commit({"options": s.options, "questions": s.questions}, at=at[0])
    changed = s.questions.withColumn("question_text", F.concat("question_text", F.lit(" (new)")))
    tables.commit({"options": s.options.where("option_source = 'catalog'"), "questions": changed}, at=at[1])
    return tables, at


@query
def options_as_of(s: Survey) -> DataFrame:
    """Options of the questions as they stood in January and in February."""
    tables, at = _committed(s)
    found = []
    for when in at:
        state = tables.as_of(when + timedelta(days=10))
        rows = tables.read("options", state).join(tables.read("questions", state), ["poll_id", "question_key"])
        found.append(rows.select(F.lit(str(when.date())).alias("as_of"), "option_id", "question_text"))
    return found[0].union(found[1])


@query
def rolled_back_tables(s: Survey) -> DataFrame:
    """Both tables after a rollback to January, with an option that was added meanwhile to neither."""
    tables, at = _committed(s)
    tables.rollback(tables.as_of(at[0]))
    options, questions = tables.read("options"), tables.read("questions")
    rows = options.select(F.lit("options").alias("name"), "poll_id", "question_key", F.col("option_value").alias("value"))
    return rows.union(questions.select(F.lit("questions"), "poll_id", "question_key", "question_text"))


@query
def refreshed_identity(s: Survey) -> DataFrame:
    """Stored identity rows after two polls were refreshed: one with its submissions, one whose submissions are gone."""
    store = jobs.Store(s.spark, shared_dir(s.spark, "store"))
    append_rows(s.responses, store.path("responses"))
    jobs.refresh_identity(store, s.events)
    left = jobs.Store(s.spark, store.root)
    left.responses = lambda: s.responses.where("poll_id <> 'poll_3'")
    for poll in ("poll_2", "poll_3"):
        jobs.refresh_identity(left, s.events, poll)
    return store.partitioned("identity").select("ingestion_id", "poll_id", "device_id", "hem", "hem_source", "publication_name")


@query
def synced_catalog(s: Survey) -> DataFrame:
    """Options after the catalog was synced twice, from all definitions: ids of the new range, none of them twice."""
    store = jobs.Store(s.spark, shared_dir(s.spark, "store"))
    for _ in range(2):
        jobs.sync_catalog(store, items.catalog_items(s))
    types = measured(store.read("questions").select("poll_id", "question_key", "question_type"))
    options = store.read("options").join(types, ["poll_id", "question_key"])
    low = options.agg(F.min("option_id")).scalar()
    return options.select("poll_id", "question_key", "question_type", "option_value", "sort_order", (F.col("option_id") - low < options.agg(F.count("*")).scalar()).alias("dense"))


@query
def caught_up(s: Survey) -> DataFrame:
    """Documents of a copy that was caught up until none was missing; conflicting ones stay as they were copied."""
    store = jobs.Store(s.spark, shared_dir(s.spark, "store"))
    append_rows(_copy(s), store.path("copied"))
    jobs.catch_up_until_equal(lambda: s.landed, store, "copied", "ingestion_id", rounds=3)
    return store.partitioned("copied").select("ingestion_id", F.col("raw").endswith(" ").alias("changed"))


@query
def demographics_checks(s: Survey) -> DataFrame:
    who = written(respondent_identity(s), "identity")
    return checks.demographics_checks(s.spark, who, written(_demographics(s, who), "demographics"))


@query
def export_checks(s: Survey) -> DataFrame:
    return checks.export_checks(s.spark, written(_export(s), "export"), s.responses)


@query
def table_checks(s: Survey) -> DataFrame:
    lines = s.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"))
    return checks.union(
        checks.ids_valid("submissions", s.landed, "ingestion_id"),
        checks.ids_valid("options", s.options, "option_id"),
        checks.ids_valid("lines", lines, "line_id"),
        checks.no_conflicts("submissions", s.landed, _copy(s), "ingestion_id"),
        checks.copies_equal("submissions", s.landed, _copy(s), "ingestion_id"),
        checks.copies_equal("options", s.options, s.options, "option_id"),
    )


# Audits of survey rules ----------------------------------------------------------------------------------------


def _logic(s: Survey) -> DataFrame:
    return written(definitions.survey_logic(items.poll_items(s)), "logic")


@query
def hidden_answers(s: Survey) -> DataFrame:
    return rules.hidden_answers(s.responses, _logic(s))


@query
def incomplete_required(s: Survey) -> DataFrame:
    return rules.incomplete_required(s.responses, _logic(s))


@query
def not_offered_options(s: Survey) -> DataFrame:
    return rules.not_offered_options(s.responses, _logic(s))


@query
def exclusive_conflicts(s: Survey) -> DataFrame:
    return rules.exclusive_conflicts(s.responses, _logic(s))


@query
def write_ins(s: Survey) -> DataFrame:
    return rules.write_ins(s.responses, s.options)


@query
def open_polls(s: Survey) -> DataFrame:
    return rules.open_polls(items.respondents(s), items.tokens(s), items.poll_flags(s))


@query
def page_funnel(s: Survey) -> DataFrame:
    return rules.page_funnel(items.clicks(s)).select("poll_id", "button", "respondents")


# One poll ------------------------------------------------------------------------------------------------------

POLL = require_poll_id("poll_2")
OF_POLL = {
    "survey_catalog": lambda s: catalog.survey_catalog(s.questions, s.options, POLL),
    "response_tally": lambda s: tally.response_tally(s.responses, s.questions, s.options, POLL),
    "report_tally": lambda s: tally.report_tally(s.responses, s.questions, s.options, POLL),
    "answer_patterns": lambda s: tally.answer_patterns(s.responses, s.options, POLL, top=50),
    "text_answers": lambda s: catalog.text_answers(s.options, s.questions, s.taxonomy, POLL),
    "options_to_classify": lambda s: classify.options_to_classify(s.questions, s.options, POLL),
    "classification_status": lambda s: classify.classification_status(s.questions, s.options, s.taxonomy, POLL),
    "event_window": lambda s: identity.event_window(s.responses, POLL),
    "device_user": lambda s: identity.device_user(s.responses, s.events, POLL),
    "device_publication": lambda s: identity.device_publication(s.responses, s.events, POLL),
    "identity_candidates": lambda s: identity.identity_candidates(s.responses, s.events, POLL),
    "respondent_identity": lambda s: identity.respondent_identity(s.responses, s.events, POLL),
}
QUERIES |= {f"{name}_of_poll": fn for name, fn in OF_POLL.items()}
