"""Who answered: submissions → devices → events inside each poll's window → one hashed e-mail per submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions.hashes import is_hash, resolved_hash
from canvass.functions.measures import age_band
from canvass.functions.text import blank_to_null
from canvass.session import written

# Fixed value: prefix of the events fired by a survey widget.
GUIDE_EVENTS = "[Guides-Surveys]%"
# Fixed value: days without activity after which a poll is no longer picked up.
RECENT_DAYS = 14
#: Ranges of days that the event scan is given at most.
RANGES = 64


def _one_poll(responses: DataFrame, poll_id: str | None) -> DataFrame:
    return responses if poll_id is None else responses.where(F.col("poll_id") == poll_id)


def event_window(responses: DataFrame, poll_id: str | None = None, pad_days: int = 1) -> DataFrame:
    """Submission range per poll and the padded dates that bound its events; NULL dates without submission times."""
    return (
        _one_poll(responses, poll_id)
        .groupBy("poll_id")
        .agg(
            F.min("submitted_at").alias("first_submitted"),
            F.max("submitted_at").alias("last_submitted"),
            F.count("*").alias("responses"),
        )
        .select(
            "poll_id",
            "first_submitted",
            "last_submitted",
            "responses",
            F.date_sub(F.to_date("first_submitted"), pad_days).alias("win_start"),
            F.date_add(F.to_date("last_submitted"), pad_days).alias("win_end"),
        )
    )


def _respondents(responses: DataFrame, pad_days: int) -> DataFrame:
    """Distinct (poll, device) with the poll's window.

    Written, because several steps read it and because a table has a known size: Spark broadcasts it to the event
    scan if it is small, and otherwise shuffles both sides.
    """
    windows = event_window(responses, pad_days=pad_days).where("win_start IS NOT NULL")
    devices = responses.where(F.col("device_id") != "").select("poll_id", "device_id").distinct()
    rows = devices.join(windows.select("poll_id", "win_start", "win_end"), "poll_id")
    return written(rows, "respondents")


def publication(properties: Column) -> Column:
    return blank_to_null(F.from_json(properties, "publication_name string")["publication_name"])


def covered_days(windows: DataFrame, most: int = RANGES) -> DataFrame:
    """At most `most` ranges of days (first, end; the end is not in it) that cover all windows: the widest gaps between
    them stay out, narrower ones are taken in. One row a window is all that is sorted, never one a day, so a submission
    with an absurd date only widens a range."""
    early = Window.orderBy("win_start", "win_end").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.greatest(F.datediff("win_start", F.max("win_end").over(early)) - 1, F.lit(0))
    rows = windows.distinct().withColumn("gap", F.coalesce(gap, F.lit(0)))
    widest = F.row_number().over(Window.orderBy(F.desc("gap"), "win_start", "win_end"))
    cut = ((F.col("nth") < most) & (F.col("gap") > 0)).cast("int")
    upto = Window.orderBy("win_start", "win_end").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("nth", widest).withColumn("island", F.sum(cut).over(upto))
    return rows.groupBy("island").agg(F.min("win_start").alias("first"), F.date_add(F.max("win_end"), 1).alias("end"))


def _within(events: DataFrame, respondents: DataFrame) -> DataFrame:
    """Events on the days of any window, as constant ranges that the scan can skip files and partitions by. The exact
    window is tested where a device's days meet its polls."""
    inside = F.lit(False)
    days = covered_days(respondents.select("win_start", "win_end"))
    # RANGES rows at most; as text, because Python has no year 0
    for r in days.select(*[F.col(c).cast("string") for c in ("first", "end")]).collect():
        start, end = (F.lit(d).cast("timestamp_ntz") for d in (r["first"], r["end"]))
        inside = inside | ((F.col("event_time") >= start) & (F.col("event_time") < end))
    return events.where(inside)


def _daily(events: DataFrame, respondents: DataFrame, *values: Column) -> DataFrame:
    """Counts per (device, kind, value, day) for the respondents' devices, from one scan of the events.

    The windows have day bounds, the last one reaching to the midnight that ends it, so a day and a midnight flag are
    all a window test needs. Counting before the join on the device turns the rows of a busy device into a few
    per-day rows, whatever its share of the events.
    """
    facts = F.filter(F.array(*values), lambda v: v["value"].isNotNull())
    devices = respondents.select("device_id").distinct()
    day = F.to_date("event_time")
    return (
        events.join(devices, "device_id", "left_semi")
        .select("device_id", "event_time", F.explode(facts).alias("f"))
        .select(
            "device_id",
            "f.kind",
            "f.value",
            day.alias("day"),
            (F.col("event_time") == day.cast("timestamp_ntz")).alias("midnight"),
            "event_time",
        )
        .groupBy("device_id", "kind", "value", "day", "midnight")
        .agg(F.count("*").alias("n"), F.max("event_time").alias("last"))
    )


def _in_window() -> Column:
    day = F.col("day")
    return (day >= F.col("win_start")) & (
        (day < F.col("win_end")) | ((day == F.col("win_end")) & F.col("midnight"))
    )


def _value(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"))


def _user() -> Column:
    return _value("user", F.col("user_id"))


def _publication() -> Column:
    guide = F.col("event_type").like(GUIDE_EVENTS)
    return _value("publication", F.when(guide, publication(F.col("event_properties"))))


def _collapsed(events: DataFrame, responses: DataFrame, pad_days: int, *values: Column) -> DataFrame:
    """Per (poll, device, kind) the most frequent, then most recent, then greatest value inside the poll's window."""
    respondents = _respondents(responses, pad_days)
    daily = _daily(_within(events, respondents), respondents, *values)
    per_value = (
        daily.join(respondents, "device_id")
        .where(_in_window())
        .groupBy("poll_id", "device_id", "kind", "value")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    )
    best = F.max(F.struct("n", "last", "value"))
    return per_value.groupBy("poll_id", "device_id", "kind").agg(best.alias("best"))


def device_user(
    responses: DataFrame, events: DataFrame, poll_id: str | None = None, pad_days: int = 1
) -> DataFrame:
    rows = _collapsed(events, _one_poll(responses, poll_id), pad_days, _user())
    return rows.select("poll_id", "device_id", F.col("best.value").alias("user_id"))


def device_publication(
    responses: DataFrame, events: DataFrame, poll_id: str | None = None, pad_days: int = 1
) -> DataFrame:
    rows = _collapsed(events, _one_poll(responses, poll_id), pad_days, _publication())
    return rows.select("poll_id", "device_id", F.col("best.value").alias("publication_name"))


def identity_candidates(
    responses: DataFrame, events: DataFrame, poll_id: str | None = None, pad_days: int = 1
) -> DataFrame:
    """One row per submission with its own id and what the events of its device suggest; nothing is dropped."""
    responses = _one_poll(responses, poll_id)
    found = _collapsed(events, responses, pad_days, _user(), _publication())
    per_device = found.groupBy("poll_id", "device_id").agg(
        F.max(F.when(F.col("kind") == "user", F.col("best.value"))).alias("recovered_user_id"),
        F.max(F.when(F.col("kind") == "publication", F.col("best.value"))).alias("recovered_publication"),
    )
    own = responses.select(
        "ingestion_id",
        "poll_id",
        blank_to_null(F.col("device_id")).alias("device_id"),
        blank_to_null(F.col("external_id")).alias("payload_external_id"),
    )
    # Submissions without a device would all meet in one partition of their poll; their id spreads them.
    spread = F.coalesce("device_id", F.concat(F.lit("\0"), F.col("ingestion_id").cast("string")))
    return (
        own.withColumn("device_key", spread)
        .join(per_device.withColumnRenamed("device_id", "device_key"), ["poll_id", "device_key"], "left")
        .select(
            "ingestion_id", "poll_id", "device_id", "payload_external_id", "recovered_user_id", "recovered_publication"
        )
    )


def resolve_identity(candidates: DataFrame) -> DataFrame:
    who = resolved_hash(F.col("payload_external_id"), F.col("recovered_user_id"))
    return candidates.withColumn("who", who).select(
        "ingestion_id",
        "poll_id",
        "device_id",
        "who.hem",
        "who.hem_source",
        F.col("recovered_publication").alias("publication_name"),
    )


def respondent_identity(responses: DataFrame, events: DataFrame, poll_id: str | None = None, pad_days: int = 1):
    return resolve_identity(identity_candidates(responses, events, poll_id, pad_days))


def identity_summary(identity: DataFrame) -> DataFrame:
    return identity.groupBy("poll_id", "hem_source").agg(
        F.count("*").alias("row_cnt"), F.count("hem").alias("resolved")
    )


def pending_responses(responses: DataFrame, identity: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """Submissions without an identity row in polls active within `days` of the newest submission."""
    newest = responses.agg(F.max("submitted_at").alias("newest")).scalar()
    last = responses.groupBy("poll_id").agg(F.max("submitted_at").alias("last"))
    active = last.where(F.col("last") >= newest - F.make_dt_interval(days=F.lit(days)))
    return responses.join(identity, "ingestion_id", "left_anti").join(active, "poll_id", "left_semi")


def respondent_demographics(
    identity: DataFrame, email: DataFrame, person: DataFrame, place: DataFrame
) -> DataFrame:
    """One non-identifying row per respondent that matches an e-mail record.

    A hash can match several records; the best one is the greatest (quality, -rank, update date, -id), NULLs last.
    As a maximum it is pre-aggregated before the shuffle, so a hash with many records needs no large group. The
    hashes and the chosen ids are written: as tables of known size they are broadcast to the person tables while
    they are small, so those are filtered where they are read, and shuffled beyond that.
    """
    hems = written(identity.where(F.col("hem").isNotNull()).select("hem").distinct(), "respondent-hashes")
    order = F.struct(
        F.col("emailqualitylevel").alias("quality"),
        (-F.col("rankorder")).alias("rank"),
        F.col("updatedate").alias("updated"),
        (-F.col("id")).alias("id"),
    )
    chosen = (
        email.select("id", F.col("sha256").alias("hem"), "emailqualitylevel", "rankorder", "updatedate")
        .join(hems, "hem", "left_semi")
        .groupBy("hem")
        .agg(F.max(order).alias("best"))
        .select("hem", (-F.col("best.id")).alias("id"))
    )
    chosen = written(chosen, "respondent-persons")
    ids = chosen.select("id")
    d = person.join(ids, "id", "left_semi").withColumnRenamed("gender", "person_gender")
    p = place.join(ids, "id", "left_semi").select("id", F.col("gender").alias("place_gender"), "state", "dma")
    return (
        chosen.join(d, "id", "left")
        .join(p, "id", "left")
        .select(
            "hem",
            age_band(F.col("age")).alias("age_band"),
            "generation",
            "income_hh",
            "net_worth_hh",
            "education",
            "occupation_category",
            "marital_status",
            "home_owner",
            "ethnic_group",
            (F.col("children_hh") > 0).alias("has_children_hh"),
            F.coalesce("place_gender", "person_gender").alias("gender"),
            "state",
            "dma",
            (F.col("owns_investments") == 1).alias("affinity_investor"),
            (F.col("home_owner_ordinal") >= 3).alias("affinity_homeowner"),
        )
    )


def unseen_respondents(identity: DataFrame, demographics: DataFrame) -> DataFrame:
    """Identity rows whose hash is not in the demographics yet; look here before scanning the person tables."""
    return identity.where(F.col("hem").isNotNull()).join(demographics, "hem", "left_anti")


def demographics_coverage(demographics: DataFrame) -> DataFrame:
    return demographics.agg(
        F.count("*").alias("hems"),
        F.count("age_band").alias("with_age"),
        F.count("income_hh").alias("with_income"),
        F.count("state").alias("with_state"),
    )


def audience_profile(
    responses: DataFrame,
    events: DataFrame,
    email: DataFrame,
    person: DataFrame,
    poll_id: str | None = None,
    pad_days: int = 1,
) -> DataFrame:
    """Banded counts of the persons behind a poll: hashes seen on its devices or in its payloads."""
    responses = _one_poll(responses, poll_id)
    respondents = _respondents(responses, pad_days)
    daily = _daily(_within(events, respondents), respondents, _value("user", F.lower("user_id")))
    seen = daily.join(respondents, "device_id").where(_in_window()).select("poll_id", F.col("value").alias("hem"))
    given = responses.where(F.col("external_id") != "").select("poll_id", F.lower("external_id").alias("hem"))
    hems = written(seen.union(given).distinct(), "audience-hashes")
    ids = email.select("id", F.lower("sha256").alias("hem")).join(hems, "hem").select("poll_id", "id").distinct()
    matched = written(ids, "audience-persons")
    unknown = "(unknown)"
    attribute = lambda name: F.struct(
        F.lit(name.upper()).alias("dim"), F.coalesce(F.col(name), F.lit(unknown)).alias("val")
    )
    bands = F.struct(F.lit("AGE_BAND").alias("dim"), age_band(F.col("age"), unknown).alias("val"))
    return (
        matched.join(person.select("id", "age", "income_hh", "net_worth_hh"), "id")
        .select("poll_id", F.explode(F.array(bands, attribute("income_hh"), attribute("net_worth_hh"))).alias("d"))
        .groupBy("poll_id", "d.dim", "d.val")
        .agg(F.count("*").alias("n"))
    )


def identity_faults(identity: DataFrame) -> DataFrame:
    """Rows that break the identity contract: hash shape, or source without hash and the reverse."""
    return identity.where(
        (F.col("hem").isNotNull() & ~is_hash(F.col("hem")))
        | (F.col("hem").isNull() != F.col("hem_source").isNull())
        | ~F.coalesce(F.col("hem_source").isin("payload", "events"), F.lit(True))
    )
