from datetime import date, datetime

import pytest
from helpers import tuples

from canvass.operators import identity

HASHES = [c * 64 for c in "abcdef"]


@pytest.fixture(scope="module")
def events(spark):
    def build(*rows):
        full = [
            (device, user, datetime.fromisoformat(at), kind, props)
            for device, user, at, kind, props in [(list(r) + ["click", "{}"])[: 5] if len(r) < 5 else r for r in rows]
        ]
        return spark.createDataFrame(
            full, "device_id string, user_id string, event_time timestamp_ntz, event_type string, event_properties string"
        )

    return build


def sent(at, **doc):
    return {"submitted_at": at, **doc}


@pytest.mark.parametrize(
    "first, last, pad, want",
    [
        ("2025-03-04T13:29:55.695Z", "2025-03-08T19:40:55.657Z", 1, (date(2025, 3, 3), date(2025, 3, 9))),
        ("2025-05-01", "2025-05-31", 2, (date(2025, 4, 29), date(2025, 6, 2))),
        ("nope", "nope", 1, (None, None)),
    ],
)
def test_window(submit, first, last, pad, want):
    row = identity.event_window(submit(sent(first), sent(last)), "p", pad).first()
    assert (row["win_start"], row["win_end"]) == want and row["responses"] == 2


def test_window_ends_at_midnight(submit, events):
    rows = submit(sent("2024-01-10T12:00:00Z"))
    seen = events(
        ("d1", HASHES[0], "2024-01-09 00:00:00"),
        ("d1", HASHES[1], "2024-01-11 00:00:00"),
        ("d1", HASHES[1], "2024-01-11 00:00:00"),
        ("d1", HASHES[2], "2024-01-11 00:00:01"),
        ("d1", HASHES[2], "2024-01-11 10:00:00"),
        ("d1", HASHES[2], "2024-01-08 23:59:59"),
    )
    assert tuples(identity.device_user(rows, seen)) == [("p", "d1", HASHES[1])]


def test_most_frequent_then_latest_then_greatest(submit, events):
    day = "2024-01-10"
    rows = submit(*[sent(f"{day}T01:00:00Z", device_id=d) for d in ("d1", "d2", "d3", "d4")])
    seen = events(
        *[("d1", HASHES[0], f"{day} 0{i}:00:00") for i in range(3)],
        ("d1", HASHES[1], f"{day} 09:00:00"),
        ("d2", HASHES[0], f"{day} 02:00:00"),
        ("d2", HASHES[1], f"{day} 01:00:00"),
        ("d3", HASHES[0], f"{day} 01:00:00"),
        ("d3", HASHES[1], f"{day} 01:00:00"),
        ("d4", None, f"{day} 01:00:00"),
        ("d9", HASHES[0], f"{day} 01:00:00"),
    )
    assert tuples(identity.device_user(rows, seen)) == [("p", "d1", HASHES[0]), ("p", "d2", HASHES[0]), ("p", "d3", HASHES[1])]


def test_publication_only_from_survey_events(submit, events):
    rows = submit(sent("2024-01-10T01:00:00Z"))
    at = "2024-01-10 01:00:00"
    seen = events(
        ("d1", None, at, "[Guides-Surveys] shown", '{"publication_name":"Gazette"}'),
        ("d1", None, at, "page view", '{"publication_name":"Other"}'),
        ("d1", None, at, "page view", '{"publication_name":"Other"}'),
        ("d1", None, at, "G", '{"publication_name":"Letter"}'),
        ("d1", None, at, "[Guides-Surveys] x", '{"publication_name":""}'),
        ("d1", None, at, "[Guides-Surveys] x", '{"other":1}'),
    )
    assert tuples(identity.device_publication(rows, seen)) == [("p", "d1", "Gazette")]


def test_every_submission_survives(submit, events):
    at = "2024-01-10T01:00:00Z"
    rows = submit(
        sent(at, external_id=f" {HASHES[0].upper()} "),
        sent(at, external_id="garbage"),
        sent(at, device_id=None),
        sent(at, device_id="", external_id=""),
        sent(at, device_id="unseen", external_id="garbage"),
        sent(None, poll_id="untimed", external_id=HASHES[2]),
    )
    seen = events(("d1", HASHES[1].upper(), "2024-01-10 05:00:00"), ("", HASHES[3], "2024-01-10 05:00:00"))
    got = {r["ingestion_id"]: (r["hem"], r["hem_source"], r["device_id"]) for r in identity.respondent_identity(rows, seen).collect()}
    assert got == {
        1: (HASHES[0], "payload", "d1"),
        2: (HASHES[1], "events", "d1"),
        3: (None, None, None),
        4: (None, None, None),
        5: (None, None, "unseen"),
        6: (HASHES[2], "payload", "d1"),
    }


def test_windows_are_per_poll(submit, events):
    rows = submit(sent("2024-01-10T01:00:00Z", poll_id="a"), sent("2024-02-10T01:00:00Z", poll_id="b"))
    seen = events(("d1", HASHES[0], "2024-01-10 02:00:00"), ("d1", HASHES[1], "2024-02-10 02:00:00"))
    assert tuples(identity.device_user(rows, seen)) == [("a", "d1", HASHES[0]), ("b", "d1", HASHES[1])]


def test_no_windows_no_events(submit, events):
    assert tuples(identity.device_user(submit({"device_id": None}), events(("d1", HASHES[0], "2024-01-10 02:00:00")))) == []


def test_event_scan_is_bounded(spark, submit, events, tmp_path):
    path = str(tmp_path / "events")
    events(("d1", HASHES[0], "2024-01-10 02:00:00")).write.parquet(path)
    rows = submit(sent("2024-01-10T01:00:00Z"))
    plan = identity.device_user(rows, spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time,2024-01-09T00:00)" in plan
    assert "event_properties" not in plan.split("Location")[0].split("FileScan parquet")[-1]


def people(spark):
    email = spark.createDataFrame(
        [
            (1, HASHES[0], 5, 2, date(2024, 1, 1)),
            (2, HASHES[0], 5, 1, date(2024, 1, 1)),
            (3, HASHES[0], None, 0, date(2025, 1, 1)),
            (4, HASHES[1], 1, None, None),
            (5, HASHES[1], 1, None, date(2024, 1, 1)),
            (7, HASHES[2], 1, 1, None),
            (6, HASHES[2], 1, 1, None),
            (8, HASHES[5], 1, 1, None),
        ],
        "id bigint, sha256 string, emailqualitylevel bigint, rankorder bigint, updatedate date",
    )
    columns = "generation income_hh net_worth_hh education occupation_category marital_status home_owner ethnic_group"
    text = ", ".join(f"{c} string" for c in columns.split())
    person = spark.createDataFrame(
        [
            (2, 40, *["x"] * 8, 0, "F", 1, 1),
            (5, None, *[None] * 8, None, "M", None, None),
            (8, 99, *["y"] * 8, 2, "M", 4, 1),
        ],
        f"id bigint, age bigint, {text}, children_hh bigint, gender string, home_owner_ordinal bigint, owns_investments bigint",
    )
    place = spark.createDataFrame([(2, "X", "TX", 77), (5, None, "GA", 524)], "id bigint, gender string, state string, dma int")
    return email, person, place


def test_one_person_per_respondent(spark):
    email, person, place = people(spark)
    who = spark.createDataFrame([(1, HASHES[0]), (2, HASHES[0]), (3, HASHES[1]), (4, HASHES[2]), (5, HASHES[3]), (6, None)], "ingestion_id bigint, hem string")
    rows = {r["hem"]: r for r in identity.respondent_demographics(who, email, person, place).collect()}
    assert set(rows) == set(HASHES[:3])
    a, b, c = (rows[h] for h in HASHES[:3])
    assert (a["age_band"], a["gender"], a["state"], a["has_children_hh"], a["affinity_investor"], a["affinity_homeowner"]) == ("35-44", "X", "TX", False, True, False)
    assert (b["age_band"], b["gender"], b["state"], b["has_children_hh"], b["affinity_homeowner"]) == (None, "M", "GA", None, None)
    assert c["age_band"] is None and c["generation"] is None


def test_pending_and_unseen(spark, submit):
    rows = submit(sent("2024-03-30T00:00:00Z"), sent("2024-03-30T00:00:00Z"), sent("2024-03-01T00:00:00Z", poll_id="old"))
    known = spark.createDataFrame([(1,)], "ingestion_id bigint")
    assert [r["ingestion_id"] for r in identity.pending_responses(rows, known).collect()] == [2]
    who = spark.createDataFrame([(HASHES[0],), (HASHES[1],), (None,)], "hem string")
    assert [r["hem"] for r in identity.unseen_respondents(who, who.limit(1)).collect()] == [HASHES[1]]


def test_audience(spark, submit, events):
    email, person, _ = people(spark)
    rows = submit(sent("2024-01-10T01:00:00Z"), sent("2024-01-10T01:00:00Z", device_id="", external_id=HASHES[5].upper()))
    seen = events(("d1", HASHES[0].upper(), "2024-01-10 02:00:00"))
    got = tuples(identity.audience_profile(rows, seen, email, person))
    # three records of one hash, one of them with a person; the payload's hash adds another
    assert got == [
        ("p", "AGE_BAND", "35-44", 1),
        ("p", "AGE_BAND", "65+", 1),
        ("p", "INCOME_HH", "x", 1),
        ("p", "INCOME_HH", "y", 1),
        ("p", "NET_WORTH_HH", "x", 1),
        ("p", "NET_WORTH_HH", "y", 1),
    ]


def test_faults(spark):
    rows = [(1, HASHES[0], "payload"), (2, "short", "events"), (3, HASHES[0], None), (4, None, "events"), (5, None, None), (6, HASHES[0], "guess")]
    df = spark.createDataFrame(rows, "ingestion_id bigint, hem string, hem_source string")
    assert [r[0] for r in tuples(identity.identity_faults(df))] == [2, 3, 4, 6]


def test_only_the_days_of_the_windows_are_read(spark, submit, events, tmp_path):
    """Two polls two years apart: the scan skips what lies between, by filters that reach the files."""
    rows = submit(sent("2022-03-01T05:00:00Z", poll_id="old"), sent("2024-03-01T05:00:00Z", poll_id="new", device_id="d2"))
    seen = events(
        ("d1", HASHES[0], "2022-03-01 01:00:00"), ("d1", HASHES[1], "2023-03-01 01:00:00"), ("d2", HASHES[2], "2024-03-01 01:00:00")
    )
    seen.write.parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    kept = identity._within(stored, identity._respondents(rows, 1))
    assert sorted(r["event_time"].year for r in kept.collect()) == [2022, 2024]
    plan = kept._jdf.queryExecution()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(event_time,2022-02-28" in plan.executedPlan().toString()
    assert "event_time#" in (text := plan.optimizedPlan().toString()) and "2024-02-29 00:00:00" in text
    assert tuples(identity.device_user(rows, stored)) == [("new", "d2", HASHES[2]), ("old", "d1", HASHES[0])]
