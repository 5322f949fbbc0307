import random
from datetime import date, datetime

from helpers import tuples

from canvass.operators import identity, parity

SCHEMA = "id bigint, v string"


def test_differences_of_copies(spark):
    rng = random.Random(1)
    source = {i: f"v{i}" for i in range(-300, 3000, 3)}
    copy = dict(source)
    for k in rng.sample(sorted(source), 9):
        copy[k] += "!"
    gone = rng.sample(sorted(source), 5)
    for k in gone:
        copy.pop(k)
    copy |= {10**9: "new", 5001: "x"}
    rows = lambda d: spark.createDataFrame(list(d.items()) + [(None, "no id")], SCHEMA).repartition(3)
    want = {(k, "missing") for k in source.keys() - copy.keys()} | {(k, "extra") for k in copy.keys() - source.keys()}
    want |= {(k, "changed") for k in source.keys() & copy.keys() if source[k] != copy[k]}
    for shape in ({}, {"leaf": 3, "step": 2, "height": 4}, {"leaf": 0, "step": 1, "height": 0}):
        assert set(tuples(parity.copy_differences(rows(source), rows(copy), "id", **shape))) == want
    ranges = parity.differing_ranges(rows(source), rows(copy), "id", leaf=4, step=2).collect()
    assert {(k >> 4) for k, _ in want} == {r["first_key"] >> 4 for r in ranges}
    assert all(r["last_key"] == r["first_key"] + 15 for r in ranges)


def test_repeated_and_null_keys(spark):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (None, "m"), (4, None)], SCHEMA)
    copy = spark.createDataFrame([(1, "a"), (None, "n"), (None, "o"), (4, None)], SCHEMA)
    assert set(tuples(parity.copy_differences(source, copy, "id"))) == {(1, "missing"), (None, "changed")}
    assert parity.copy_differences(source, source, "id").collect() == []
    assert set(tuples(parity.copy_differences(source, copy.where("false"), "id"))) == {(1, "missing"), (None, "missing"), (4, "missing")}


def test_only_differing_ranges_are_looked_into(spark):
    source = spark.range(4096).selectExpr("id", "cast(id as string) v")
    copy = source.selectExpr("id", "if(id = 77, 'x', v) v")
    a, b = (parity.HashTree(df, "id", leaf=4, step=2, height=3) for df in (source, copy))
    assert [level.count() for level in a.levels] == [256, 64, 16, 4]
    assert tuples(a.differing(b)) == [(77 >> 4, 16, 16)]
    top = a._unequal(a.levels[3], b.levels[3])
    assert a._below(a.levels[2], top).count() == 4


def test_lost_columns_fail(spark):
    source = spark.createDataFrame([(1, "a", 2)], "id bigint, v string, n int")
    assert parity.copy_parity("t", source, source).first()["status"] == "PASS"
    assert parity.copy_parity("t", source, source.drop("v")).first()["status"] == "FAIL"
    assert parity.copy_parity("t", source, source.selectExpr("id", "v", "cast(n as bigint) n")).first()["status"] == "FAIL"
    assert parity.copy_parity("t", source, source.selectExpr("*", "1 AS own")).first()["status"] == "PASS"
    assert tuples(parity.lost_columns(source, source.selectExpr("id", "cast(n as bigint) n"))) == [("n", "int", "bigint"), ("v", "string", None)]


def test_covered_days(spark):
    """Few ranges over many windows; the widest gaps stay out."""
    windows = [(date(2024, m, 1), date(2024, m, 2)) for m in range(1, 13)] + [(date(2024, 1, 2), date(2024, 1, 20)), (date(2020, 5, 5), date(2020, 5, 5))]
    df = spark.createDataFrame(windows, "win_start date, win_end date")
    for most in (1, 2, 3, 64):
        got = sorted((r["first"], r["end"]) for r in identity.covered_days(df, most).collect())
        assert len(got) <= most
        assert all(any(a <= s and e < b for a, b in got) for s, e in windows)
    assert got[0] == (date(2020, 5, 5), date(2020, 5, 6)) and len(got) == 13
    two = sorted((r["first"], r["end"]) for r in identity.covered_days(df, 2).collect())
    assert two == [(date(2020, 5, 5), date(2020, 5, 6)), (date(2024, 1, 1), date(2024, 12, 3))]


def test_absurd_dates_cost_one_range(spark, submit):
    """A submission of the year 1 and one of 9999 make one wide range, no list of days."""
    rows = submit(
        {"submitted_at": "0001-01-01T00:00:00Z"}, {"submitted_at": "9999-12-01T00:00:00Z"}, {"poll_id": "r", "submitted_at": "2024-03-01T00:00:00Z"}
    )
    events = spark.createDataFrame(
        [("d1", "u", datetime(2024, 3, 1), "x", None), ("d1", "w", datetime(1999, 3, 1), "x", None)],
        "device_id string, user_id string, event_time timestamp_ntz, event_type string, event_properties string",
    )
    assert identity.covered_days(identity._respondents(rows, 1).select("win_start", "win_end")).count() == 1
    assert sorted(tuple(r) for r in identity.device_user(rows, events).collect()) == [("p", "d1", "u"), ("r", "d1", "u")]
