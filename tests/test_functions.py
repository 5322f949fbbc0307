import pytest
from pyspark.sql import functions as F

from canvass.functions import hashes, measures, text

HASH_A = "0123456789abcdef" * 4
HASH_B = "fedcba9876543210" * 4


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, want",
    [("Alpha TV", "alpha_tv"), ("  A -- b!", "a_b"), ("Beta TV Plus", "beta_tv_plus"), ("__x__", "x")],
)
def test_slug(spark, raw, want):
    assert one(spark, text.slug(F.lit(raw))) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("[1]", "[1]"),
        ("```json\n[1]\n```", "[1]"),
        ("```\n[1]\n```", "[1]"),
        ("Here:\n```json\n[1]\n```\nDone", "Here:\n[1]\nDone"),
    ],
)
def test_fences(spark, raw, want):
    assert one(spark, text.without_fences(F.lit(raw))) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ('["a", " b "]', ["a", "b"]),
        ("a, b ,,", ["a", "b"]),
        ("[]", ["[]"]),
        ("[broken", ["[broken"]),
        ("  ", []),
    ],
)
def test_id_list(spark, raw, want):
    assert one(spark, text.id_list(F.lit(raw))) == want


def test_base_poll_id(spark):
    assert one(spark, text.base_poll_id(F.lit("poll_x_Segment-A2"))) == "poll_x"
    assert one(spark, text.base_poll_id(F.lit("poll_segment-a_x"))) == "poll_segment-a_x"


@pytest.mark.parametrize(
    "token, want",
    [("on", True), ("on-le", True), (" OFF ", False), ("control", False), ("no", False), ("false", False), ("", False), (None, False)],
)
def test_eligible(spark, token, want):
    assert one(spark, text.eligible(F.lit(token).cast("string"))) is want


def test_poll_id_shape():
    assert text.require_poll_id("poll_x-1") == "poll_x-1"
    with pytest.raises(ValueError):
        text.require_poll_id("x'; DROP TABLE y")
    with pytest.raises(ValueError):
        text.require_poll_id("poll_x\n")


@pytest.mark.parametrize("raw, want", [(f"  {HASH_A.upper()}\t", HASH_A), ("", None), ("   ", None), (None, None), ("not-a-hash", "not-a-hash")])
def test_normalised_hash(spark, raw, want):
    assert one(spark, hashes.normalised_hash(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(
    "value, want",
    [(HASH_A, True), (HASH_A[:63], False), (HASH_A + "a", False), (HASH_A[:63] + "g", False), (HASH_A.upper(), False), (None, False)],
)
def test_is_hash(spark, value, want):
    assert one(spark, hashes.is_hash(F.lit(value).cast("string"))) is want


@pytest.mark.parametrize(
    "payload, recovered, want",
    [
        (HASH_A, HASH_B, (HASH_A, "payload")),
        (f" {HASH_A.upper()} ", None, (HASH_A, "payload")),
        ("", HASH_B, (HASH_B, "events")),
        ("garbage", HASH_B, (HASH_B, "events")),
        ("bad", "also-bad", (None, None)),
        (None, None, (None, None)),
    ],
)
def test_resolved_hash(spark, payload, recovered, want):
    cast = lambda v: F.lit(v).cast("string")
    assert tuple(one(spark, hashes.resolved_hash(cast(payload), cast(recovered)))) == want


def test_email_hash(spark):
    want = "973dfe463ec85785f5f95af5ba3906eedb2d931c24e69824a89ea65dba4e813b"
    assert one(spark, hashes.email_hash(F.lit(" Test@Example.com "))) == want


@pytest.mark.parametrize("age, want", [(18, "18-34"), (34, "18-34"), (35, "35-44"), (54, "45-54"), (64, "55-64"), (65, "65+"), (None, None)])
def test_age_band(spark, age, want):
    value = F.lit(age).cast("int")
    assert one(spark, measures.age_band(value)) == want
    assert one(spark, measures.age_band(value, "(unknown)")) == (want or "(unknown)")


@pytest.mark.parametrize("part, whole, want", [(1, 2, 50.0), (1, 3, 33.3), (1, 8, 12.5), (1, 800, 0.1), (1, 16, 6.3), (3, 0, None), (3, 2, 150.0)])
def test_percent_rounds_half_up(spark, part, whole, want):
    assert one(spark, measures.percent(F.lit(part), F.lit(whole))) == want


def test_percent_text(spark):
    assert one(spark, measures.percent_text(F.lit(1), F.lit(2))) == "50.0%"
    assert one(spark, measures.percent_text(F.lit(1), F.lit(0))) == "0%"


def test_cells(spark):
    assert one(spark, measures.cell(F.lit(None).cast("boolean"), "boolean")) == ""
    assert one(spark, measures.cell(F.lit(False), "boolean")) == "No"
    assert one(spark, measures.cell(F.array(F.lit("a"), F.lit("b")), "array<string>")) == "a, b"
    assert one(spark, measures.cell(F.lit("2024-01-02 03:04:05.6").cast("timestamp_ntz"), "timestamp_ntz")) == "2024-01-02 03:04:05.600"
