import json

from helpers import tuples

from canvass.operators import profile


def rules_of(answered, taxonomy, options, **kw):
    return tuples(profile.conditional_taxonomy(answered, taxonomy, options, **kw).select("ingestion_id", "taxonomy_path"))


def test_three_routes(submit, options):
    opts = options((1, "q", "A"), (2, "m", "B"), (3, "t", "free text", "response"), (4, "m", "C", "response"), (5, "q", "a", "response"))
    rows = submit({"answers": [("q", "A"), ("m", ["B", "C", "unknown"]), ("t", "  Free TEXT "), ("t2", "   ")]})
    got = tuples(profile.answer_options(rows, opts))
    # a typed match needs a string: list entry C does not match the typed option
    assert got == [(1, "d1", 0, 1), (1, "d1", 0, 5), (1, "d1", 1, 2), (1, "d1", 2, 3)]


def test_devices(submit, options):
    opts = options((1, "q", "A"))
    rows = submit({"answers": [("q", "A")], "device_id": None}, {"answers": [("q", "A")], "device_id": ""}, {"answers": [("q", "A")]})
    assert [r[0] for r in tuples(profile.answer_options(rows, opts))] == [3]
    assert [r[0] for r in tuples(profile.answer_options(rows, opts, keep_blank_device=True))] == [2, 3]


def test_catch_all_true_and_null_are_left_out(submit, options, taxonomy):
    opts = options((1, "q", "A", "catalog", True), (2, "q", "B", "catalog", None), (3, "q", "C"))
    tax = taxonomy((1, "X|1"), (2, "X|2"), (3, "X|3"))
    rows = submit({"answers": [("q", ["A", "B", "C"])]})
    answered = profile.answer_options(rows, opts)
    assert [r[3] for r in tuples(profile.unconditional_taxonomy(answered, tax, opts))] == ["X|3"]


def test_conditions(submit, options, taxonomy):
    opts = options((1, "a", "A"), (2, "b", "B"), (3, "c", "C"))
    tax = taxonomy((3, "ordered", [1, 2]), (3, "present", [2]), (3, "empty", []))
    rows = submit(
        {"answers": [("a", "A"), ("b", "B"), ("c", "C")]},  # both hold
        {"answers": [("b", "B"), ("a", "A"), ("c", "C")]},  # wrong order
        {"answers": [("c", "C"), ("b", "B")]},  # one missing; presence is enough for a single prerequisite
        {"answers": [("a", "A"), ("b", "B")]},  # the option itself not answered
        {"answers": [("a", ["A", "A"]), ("b", "B"), ("a", "A"), ("c", "C")]},  # repeated: first position counts
    )
    answered = profile.answer_options(rows, opts)
    assert rules_of(answered, tax, opts) == [
        (1, "ordered"),
        (1, "present"),
        (2, "present"),
        (3, "present"),
        (5, "ordered"),
        (5, "present"),
    ]
    assert (3, "present") not in rules_of(answered, tax, opts, strict_order=True)
    assert [r[3] for r in tuples(profile.unconditional_taxonomy(answered, tax, opts))] == ["empty"] * 4


def test_same_position_is_not_ascending(submit, options, taxonomy):
    opts = options((1, "m", "A"), (2, "m", "B"), (3, "c", "C"))
    rows = submit({"answers": [("m", ["A", "B"]), ("c", "C")]})
    answered = profile.answer_options(rows, opts)
    assert rules_of(answered, taxonomy((3, "x", [1, 2])), opts) == []


def test_two_conditional_rules_on_one_option_do_not_mix(submit, options, taxonomy):
    opts = options((1, "a", "A"), (2, "b", "B"), (3, "c", "C"), (4, "d", "D"))
    tax = taxonomy((4, "one", [1, 3]), (4, "two", [2, 3]))
    rows = submit({"answers": [("a", "A"), ("b", "B"), ("c", "C"), ("d", "D")]})
    assert rules_of(profile.answer_options(rows, opts), tax, opts) == [(1, "one"), (1, "two")]


def test_profile(submit, options, taxonomy):
    opts = options((1, "a", "A"), (2, "a", "B"), (3, "t", "x", "response"))
    tax = taxonomy((1, "Z|1"), (1, "A"), (2, "A"), (3, ("age", "65+")), (1, ("age", "old")))
    rows = submit({"answers": [("a", "A"), ("t", "X")]}, {"answers": [("a", "B")]}, {"answers": [("a", "B")], "device_id": "d2"})
    got = tuples(profile.profile_sync(rows, opts, tax))
    assert got == [
        ("d1", "age", "65+"),
        ("d1", "age", "old"),
        ("d1", "preference_insights", json.dumps(["A", "Z|1"], separators=(",", ":"))),
        ("d2", "preference_insights", '["A"]'),
    ]
    summary = {r[0]: r[1:] for r in tuples(profile.profile_summary(profile.profile_sync(rows, opts, tax)))}
    assert summary == {"age": (2, 1), "preference_insights": (2, 2)}


def test_simple_profile_ignores_lists(submit, options, taxonomy):
    opts = options((1, "a", "A"), (2, "m", "B"))
    tax = taxonomy((1, ("age", "old")), (2, "L"))
    rows = submit({"answers": [("a", "A"), ("m", ["B"])]})
    assert tuples(profile.device_attributes(rows, opts, tax, "d1")) == [("d1", "demographic", "age = old")]


def test_hot_option_is_split(spark, submit, options, taxonomy):
    """A third of all answers on one option: the join on it is split by size and the result stays whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    n = 6000
    rows = spark.range(0, n, 1, 6).selectExpr(
        "id AS ingestion_id",
        """to_json(struct('p' AS poll_id, concat('d', id) AS device_id, array(struct('q' AS question,
        CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id % 50) END AS answer)) AS answers)) AS raw""",
    )
    from canvass.sources.responses import stage

    opts = options((1, "q", "hot"), *[(i + 2, "q", f"v{i}") for i in range(50)])
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = profile.answer_options(stage(rows), opts)
        assert joined.count() == n
        joined.collect()
        counted = joined.groupBy("ingestion_id").count()
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
