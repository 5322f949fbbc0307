from datetime import datetime

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from canvass.operators import upsert
from canvass.session import measured, written
from canvass.sources import schemas

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 6, 1)


def stamp():
    return F.lit(NEW).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def catalog_rows(spark):
    def build(*rows):
        return spark.createDataFrame([("p", *r) for r in rows], schemas.OPTIONS)

    return build


def test_generic_merge(spark):
    target = spark.createDataFrame([("a", None, 1, "keep"), ("b", "x", 2, "keep")], "k string, n string, v int, other string")
    source = spark.createDataFrame([("a", "", 10), ("b", "x", 20), ("b", "x", 30), ("c", None, 5)], "k string, n string, v int")
    merged = upsert.upsert(target, source, ["k", "n"], ["v"], {"other": F.lit("new")}, ["v"])
    # NULL and '' are one key, of two source rows the greatest wins
    want = [("a", None, 10, "keep"), ("b", "x", 30, "keep"), ("c", None, 5, "new")]
    assert tuples(merged) == want
    assert tuples(upsert.upsert(merged, source, ["k", "n"], ["v"], {"other": F.lit("new")}, ["v"])) == want


def test_joins_go_by_the_size_of_the_rows_not_of_their_files(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        # a megabyte of rows each, in files of a few KB
        table = lambda n: written(spark.range(n).select((F.col("id") % 3000).alias("k"), F.lit("x" * 400).alias("v")), "table")
        joins = lambda target, source: [line.split("Join")[0].split()[-1] for line in upsert.upsert(target, source, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString().splitlines() if "Join " in line]
        assert joins(table(3000), table(3000)) == ["SortMerge", "SortMerge"]
        # a small batch: the target doesn't move for its updates, and its keys aren't broadcast for the inserts
        assert joins(table(3000), table(5)) == ["BroadcastHash", "SortMerge"]
        assert upsert.upsert(table(3000), table(3005), ["k"], ["v"]).count() == 3000
        wide, empty = written(spark.range(3).select(F.repeat(F.lit("é"), F.lit(20000)).alias("v")), "wide"), written(spark.range(0), "empty")
        assert [("merge" in df._jdf.logicalPlan().toString()) for df in map(measured, (table(5), wide, empty))] == [False, True, False]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_options_keep_their_source_and_id(options, catalog_rows):
    target = options((7, "q", "A"), (9, "t", "typed", "response"))
    rows = catalog_rows(("q", "A", "Label", None, True, 0), ("t", "typed", None, None, False, 1), ("q", "B", None, "d", False, 2))
    once = upsert.upsert_options(target, rows, stamp())
    got = {(r["question_key"], r["option_value"]): r for r in once.collect()}
    assert got["q", "A"]["option_id"] == 7 and got["q", "A"]["is_catch_all"] and got["q", "A"]["updated_at"] == NEW
    assert got["t", "typed"]["option_source"] == "response" and got["t", "typed"]["sort_order"] == 1
    assert got["q", "B"]["option_id"] == upsert.NEW_IDS_FROM and got["q", "B"]["option_source"] == "catalog"
    assert tuples(upsert.upsert_options(once, rows, stamp())) == tuples(once)


def test_text_options_are_only_added(spark, options):
    target = options((7, "t", "old", "response"))
    candidates = spark.createDataFrame([("p", "t", v) for v in ("old", "new", "new", "other")], "poll_id string, question_key string, option_value string")
    got = tuples(upsert.add_text_options(target, candidates, stamp()).select("option_value", "option_source", "is_catch_all", "updated_at"))
    assert got == [("new", "response", False, NEW), ("old", "response", False, OLD), ("other", "response", False, NEW)]


def test_ids_are_dense_disjoint_and_repeatable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(None).cast("bigint").alias("option_id"))
    start = spark.range(1).select(F.lit(100).alias("s"))
    first = {r["k"]: r["option_id"] for r in upsert.assign_ids(rows, ["k"], start, "option_id").collect()}
    again = {r["k"]: r["option_id"] for r in upsert.assign_ids(rows.repartition(7), ["k"], start, "option_id").collect()}
    assert sorted(first.values()) == list(range(100, 5100)) and first == again


def test_next_id(spark, options):
    assert upsert.next_option_id(options((7, "q", "A"))).first()[0] == upsert.NEW_IDS_FROM
    assert upsert.next_option_id(options((upsert.NEW_IDS_FROM + 3, "q", "A"))).first()[0] == upsert.NEW_IDS_FROM + 4


@pytest.fixture(scope="module")
def classified(spark):
    def build(*rows):
        full = [("p", q, v, "preference", path, 1, [path], None, None, None, conf) for q, v, path, conf in rows]
        return spark.createDataFrame(full, schemas.TAXONOMY_ROWS)

    return build


def test_taxonomy(options, taxonomy, classified):
    opts = options((1, "q", "A"), (2, "t", "typed text", "response"))
    target = taxonomy((1, "X"), (1, "X", [2]))
    rows = classified(("q", "A", "X", 0.2), ("q", "A", "X", 0.3), ("q", "A", "Y", 0.5), ("q", "gone", "Z", 0.5), ("t", "typed text", "Z", 0.5))
    merged = upsert.upsert_taxonomy(target, rows, opts, "catalog", stamp())
    got = tuples(merged.select("option_id", "taxonomy_path", "confidence", "condition_sequence", "is_approved", "updated_at"))
    # the conditional rule on the same path is untouched, unknown options and the other source are left out
    assert got == [(1, "X", 0.3, None, False, NEW), (1, "X", 0.9, [2], False, OLD), (1, "Y", 0.5, None, False, NEW)]
    assert tuples(upsert.upsert_taxonomy(merged, rows, opts, "catalog", stamp())) == tuples(merged)
    typed = upsert.upsert_taxonomy(target, classified(("t", " Typed TEXT ", "Z", 0.5)), opts, "response", stamp())
    assert (2, "Z") in tuples(typed.select("option_id", "taxonomy_path"))


def test_flat_taxonomy(classified):
    target = classified(("q", "A", "X", 0.1)).withColumn("updated_at", F.lit(OLD).cast("timestamp_ntz"))
    merged = upsert.upsert_flat_taxonomy(target, classified(("q", "A", "X", 0.4), ("q", "B", "X", 0.5)), stamp())
    assert tuples(merged.select("option_value", "confidence")) == [("A", 0.4), ("B", 0.5)]


def test_rule(options):
    opts = options((1, "q", "A"), (2, "q", "typed", "response"))
    row = upsert.taxonomy_rule(opts, "p", "q", "A", "preference", 1, taxonomy_path="A|B|C", condition_option_ids=[4, 5]).first()
    assert (row["option_id"], row["taxonomy_depth"], row["taxonomy_levels"], row["condition_sequence"]) == (1, 3, ["A", "B", "C"], [4, 5])
    flat = upsert.taxonomy_rule(opts, "p", "q", "A", "demographic", 0.5, demographic_key="k", demographic_value="v").first()
    assert flat["taxonomy_path"] is None and flat["taxonomy_depth"] is None and flat["condition_sequence"] is None
    assert upsert.taxonomy_rule(opts, "p", "q", "typed", "preference", 1).count() == 0
    with pytest.raises(ValueError):
        upsert.taxonomy_rule(opts, "p", "q", "A", "preference", None)
