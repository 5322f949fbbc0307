"""Data-quality checks: each is one row (check_name, status, observed, expected)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.measures import AGE_BANDS, OLDEST
from canvass.operators.identity import identity_faults
from canvass.operators.parity import conflicts, copy_parity, id_faults

# Parts of column names that must not appear, for the respondent table and for the export.
DIRECT_NAMES = ["NAME", "ADDRESS", "ZIP", "LAT", "LON", "EMAIL", "CENSUS", "PHONE"]
EXPORT_NAMES = ["FIRST_NAME", "LAST_NAME", "ADDRESS", "ZIP", "LAT", "LON", "EMAIL", "CENSUS"]
# Least share of respondents matched to a person, and of submissions with an age band.
MATCH_RATE = 0.85
AGE_COVERAGE = 0.50


def _result(rows: DataFrame, name: str, passed: Column, observed: Column, expected: Column) -> DataFrame:
    return rows.select(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        observed.cast("long").alias("observed"),
        expected.cast("long").alias("expected"),
    )


def _none(rows: DataFrame, name: str) -> DataFrame:
    counted = rows.agg(F.count("*").alias("n"))
    return _result(counted, name, F.col("n") == 0, F.col("n"), F.lit(0))


def _share(name: str, part: Column, whole: Column, least: float, rows: DataFrame) -> DataFrame:
    ratio = part / F.nullif(whole, F.lit(0))
    return _result(rows, name, F.coalesce(ratio >= least, F.lit(False)), part, whole)


def _columns(spark: SparkSession, name: str, df: DataFrame, parts: list[str]) -> DataFrame:
    found = [c for c in df.columns if any(p in c.upper() for p in parts)]
    return _result(spark.range(1), name, F.lit(not found), F.lit(len(found)), F.lit(0))


def one_row_per_respondent(demographics: DataFrame) -> DataFrame:
    rows = demographics.agg(F.count("*").alias("n"), F.countDistinct("hem").alias("d"))
    return _result(rows, "one row per respondent", F.col("n") == F.col("d"), F.col("n"), F.col("d"))


def match_rate(identity: DataFrame, demographics: DataFrame) -> DataFrame:
    resolved = identity.agg(F.countDistinct("hem").alias("resolved"))
    matched = demographics.agg(F.count("*").alias("matched"))
    rows = resolved.select("resolved", matched.scalar().alias("matched"))
    return _share("respondents matched", F.col("matched"), F.col("resolved"), MATCH_RATE, rows)


def age_is_banded(demographics: DataFrame) -> DataFrame:
    bands = [label for _, label in AGE_BANDS] + [OLDEST]
    return _none(demographics.where(~F.col("age_band").isin(bands)), "age is banded")


def no_direct_names(spark: SparkSession, demographics: DataFrame) -> DataFrame:
    return _columns(spark, "no direct personal columns", demographics, DIRECT_NAMES)


#: Checks of an export: name, numbers from one aggregation (observed, expected), and whether they pass.
_EXPORT = {
    "one export row per submission": ("n", "s", "n = s AND n = d"),
    "age coverage": ("a", "n", f"coalesce(a / nullif(n, 0) >= {AGE_COVERAGE}, false)"),
    "market present": ("m", "1", "m > 0"),
    "unresolved submissions present": ("n - a", "1", "n > a"),
}


def _export_numbers(export: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """One row from one pass over the export: n rows, d ids, a with an age band, m with a market; s submissions."""
    market = F.count("market_name") if "market_name" in export.columns else F.lit(0)
    counted = export.agg(
        F.count("*").alias("n"), F.countDistinct("ingestion_id").alias("d"), F.count("age_band").alias("a"), market.alias("m")
    )
    staged = F.lit(None).cast("long") if responses is None else responses.agg(F.count("*")).scalar()
    return counted.withColumn("s", staged)


def _export_rows(numbers: DataFrame, *names: str) -> DataFrame:
    rows = []
    for name in names:
        observed, expected, passed = _EXPORT[name]
        status = F.when(F.expr(passed), "PASS").otherwise("FAIL")
        values = [F.expr(x).cast("long") for x in (observed, expected)]
        rows.append(F.struct(F.lit(name).alias("check_name"), status.alias("status"), values[0].alias("observed"), values[1].alias("expected")))
    return numbers.select(F.inline(F.array(*rows)))


def unresolved_present(export: DataFrame) -> DataFrame:
    return _export_rows(_export_numbers(export), "unresolved submissions present")


def no_names_in_export(spark: SparkSession, export: DataFrame) -> DataFrame:
    return _columns(spark, "no personal columns in export", export, EXPORT_NAMES)


def identity_contract(identity: DataFrame) -> DataFrame:
    return _none(identity_faults(identity), "hash shape and source")


def one_identity_per_submission(identity: DataFrame) -> DataFrame:
    repeated = identity.groupBy("ingestion_id").agg(F.count("*").alias("n")).where("n > 1")
    return _none(repeated, "one identity row per submission")


def ids_valid(name: str, df: DataFrame, key: str) -> DataFrame:
    return _none(id_faults(df, key), f"{name}: ids present, unique, in range")


def no_conflicts(name: str, source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    return _none(conflicts(source, copy, key), f"{name}: same id, same content")


def copies_equal(name: str, source: DataFrame, copy: DataFrame, key: str | None = None) -> DataFrame:
    row = copy_parity(name, source, copy, key)
    return _result(
        row, f"{name}: copies equal", F.col("status") == "PASS", F.col("copied_count"), F.col("source_count")
    )


def union(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def demographics_checks(spark: SparkSession, identity: DataFrame, demographics: DataFrame) -> DataFrame:
    return union(
        one_row_per_respondent(demographics),
        match_rate(identity, demographics),
        age_is_banded(demographics),
        no_direct_names(spark, demographics),
        identity_contract(identity),
        one_identity_per_submission(identity),
    )


def export_checks(spark: SparkSession, export: DataFrame, responses: DataFrame) -> DataFrame:
    return union(_export_rows(_export_numbers(export, responses), *_EXPORT), no_names_in_export(spark, export))
