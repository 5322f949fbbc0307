"""Bands, three-valued flags, percents and report cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age bands as (exclusive upper bound, label); the last is open.
AGE_BANDS = [(35, "18-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST = "65+"


def age_band(age: Column, unknown: str | None = None) -> Column:
    bands = F.when(age.isNull(), F.lit(unknown).cast("string"))
    for bound, label in AGE_BANDS:
        bands = bands.when(age < bound, F.lit(label))
    return bands.otherwise(F.lit(OLDEST))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded half up on integers so that no binary fraction decides a tie; NULL for whole 0."""
    scale = 10**digits
    doubled = F.nullif(whole.cast("long") * 2, F.lit(0).cast("long"))
    rounded = F.floor((part.cast("long") * (200 * scale) + whole.cast("long")).cast("decimal(38,0)") / doubled)
    return (rounded / F.lit(scale)).cast("double")


def percent_text(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.format_string("%.1f%%", percent(part, whole))).otherwise(F.lit("0%"))


def timestamp_text(value: Column) -> Column:
    """A zoneless timestamp to the millisecond, independent of the session time zone."""
    text = value.cast("string")
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0"))


def cell(value: Column, dtype: str) -> Column:
    """One report cell: blank for NULL, Yes/No for booleans, lists joined with a comma."""
    if dtype == "boolean":
        text = F.when(value, F.lit("Yes")).otherwise(F.lit("No"))
    elif dtype.startswith("array"):
        text = F.array_join(F.transform(value, lambda v: F.coalesce(v.cast("string"), F.lit(""))), ", ")
    elif dtype == "timestamp_ntz":
        text = timestamp_text(value)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("")).otherwise(text)
