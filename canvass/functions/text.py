"""Text rules shared by the jobs. `trim` here strips blanks (SQL rule); `strip` strips any white space (form rule)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape a poll id must have.
POLL_ID_SHAPE = r"^[A-Za-z0-9_-]+$"
# Fixed value: suffix of a poll variant, removed when completed polls are compared.
SEGMENT_SUFFIX = r"(?i)_segment-[a-z0-9]+$"
# Experiment tokens that mean "not eligible".
NOT_ELIGIBLE = ["off", "control", "false", "no"]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def normalised(text: Column) -> Column:
    """Key form of a free-text answer."""
    return F.lower(F.trim(text))


def not_blank(text: Column) -> Column:
    return F.trim(text) != ""


def slug(text: Column) -> Column:
    """Lower case, every run of other characters than letters and digits as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def path_levels(path: Column) -> Column:
    return F.split(path, "[|]")


def path_depth(path: Column) -> Column:
    return F.when(path.isNotNull(), F.size(path_levels(path))).cast("long")


def without_fences(text: Column) -> Column:
    """Drop the first opening and the first closing Markdown fence around a JSON reply."""
    opened = F.regexp_replace(text, r"(?ms)\A(.*?)^```(?:json)?\s*", "$1")
    return F.regexp_replace(opened, r"(?ms)\A(.*?)\s*```$", "$1")


def base_poll_id(poll_id: Column) -> Column:
    return F.regexp_replace(poll_id, SEGMENT_SUFFIX, "")


def id_list(raw: Column) -> Column:
    """Ids from a JSON array or, where that is none or empty, a comma list; blanks removed."""
    text = strip(raw)
    listed = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    ids = F.when(F.size(listed) > 0, listed).otherwise(F.split(text, ","))
    return F.filter(F.transform(ids, strip), lambda v: v != "")


def eligible(token: Column) -> Column:
    """True for a serving experiment token; NULL and blank tokens are not eligible."""
    value = F.lower(strip(token))
    return F.coalesce((value != "") & ~value.isin(NOT_ELIGIBLE), F.lit(False))


def require_poll_id(poll_id: str) -> str:
    if not re.fullmatch(POLL_ID_SHAPE, poll_id):
        raise ValueError(f"refusing unsafe poll id: {poll_id!r}")
    return poll_id
