"""Upserts as joins, and surrogate ids for new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions.text import normalised
from canvass.operators.catalog import KEYS
from canvass.session import measured, written

# Fixed value: first id of the new range; older ids stay below it.
NEW_IDS_FROM = 10**12
ID_BUCKETS = 4096


def _null_safe(names: list[str]) -> list[Column]:
    """Match keys with NULL and '' as one value, so that they can be compared by an equi-join."""
    return [F.coalesce(F.col(n).cast("string"), F.lit("")).alias(f"_k{i}") for i, n in enumerate(names)]


def latest(source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One source row per key: the greatest by `order`, ties and no order settled by the remaining columns."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    ranked = F.struct(*[F.col(c) for c in (order or []) + rest])
    match = _null_safe(keys)
    picked = source.groupBy(*match).agg(F.max_by(F.struct(*source.columns), F.struct(ranked, *keys)).alias("row"))
    return picked.select("row.*")


def batch(source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The latest rows, written, as a merge reads them for its updates and its inserts and has to know their size."""
    return measured(written(latest(source, keys, order), "batch"))


def updates(target: DataFrame, rows: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """The target with the `update` columns of matched rows taken from `rows` (one row per key).

    The target is joined to the batch, not grouped with it: a batch measured as small can be broadcast and the target
    never moves; a large one (see `measured`) is a shuffle join.
    """
    match = [f"_k{i}" for i in range(len(keys))]
    incoming = rows.select(*_null_safe(keys), F.struct(*update).alias("_new"))
    merged = target.select("*", *_null_safe(keys)).join(incoming, match, "left")
    taken = F.col("_new").isNotNull()
    return merged.select(
        *[
            F.when(taken, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in target.columns
        ]
    )


def inserts(
    target: DataFrame, rows: DataFrame, keys: list[str], insert: dict[str, Column] | None = None
) -> DataFrame:
    """Source rows without a match, in the target's columns. The target's keys are shuffled: they are as many as its rows,
    however small their files."""
    match = [f"_k{i}" for i in range(len(keys))]
    known = target.select(*_null_safe(keys)).hint("merge")
    added = rows.select("*", *_null_safe(keys)).join(known, match, "left_anti")
    given = {**{c: F.col(c) for c in rows.columns}, **(insert or {})}
    types = dict(target.dtypes)
    return added.select(*[given.get(c, F.lit(None)).cast(types[c]).alias(c) for c in target.columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    insert: dict[str, Column] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Target after a merge: matched rows take the `update` columns, unmatched source rows are added.

    `insert` gives columns of new rows that the source does not carry. Running it twice changes nothing.
    """
    rows = batch(source, keys, order)
    return updates(target, rows, keys, update).unionByName(inserts(target, rows, keys, insert))


def assign_ids(rows: DataFrame, keys: list[str], next_id: DataFrame, name: str) -> DataFrame:
    """Dense ids from `next_id` (one row, one column) in parallel: rank inside a hash bucket plus the bucket's offset.

    Bucket and rank follow from the natural key, so a task that is run again gives the same ids.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(ID_BUCKETS)).cast("int")
    placed = rows.drop(name).withColumn("_bucket", bucket)
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("n"))
    # at most ID_BUCKETS rows
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    return (
        placed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, next_id.scalar() + F.col("_offset") + F.col("_rank") - 1)
        .select(*rows.columns)
    )


def number_rows(rows: DataFrame, start: int, name: str) -> DataFrame:
    """Dense ids for rows without a natural key, read from files: place in the partition plus the partition's offset.

    No row moves, so repeated documents cost nothing extra. Only for plans that read files without a shuffle, where
    a partition always holds the same rows in the same order.
    """
    place = F.monotonically_increasing_id()
    placed = rows.select("*", F.spark_partition_id().alias("_part"), place.bitwiseAND(2**33 - 1).alias("_place"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"))
    # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.lit(start) + F.col("_offset") + F.col("_place")).cast("long").alias(name), *rows.columns
    )


def next_option_id(options: DataFrame) -> DataFrame:
    """One row: the first free id of the new range."""
    return options.agg(F.greatest(F.coalesce(F.max("option_id") + 1, F.lit(0)), F.lit(NEW_IDS_FROM)).alias("start"))


def upsert_questions(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    stamped = source.withColumn("updated_at", now)
    return upsert(target, stamped, KEYS, [c for c in target.columns if c not in KEYS])


OPTION_KEYS = [*KEYS, "option_value"]


def _with_new_options(target: DataFrame, kept: DataFrame, added: DataFrame) -> DataFrame:
    numbered = assign_ids(added, OPTION_KEYS, next_option_id(target), "option_id")
    return kept.unionByName(numbered)


def upsert_options(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Catalog options; a match keeps its source, so a typed answer that equals a new option stays 'response'."""
    rows = batch(source, OPTION_KEYS, ["sort_order"]).withColumn("updated_at", now)
    update = ["option_label", "option_description", "is_catch_all", "sort_order", "updated_at"]
    kept = updates(target, rows, OPTION_KEYS, update)
    added = inserts(target, rows, OPTION_KEYS, {"option_source": F.lit("catalog")})
    return _with_new_options(target, kept, added)


def add_text_options(target: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """Insert-only: typed answers become options with source 'response' and no catch-all flag."""
    defaults = {"option_source": F.lit("response"), "is_catch_all": F.lit(False), "updated_at": now}
    added = inserts(target, candidates.select(*OPTION_KEYS).distinct(), OPTION_KEYS, defaults)
    return _with_new_options(target, target, added)


TAXONOMY_KEYS = ["option_id", "bucket", "taxonomy_path", "demographic_key", "condition_sequence"]


def resolve_options(rows: DataFrame, options: DataFrame, source: str) -> DataFrame:
    """Classified rows with the id of their option; typed answers match on normalised text."""
    dim = options.where(F.col("option_source") == source).select("option_id", *OPTION_KEYS)
    if source == "response":
        rows = rows.withColumn("option_value", normalised(F.col("option_value")))
    return rows.join(dim, OPTION_KEYS).drop(*OPTION_KEYS)


def upsert_taxonomy(
    target: DataFrame, rows: DataFrame, options: DataFrame, source: str, now: Column, classified_by: str = "model"
) -> DataFrame:
    """Taxonomy by option, bucket, path, key and condition, so a conditional rule never overwrites a plain one."""
    resolved = (
        resolve_options(rows, options, source)
        .withColumn("condition_sequence", F.lit(None).cast("array<bigint>"))
        .withColumn("updated_at", now)
    )
    update = [
        "taxonomy_depth",
        "taxonomy_levels",
        "demographic_value",
        "demographic_type",
        "confidence",
        "updated_at",
    ]
    defaults = {"classified_by": F.lit(classified_by), "is_approved": F.lit(False)}
    return upsert(target, resolved, TAXONOMY_KEYS, update, defaults, ["confidence"])


def upsert_flat_taxonomy(target: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """The retired form, keyed by the five natural columns."""
    keys = [*OPTION_KEYS, "bucket", "taxonomy_path"]
    update = ["taxonomy_depth", "taxonomy_levels", "confidence", "updated_at"]
    return upsert(target, rows.withColumn("updated_at", now), keys, update, order=["confidence"])


def taxonomy_rule(
    options: DataFrame,
    poll_id: str,
    question_key: str,
    option_value: str,
    bucket: str,
    confidence: float,
    taxonomy_path: str | None = None,
    demographic_key: str | None = None,
    demographic_value: str | None = None,
    demographic_type: str | None = None,
    condition_option_ids: list[int] | None = None,
    classified_by: str = "model",
) -> DataFrame:
    """The row of a hand-made rule (none if the catalog has no such option); append it, it is not merged."""
    if not (poll_id and question_key and option_value and bucket) or confidence is None:
        raise ValueError("a rule needs poll_id, question_key, option_value, bucket and confidence")
    levels = taxonomy_path.split("|") if taxonomy_path else None
    chosen = options.where(
        (F.col("poll_id") == poll_id)
        & (F.col("question_key") == question_key)
        & (F.col("option_value") == option_value)
        & (F.col("option_source") == "catalog")
    )
    return chosen.select(
        "option_id",
        F.lit(bucket).alias("bucket"),
        F.lit(taxonomy_path).cast("string").alias("taxonomy_path"),
        F.lit(len(levels) if levels else None).cast("long").alias("taxonomy_depth"),
        F.lit(levels).cast("array<string>").alias("taxonomy_levels"),
        F.lit(demographic_key).cast("string").alias("demographic_key"),
        F.lit(demographic_value).cast("string").alias("demographic_value"),
        F.lit(demographic_type).cast("string").alias("demographic_type"),
        F.lit(float(confidence)).alias("confidence"),
        F.lit(condition_option_ids or None).cast("array<bigint>").alias("condition_sequence"),
        F.lit(classified_by).alias("classified_by"),
    )
