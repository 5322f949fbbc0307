"""Copies of a table: equality, missing rows, conflicting rows, id ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.operators.upsert import NEW_IDS_FROM
from canvass.session import written


def _comparable(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in a form that can be hashed and compared: VARIANT and maps as JSON text."""
    types = dict(df.dtypes)

    def plain(name: str):
        if types[name] == "variant":
            return F.to_json(F.col(name)).alias(name)
        if types[name].startswith("map"):
            return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(name)))).alias(name)
        return F.col(name)

    return df.select(*[plain(c) for c in columns])


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: row count and the sum of row hashes, which is free of row order and counts repeated rows."""
    rows = _comparable(df, columns or sorted(df.columns))
    digest = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("row_cnt"), F.coalesce(F.sum(digest), F.lit(0)).alias("row_hash"))


def copy_parity(name: str, source: DataFrame, copy: DataFrame, id_column: str | None = None) -> DataFrame:
    """One PASS/FAIL row; rows of the copy's own new id range are left out if an id column is given. A copy that lacks a
    column of the source, or has it in another type, fails; columns of its own are its own affair."""
    if id_column is not None:
        copy = copy.where(F.col(id_column) < NEW_IDS_FROM)
    types = dict(copy.dtypes)
    whole = all(types.get(c) == t for c, t in source.dtypes)
    columns = sorted(c for c, t in source.dtypes if types.get(c) == t)
    s = fingerprint(source, columns).toDF("source_count", "s_hash")
    c = fingerprint(copy, columns).toDF("copied_count", "c_hash")
    other = c.select(F.struct("copied_count", "c_hash")).scalar()
    both = s.select("*", other.alias("c")).select("*", "c.*")
    same = F.lit(whole) & (F.col("source_count") == F.col("copied_count")) & (F.col("s_hash") == F.col("c_hash"))
    return both.select(
        F.lit(name).alias("object_name"),
        "source_count",
        "copied_count",
        F.when(same, "PASS").otherwise("FAIL").alias("status"),
    )


def lost_columns(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Columns of the source that the copy lacks or has in another type."""
    types = dict(copy.dtypes)
    rows = [(c, t, types.get(c)) for c, t in source.dtypes if types.get(c) != t]
    return source.sparkSession.createDataFrame(rows, "column_name string, source_type string, copied_type string")


class HashTree:
    """Digests of a table by ranges of a whole-number key, in levels: a range of one level is 2 ** step ranges of the next.

    The leaves come from one aggregation that is combined before its shuffle; a level is the sum of the one below, so all
    levels together cost little more than the leaves. `leaf` is the binary logarithm of the keys in a leaf.
    Rows without a key are a range of their own at every level (first NULL).
    """

    def __init__(self, df: DataFrame, key: str, columns: list[str] | None = None, leaf: int = 10, step: int = 6, height: int = 3):
        self.key, self.leaf, self.step, self.height = key, leaf, step, height
        rows = _comparable(df, sorted({key, *(columns or df.columns)}))
        place = F.shiftright(F.col(key).cast("long"), leaf)
        digest = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
        leaves = rows.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.sum(digest).alias("digest"))
        self.levels = [written(leaves, "hash-leaves")]
        for _ in range(height):
            above = self.levels[-1].groupBy(F.shiftright("place", step).alias("place"))
            self.levels.append(written(above.agg(F.sum("n").alias("n"), F.sum("digest").cast("decimal(38,0)").alias("digest")), "hash-level"))

    def differing(self, other: HashTree) -> DataFrame:
        """Leaves whose digests differ: (place, source_count, copied_count). Only below ranges that differ is the next
        level looked at."""
        found = None
        for level in range(self.height, -1, -1):
            mine, theirs = self.levels[level], other.levels[level]
            if found is not None:
                mine, theirs = (self._below(x, found) for x in (mine, theirs))
            found = self._unequal(mine, theirs)
            if level:
                found = written(found, "hash-differences")
        return found

    def _below(self, rows: DataFrame, above: DataFrame) -> DataFrame:
        up = above.select(F.col("place").alias("up"))
        return rows.join(up, F.shiftright("place", self.step).eqNullSafe(F.col("up")), "left_semi")

    @staticmethod
    def _unequal(mine: DataFrame, theirs: DataFrame) -> DataFrame:
        a, b = mine.alias("a"), theirs.alias("b")
        met = a.join(b, F.col("a.place").eqNullSafe(F.col("b.place")), "full_outer")
        same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))
        counts = [F.coalesce(f"{t}.n", F.lit(0)).alias(c) for t, c in (("a", "source_count"), ("b", "copied_count"))]
        return met.where(~same).select(F.coalesce("a.place", "b.place").alias("place"), *counts)


def differing_ranges(source: DataFrame, copy: DataFrame, key: str, **shape) -> DataFrame:
    """Key ranges (first_key to last_key, both in it) in which two copies differ, with their rows on both sides."""
    columns = sorted(set(source.columns) & set(copy.columns))
    trees = [HashTree(df, key, columns, **shape) for df in (source, copy)]
    leaf = trees[0].leaf
    found = trees[0].differing(trees[1])
    first = F.shiftleft("place", leaf)
    return found.select(first.alias("first_key"), (first + 2**leaf - 1).alias("last_key"), "source_count", "copied_count")


def copy_differences(source: DataFrame, copy: DataFrame, key: str, **shape) -> DataFrame:
    """Keys with another content (changed), or another number of rows, in the two copies: missing in the copy or extra in it.

    Only the rows of differing ranges are joined; equal ranges are read once, for their digests.
    """
    columns = sorted(set(source.columns) & set(copy.columns))
    shape = {"leaf": 10, **shape}
    ranges = written(differing_ranges(source, copy, key, **shape), "differing-ranges")

    def rows(df: DataFrame, name: str) -> DataFrame:
        plain = _comparable(df, columns)
        place = F.shiftleft(F.shiftright(F.col(key).cast("long"), shape["leaf"]), shape["leaf"])
        plain = plain.join(ranges.select("first_key"), place.eqNullSafe(F.col("first_key")), "left_semi")
        digest = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        return plain.groupBy(F.col(key).alias(f"{name}_key")).agg(F.count("*").alias(f"{name}_n"), digest.alias(f"{name}_digest"))

    s, c = rows(source, "s"), rows(copy, "c")
    met = s.join(c, F.col("s_key").eqNullSafe(F.col("c_key")), "full_outer")
    n, m = (F.coalesce(x, F.lit(0)) for x in ("s_n", "c_n"))
    kind = F.when(n > m, "missing").when(n < m, "extra").when(F.col("s_digest") != F.col("c_digest"), "changed")
    return met.select(F.coalesce("s_key", "c_key").alias(key), kind.alias("kind")).where("kind IS NOT NULL")


def catch_up(source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    """Source rows the copy does not have yet. Compared by key: ids are not issued in order, so none is a watermark."""
    return source.join(copy.select(key), key, "left_anti").select(*source.columns)


def conflicts(source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides with different content."""
    columns = [c for c in source.columns if c != key and c in copy.columns]
    s = _comparable(source, [key, *columns]).select(key, F.struct(*columns).alias("s"))
    c = _comparable(copy, [key, *columns]).select(key, F.struct(*columns).alias("c"))
    return s.join(c, key).where(~F.col("s").eqNullSafe(F.col("c"))).select(key)


def id_faults(df: DataFrame, key: str, below: int | None = NEW_IDS_FROM) -> DataFrame:
    """NULL, repeated or out-of-range ids with their number of rows."""
    bad = (F.col("row_cnt") != 1) | F.col(key).isNull()
    if below is not None:
        bad = bad | (F.col(key) >= below)
    return df.groupBy(key).agg(F.count("*").alias("row_cnt")).where(bad)


def rollback_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """The old table after a rollback: its rows and those only the new table has. Dimensions are replaced whole."""
    return old.unionByName(catch_up(new, old, key).select(*old.columns))
