"""Labelled rows for the classifiers: a bounded, balanced sample of those that may be learnt from."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text has remainder 1 modulo 3. False for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: tuple[int, int], id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """(_id, text, label) of at most rows[c] rows of class c, the same ones whatever the partitions, and the log odds.

    The log odds are those of class 1 among all rows that may be learnt from. The sample has at most sum(rows) ids, so it
    is sent to the scan of the documents. Labels other than 0 and 1, NULL ids and ids without a document are left out.
    """
    key, kind = F.col(f"`{id_col}`").cast("long"), F.col(f"`{label}`").cast("int")
    known = labels.select(key.alias("_id"), kind.alias("label")).filter("_id is not null and label in (0, 1)").distinct()
    known = known.filter(~held_out(F.col("_id")))
    counts = dict(known.groupBy("label").count().collect())
    order = [F.xxhash64(F.lit(label), F.col("_id")), F.col("_id")]
    some = [known.filter(F.col("label") == c).orderBy(*order).limit(rows[c]) for c in (0, 1)]
    text = docs.select(key.alias("_id"), F.col(f"`{text_col}`").alias("text"))
    found = text.join(F.broadcast(some[0].union(some[1])), "_id").select("_id", "text", "label")
    return found, math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
