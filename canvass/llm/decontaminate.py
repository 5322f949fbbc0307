"""Benchmark items inside training texts: rare n-gram seeds find candidates, Smith-Waterman alignment scores them.

1. Seeds are n words in a row, or n words of which the halves are one word apart; both count as the same n words. So
   an edited copy has seeds wherever two pairs of words are next to each other or have one word between them: with
   every third word changed as well as with a word put in or left out after every third one. An item of fewer than n words
   has one seed, all its words in a row.
2. The documents that hold each seed are counted over all documents. Of the seeds that occur, the rarer half of an
   item's (at least KEPT) are its rare ones, whatever the counts are, so an item that is copied a million times is found all the
   same.
3. A text's n-grams are tested against a bitmap of the seeds (fixed size, so it can be sent to all tasks; a larger
   benchmark only makes it less selective), and those that pass meet the seeds by an ordinary join. A document and an
   item are a candidate if they share a rare seed or two seeds. A pair that shares one frequent seed and no other is none: it
   has no other two pairs of words that close, so it would need matches in runs of at most three words with two
   edits or more after each, which score 0.4 at most.
4. For each candidate, hits on near diagonals make a region of the text, and the local alignment
   of the item with the region is scored: match 2, mismatch and gap -1, divided by the score of an exact copy.

Words are compared in lower case, without punctuation around them. Rows and items without text match nothing. NULL ids
stay NULL. Equal rows are found once; rows that share an id but not the text are searched each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.llm import words
from canvass.llm.common import pieces, python_ready, written

U = np.uint64
N, KEPT, THRESHOLD = 4, 8, 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: The bitmap has 2 ** BITS bits.
BITS, CHUNK_BITS = 22, 17
AROUND = ".,;:!?\"'()[]{}<>*#$%&|-_…“”‘’«»"


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    starts, flat = words.split(pc.utf8_lower(pc.fill_null(texts, "")))
    return starts, words.hashes(pc.utf8_trim(flat, AROUND)) if len(flat) else np.zeros(0, U)


def _seeds(starts: np.ndarray, h: np.ndarray, n: int, short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds of all rows: n words, in a row or with one word between their halves; and, for the
    lengths in `short`, that many words in a row."""
    places, found = [], []
    half = n // 2
    left, right = words.grams(h, half), words.grams(h, n - half)
    for gap in (0, 1):
        at = np.flatnonzero(words.whole(starts, n + gap))
        places.append(at)
        found.append(words.mixed(left[at] * U(0xD6E8FEB86659FD93) + right[at + half + gap]))
    for k in short:
        at = np.flatnonzero(words.whole(starts, k))
        places.append(at)
        found.append(words.grams(h, k, 1)[at])
    return np.concatenate(places), np.concatenate(found)


def _seed_rows(n: int):
    """The seeds of items, with the length of those that are shorter than n words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 2):
                starts, h = _hashes(part.column(2))
                at, seed = _seeds(starts, h, n, tuple(range(1, n)))
                row, size = words.rows_of(starts)[at], np.diff(starts)
                # only whole short items are seeds of their own
                length = np.zeros(len(at), np.int64)
                done = len(at) - sum(int(words.whole(starts, k).sum()) for k in range(1, n))
                for k in range(1, n):
                    count = int(words.whole(starts, k).sum())
                    length[done : done + count] = k
                    done += count
                keep = (length == 0) | (length == size[row])
                at, seed, row, length = at[keep], seed[keep], row[keep], length[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        part.column(1).take(pa.array(row)),
                        pa.array(seed.view(np.int64)),
                        pa.array(at - starts[row]),
                        pa.array(length),
                    ],
                    ["item_id", "item", "seed", "item_at", "short"],
                )

    return run


def _slots(seeds: np.ndarray) -> np.ndarray:
    return (seeds >> U(64 - BITS)).astype(np.int64)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITS, np.uint8)
    for batch in batches:
        bits[_slots(np.asarray(batch.column(0)).view(U))] = 1
    if bits.any():
        for k, chunk in enumerate(bits.reshape(-1, 1 << CHUNK_BITS)):
            if chunk.any():
                at = np.flatnonzero(chunk).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at.tobytes()], pa.binary())], ["chunk", "at"])


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    maps: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            maps.setdefault(k, np.zeros(1 << CHUNK_BITS, bool))[np.frombuffer(blob, "<u4")] = True
    for k, chunk in maps.items():
        blob = np.packbits(chunk).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blob], pa.binary())], ["chunk", "bits"])


def bitmap(spark: SparkSession, seeds: DataFrame):
    """Broadcast bitmap of the seeds: 512 KB packed, whatever their number."""
    parts = seeds.select("seed").mapInArrow(_marks, "chunk int, at binary").repartition("chunk")
    out = np.zeros((1 << BITS - CHUNK_BITS, 1 << CHUNK_BITS - 3), np.uint8)
    for row in parts.mapInArrow(_union, "chunk int, bits binary").collect():
        out[row.chunk] = np.frombuffer(row.bits, np.uint8)
    return spark.sparkContext.broadcast(out.reshape(-1))


def _found(
    texts: pa.Array, n: int, short: tuple[int, ...], bits: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the rows, and row, seed and place of each n-gram that may be a seed, by row."""
    starts, h = _hashes(texts)
    at, seed = _seeds(starts, h, n, short)
    hit = bits[_slots(seed)]
    at, seed = at[hit], seed[hit]
    order = np.argsort(at, kind="stable")
    at, seed = at[order], seed[order]
    return starts, words.rows_of(starts)[at], seed, at


def _frequencies(n: int, short: tuple[int, ...], packed):
    """(seed, docs): documents per seed, counted in each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(packed.value).astype(bool)
        for batch in batches:
            for part in pieces(batch, 0):
                _, row, seed, _ = _found(part.column(0), n, short, bits)
                order = np.lexsort((row, seed))
                row, seed = row[order], seed[order]
                new = np.concatenate(([True], (seed[1:] != seed[:-1]) | (row[1:] != row[:-1])))[: len(seed)]
                seed, docs = np.unique(seed[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(docs.astype(np.int64))], ["seed", "docs"])

    return run


def _hit_rows(n: int, short: tuple[int, ...], packed, packed_rare):
    """Texts that may be candidates, with the seeds they may hold and their places: a rare seed, or two seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, rare = (np.unpackbits(x.value).astype(bool) for x in (packed, packed_rare))
        for batch in batches:
            for part in pieces(batch, 2):
                starts, row, seed, at = _found(part.column(2), n, short, bits)
                order = np.lexsort((seed, row))
                again = (seed[order][1:] == seed[order][:-1]) & (row[order][1:] == row[order][:-1])
                distinct = np.bincount(row, minlength=part.num_rows) - np.bincount(row[order][1:][again], minlength=part.num_rows)
                enough = (distinct > 1) | (np.bincount(row, rare[_slots(seed)], part.num_rows) > 0)
                row, seed, at = (x[enough[row]] for x in (row, seed, at))
                with_hits = np.unique(row)
                cuts = np.searchsorted(row, np.append(with_hits, part.num_rows)).astype(np.int32)
                some = part.take(pa.array(with_hits))
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (seed.view(np.int64), at - starts[row])]
                yield pa.RecordBatch.from_arrays([*some.columns, *lists], ["doc_id", "doc", "text", "seeds", "places"])

    return run


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Best local score of two word sequences, and where it ends in the region (exclusive)."""
    j = np.arange(1, len(region) + 1)
    above, best, end = np.zeros(len(region) + 1, np.int64), 0, 0
    for w in item:
        t = np.maximum(above[:-1] + np.where(region == w, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum.accumulate(np.maximum(t, 0) - GAP * j) + GAP * j
        if (k := int(row.argmax())) >= 0 and row[k] > best:
            best, end = int(row[k]), k + 1
        above[1:] = row
    return best, end


def best_alignment(item: np.ndarray, text: np.ndarray, diagonals: np.ndarray) -> tuple[float, int, int]:
    """(score from 0 to 1, first word, end) over the regions of the text around the hits' diagonals."""
    m, out = len(item), (0.0, 0, 0)
    diagonals = np.unique(diagonals)
    for near in np.split(diagonals, np.flatnonzero(np.diff(diagonals) > m) + 1):
        lo, hi = max(0, near[0] - m // 2), min(len(text), near[-1] + m + m // 2 + 1)
        score, end = align(item, text[lo:hi])
        if score / (MATCH * m) > out[0]:
            _, back = align(item[::-1], text[lo : lo + end][::-1])
            out = (score / (MATCH * m), int(lo + end - back), int(lo + end))
    return out


def _aligned(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                starts, h = _hashes(part.column(1))
                out = []
                for r, found in enumerate(part.column(2).to_pylist()):
                    text = h[starts[r] : starts[r + 1]]
                    item_starts, item_h = _hashes(pa.array([x["text"] for x in found], pa.string()))
                    for k, x in enumerate(found):
                        item = item_h[item_starts[k] : item_starts[k + 1]]
                        score, a, b = best_alignment(item, text, np.array(x["diagonals"], np.int64))
                        if score >= threshold:
                            out.append((part.column(0)[r].as_py(), part.column(3)[r].as_py(), x["item_id"], score, a, b))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                columns = zip(*out, strict=True) if out else [[]] * 6
                names = ["doc_id", "doc", "item_id", "score", "first_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)

    return run


def found_items(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = N,
    kept: int = KEPT,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """As `contamination`, with a hash of the document's text (doc)."""
    spark = docs.sparkSession
    python_ready(spark)
    item_text = F.col(f"`{item_text_col}`")
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("long").alias("item_id"), F.xxhash64(item_text).alias("item"), item_text.alias("text")
    ).filter("text is not null").dropDuplicates(["item_id", "item"])
    items = written(items, "benchmark-items")
    seeds = written(items.mapInArrow(_seed_rows(n), "item_id long, item long, seed long, item_at long, short long"), "benchmark-seeds")
    # lengths below n that some item has
    short = tuple(sorted(r.short for r in seeds.filter("short > 0").select("short").distinct().collect()))
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("doc"), text.alias("text"))
    counted = rows.select("text").mapInArrow(_frequencies(n, short, bitmap(spark, seeds)), "seed long, docs long")
    counted = counted.groupBy("seed").agg(F.sum("docs").alias("docs"))
    by_item = Window.partitionBy("item_id", "item")
    ranked = (
        seeds.join(counted, "seed")
        .withColumn("rank", F.row_number().over(by_item.orderBy("docs", "seed", "item_at")))
        .withColumn("half", F.ceil(F.count(F.lit(1)).over(by_item) / 2))
        .withColumn("rare", F.col("rank") <= F.greatest(F.lit(kept), F.col("half")))
    )
    present = written(ranked.select("item_id", "item", "seed", "item_at", "rare"), "benchmark-present")
    schema = "doc_id long, doc long, text string, seeds array<long>, places array<long>"
    maps = bitmap(spark, present), bitmap(spark, present.filter("rare"))
    hits = written(rows.mapInArrow(_hit_rows(n, short, *maps), schema), "benchmark-hits")
    pairs = (
        hits.select("doc_id", "doc", F.explode(F.arrays_zip("seeds", "places")).alias("hit"))
        .select("doc_id", "doc", F.col("hit.seeds").alias("seed"), (F.col("hit.places")).alias("at"))
        .join(present, "seed")
        .groupBy("doc_id", "doc", "item_id", "item")
        .agg(
            F.collect_set(F.col("at") - F.col("item_at")).alias("diagonals"),
            F.max("rare").alias("rare"),
            F.count_distinct("seed").alias("shared"),
        )
        .filter("rare or shared > 1")
    )
    found = items.withColumnRenamed("item_id", "known_id")
    pairs = pairs.join(found, (pairs.item_id.eqNullSafe(found.known_id)) & (pairs.item == found.item)).select(
        "doc_id", "doc", F.struct("item_id", found.text, "diagonals").alias("x")
    )
    pairs = pairs.groupBy("doc_id", "doc").agg(F.collect_list("x").alias("found")).toDF("of_id", "of", "found")
    met = hits.select("doc_id", "doc", "text").join(
        pairs, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("doc") == F.col("of"))
    )
    schema = "doc_id long, doc long, item_id long, score double, first_word long, end_word long"
    # equal rows give equal results
    return met.select("doc_id", "text", "found", "doc").mapInArrow(_aligned(threshold), schema).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, score, first_word and end_word of the best alignment."""
    return found_items(docs, benchmark, **options).drop("doc")


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that hold no item."""
    found = found_items(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    found = found.select(F.col("doc_id").alias("_id"), F.col("doc").alias("_doc")).distinct()
    own = F.col(f"d.`{id_col}`").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("_doc"))
    return docs.alias("d").join(found, own, "left_anti")
