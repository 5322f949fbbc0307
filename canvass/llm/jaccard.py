"""Joining rows whose sets of word n-grams are nearly equal (Jaccard similarity), by their rare n-grams.

1. Rows with equal sets become one class. How many rows hold an n-gram is counted over all rows, in a table of counters
   of fixed size; n-grams are ordered by that count, rare ones first.
2. Two sets with enough in common share an n-gram among the first n - ceil(t * n) + 1 of each. Classes meet in the
   buckets of these prefix n-grams; the length filter and the positional filter drop most meetings.
3. In every bucket the class in which the n-gram comes earliest is the centre. Each class is verified against the centre
   it shares most prefix n-grams with; the verified links give components.
4. Buckets that still hold several components are joined in full: every pair from different components that passes the
   filters is verified, once. Pairs within a component can't change it, so groups of copies are not expanded.

Verification reads the texts of both classes: the suffix filter (sizes of the parts of both sets between fixed pivots
bound what they can share), then the exact count. Large buckets are cut into blocks that meet pairwise.

Only A-Z are lower-cased. Rows without words have an empty set and no links; a set of fewer than n words is the whole
sequence. NULL ids never are a component's id. Equal rows are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.llm import words
from canvass.llm.common import NO_ID, merged_counts, pieces, python_ready, written
from canvass.llm.components import components

U = np.uint64
#: Counters of n-grams: 2 ** SLOT_BITS, sent around in chunks of 2 ** CHUNK_BITS.
SLOT_BITS, CHUNK_BITS = 18, 14
#: Rows of a bucket that meet as one block.
BLOCK = 2000
#: Pivots of the suffix filter, as bits of the hash.
PIVOT_BITS = 6


def sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    starts, flat = words.split(pc.ascii_lower(pc.fill_null(texts, "")))
    h = words.hashes(flat)
    g = words.grams(h, n)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(g[a : b - n + 1]))
        else:
            out.append(words.grams(h[a:b], b - a) if b > a else g[:0])
    return out


def signature(found: np.ndarray) -> int:
    """One number for a set; equal sets have equal numbers."""
    total = int(words.mixed(found).sum(dtype=U)) + len(found) * 0x9E3779B97F4A7C15
    return int(words.mixed(np.array([total % 2**64], U)).view(np.int64)[0])


def _digest_rows(n: int):
    """A row (id, n_shingles, sig, content) per text; at a task's end, its counters, in rows (chunk, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        names = ["id", "n_shingles", "sig", "content", "chunk", "counts"]
        for batch in batches:
            for part in pieces(batch, 1):
                found = sets(part.column(1), n)
                sizes = [len(x) for x in found]
                slots = np.concatenate(found) >> U(64 - SLOT_BITS)
                total += np.bincount(slots.astype(np.int64), minlength=1 << SLOT_BITS)
                no = pa.nulls(len(found), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(map(signature, found), pa.int64()),
                        part.column(2),
                        no,
                        pa.nulls(len(found), pa.binary()),
                    ],
                    names,
                )
        if total.any():
            chunks = np.minimum(total, 2**32 - 1).astype("<u4").reshape(-1, 1 << CHUNK_BITS)
            no = pa.nulls(len(chunks), pa.int64())
            blobs = pa.array([x.tobytes() for x in chunks], pa.binary())
            yield pa.RecordBatch.from_arrays([no, no, no, no, pa.array(range(len(chunks)), pa.int32()), blobs], names)

    return run


def _counters(spark: SparkSession, parts: DataFrame) -> np.ndarray:
    """The merged counters: 1 MB, whatever the input."""
    out = np.zeros((1 << SLOT_BITS - CHUNK_BITS, 1 << CHUNK_BITS), np.uint32)
    for row in merged_counts(parts, "chunk", "counts").collect():
        out[row.chunk] = np.frombuffer(row.counts, "<u4")
    return out.reshape(-1)


def _possible(na, pa_, nb, pb, percent: int):
    """Length and positional filter: what a pair can share if it meets first at these places of the two orders."""
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return 100 * most >= percent * (na + nb - most)


def _prefix_rows(n: int, percent: int, counts):
    """(token, sig, n, pos, known, spread, centre) per prefix n-gram of the classes of a batch.

    Where a batch holds a token more than once, the first of its classes is the local centre and goes on under the
    token; the others are known to be in a shared bucket, get a key of their own (spread) and name the local centre.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = counts.value
        for batch in batches:
            for part in pieces(batch, 1):
                # a set too small for one more n-gram to be within the threshold is only like its equals
                classes = {signature(x): x for x in sets(part.column(1), n) if 100 * len(x) >= percent * (len(x) + 1)}
                tokens, sigs, sizes, places = [], [], [], []
                for sig, found in classes.items():
                    size = len(found)
                    length = size + percent * size // -100 + 1
                    order = np.lexsort((found, counters[(found >> U(64 - SLOT_BITS)).astype(np.int64)]))[:length]
                    tokens.append(found[order])
                    sigs.append(np.full(length, sig, np.int64))
                    sizes.append(np.full(length, size, np.int64))
                    places.append(np.arange(length))
                if not tokens:
                    continue
                token, sig, size, place = (np.concatenate(x) for x in (tokens, sigs, sizes, places))
                order = np.lexsort((sig, place, token))
                token, sig, size, place = (x[order] for x in (token, sig, size, place))
                later = np.concatenate(([False], token[1:] == token[:-1]))
                known = later | np.concatenate((later[1:], [False]))
                first = np.maximum.accumulate(np.where(later, 0, np.arange(len(token))))
                fits = later & _possible(size, place, size[first], place[first], percent)
                spread = words.mixed(token ^ words.mixed(sig.view(U)))
                null = pa.scalar(None, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token.view(np.int64)),
                        pa.array(sig),
                        pa.array(size),
                        pa.array(place),
                        pa.array(known),
                        pc.if_else(pa.array(later), pa.array(spread.view(np.int64)), null),
                        pc.if_else(pa.array(fits), pa.array(sig[first]), null),
                    ],
                    ["token", "sig", "n", "pos", "known", "spread", "centre"],
                )

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Suffix filter, then the exact test; x and y sorted and distinct."""
    need = -(-percent * (len(x) + len(y)) // (100 + percent))
    differ = len(x) + len(y) - 2 * need
    parts = [np.bincount((v >> U(64 - PIVOT_BITS)).astype(np.int64), minlength=1 << PIVOT_BITS) for v in (x, y)]
    if differ < 0 or np.abs(parts[0] - parts[1]).sum() > differ:
        return False
    both = np.concatenate((x, y))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _verified(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 2, 4 << 20):
                pairs = zip(sets(part.column(2), n), sets(part.column(3), n), strict=True)
                yield part.select(["a", "b"]).filter(pa.array([similar(x, y, percent) for x, y in pairs], pa.bool_()))

    return run


def _own_texts(n: int):
    """(sig, text) of the rows whose text has the wanted signature; rows that share an id may have other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                own = pa.array([signature(x) for x in sets(part.column(1), n)], pa.int64())
                yield part.select(["sig", "text"]).filter(pc.equal(own, part.column(0)))

    return run


class NearCopies:
    """Classes, verified links and components of a table."""

    def __init__(self, docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"):
        spark = docs.sparkSession
        python_ready(spark)
        self.n, self.percent = n, percent
        self.docs = docs.select(
            F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        )
        schema = "id long, n_shingles long, sig long, content long, chunk int, counts binary"
        found = self.docs.withColumn("content", F.xxhash64("text")).mapInArrow(_digest_rows(n), schema)
        found = written(found, "jaccard-digests")
        self.digests = found.filter("chunk is null").select("id", "n_shingles", "sig", "content")
        self.classes = self.digests.filter("n_shingles > 0").groupBy("sig").agg(
            F.min("id").alias("id"), F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("least")
        )
        self.counts = spark.sparkContext.broadcast(_counters(spark, found.filter("chunk is not null")))
        self.buckets = self._buckets()
        wanted = self.buckets.select("sig").distinct().join(self.classes, "sig").select("sig", "id")
        self.texts = written(
            self.docs.join(wanted, "id").select("sig", "text").mapInArrow(_own_texts(n), "sig long, text string"),
            "jaccard-texts",
        )
        self.links = self._links()
        self.components = components(self.links)

    def _buckets(self) -> DataFrame:
        schema = "token long, sig long, n long, pos long, known boolean, spread long, centre long"
        rows = self.docs.mapInArrow(_prefix_rows(self.n, self.percent, self.counts), schema)
        key = Window.partitionBy("key")
        rows = rows.withColumn("key", F.coalesce("spread", "token"))
        rows = rows.withColumn("first", F.first(F.struct("sig", "n", "pos")).over(key.orderBy("pos", "sig")))
        rows = rows.withColumn("low", F.min("sig").over(key)).withColumn("high", F.max("sig").over(key))
        rows = rows.filter("known or low != high")
        most = F.least(F.col("n") - F.col("pos"), F.col("first.n") - F.col("first.pos"))
        fits = 100 * most >= self.percent * (F.col("n") + F.col("first.n") - most)
        centre = F.when(fits & (F.col("first.sig") != F.col("sig")), F.col("first.sig"))
        return written(
            rows.select("token", "sig", "n", "pos", F.coalesce("centre", centre).alias("centre")), "jaccard-buckets"
        )

    def _verify(self, pairs: DataFrame) -> DataFrame:
        a = self.texts.toDF("a", "text_a")
        b = self.texts.toDF("b", "text_b")
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
        return written(both.mapInArrow(_verified(self.n, self.percent), "a long, b long"), "jaccard-links")

    def _links(self) -> DataFrame:
        best = (
            self.buckets.filter("centre is not null")
            .groupBy("sig", "centre")
            .agg(F.count(F.lit(1)).alias("shared"))
            .groupBy("sig")
            .agg(F.max(F.struct("shared", "centre")).alias("best"))
        )
        stars = best.select(F.col("sig").alias("a"), F.col("best.centre").alias("b"))
        links = self._verify(stars)
        # star pairs that were no links would be met again
        tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = self._open_pairs(components(links)).join(tried, ["a", "b"], "left_anti")
        return links.union(self._verify(rest))

    def _open_pairs(self, parts: DataFrame) -> DataFrame:
        """Pairs from different components that share a prefix n-gram and pass the filters; each pair once."""
        rows = (
            self.buckets.drop("centre")
            .distinct()
            .join(parts.withColumnRenamed("node", "sig"), "sig", "left")
            .withColumn("root", F.coalesce("root", "sig"))
        )
        rows = written(rows, "jaccard-rows")
        counts = rows.groupBy("token").agg(
            F.count(F.lit(1)).alias("held"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        open_ = counts.filter("low < high").select("token", F.ceil(F.col("held") / BLOCK).alias("blocks"))
        rows = rows.join(open_, "token").withColumn("block", F.pmod(F.xxhash64("sig"), "blocks"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = rows.select(
            "token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "sig", "n", "pos", "root"
        )
        x, y = rows.alias("x"), rows.alias("y")
        most = F.expr("least(x.n - x.pos, y.n - y.pos)")
        meets = (
            F.expr("x.token = y.token and x.lo = y.lo and x.hi = y.hi and x.sig < y.sig and x.root != y.root")
            & F.expr("x.block != y.block or x.lo = x.hi")
            & (100 * most >= self.percent * (F.col("x.n") + F.col("y.n") - most))
        )
        return x.join(y, meets).select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct()

    def _roots(self) -> DataFrame:
        """The component of each class: sig, root, and the class's least id other than NULL."""
        found = self.classes.join(self.components.withColumnRenamed("node", "sig"), "sig", "left")
        return found.select("sig", "least", F.coalesce("root", "sig").alias("root"))

    def result(self) -> DataFrame:
        """id, n_shingles and component_id of every row."""
        roots = self._roots()
        least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
        by_class = roots.join(least, "root").select("sig", "component_id")
        own = F.when(F.col("id") != NO_ID, F.col("id"))
        known = self.digests.filter("n_shingles > 0").join(by_class, "sig")
        alone = self.digests.filter("n_shingles = 0").withColumn("component_id", own)
        columns = [own.alias("id"), F.col("n_shingles"), F.col("component_id")]
        return known.select(*columns).union(alone.select(*columns))

    def kept(self) -> DataFrame:
        """The row of each component that stays (id, content), the one of the least id; and all rows without words."""
        rows = self.digests.filter("n_shingles > 0").join(self._roots(), "sig")
        first = F.min(F.struct(F.col("id") == NO_ID, F.col("id"), F.col("content"))).alias("first")
        one = rows.groupBy("root").agg(first).select("first.id", "first.content", F.lit(True).alias("once"))
        rest = self.digests.filter("n_shingles = 0").select("id", "content", F.lit(False)).distinct()
        return one.union(rest)


def jaccard_components(
    docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id that links lead to, its own included)."""
    return NearCopies(docs, n, percent, id_col, text_col).result().withColumnRenamed("id", "doc_id")


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with the columns of `docs`; rows without words all stay."""
    kept = NearCopies(docs, n, percent, id_col, text_col).kept().toDF("_id", "_content", "_once")
    own_id = F.coalesce(F.col(f"d.`{id_col}`").cast("long"), F.lit(NO_ID))
    content = F.xxhash64(F.coalesce(F.col(f"d.`{text_col}`"), F.lit("")))
    met = docs.alias("d").join(kept, (own_id == F.col("_id")) & (content == F.col("_content")))
    nth = F.row_number().over(Window.partitionBy("_id", "_content").orderBy(F.lit(0)))
    columns = [F.col(f"d.`{c}`").alias(f"d{i}") for i, c in enumerate(docs.columns)]
    met = met.select(*columns, "_once", nth.alias("_nth")).filter("_nth = 1 or not _once")
    return met.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns)])
