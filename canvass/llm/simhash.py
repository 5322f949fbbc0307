"""Near-duplicate texts by SimHash: 64-bit fingerprints of word n-grams, linked within a Hamming radius, exactly.

1. Every text gets a fingerprint: a bit is 1 if it is set in more than half of its n-grams' XXH64 values (repeats count).
   Equal fingerprints are one node from here on.
2. Cut into k + radius blocks, two fingerprints within the radius agree in at least k blocks. Each choice of k blocks is a
   table keyed by their bits; k grows with the number of fingerprints, so that a key stays rare, and any k finds
   every link. Keys of one fingerprint go no further; a key of many is cut into blocks of rows that meet pairwise.
3. A task lays the fingerprints of its keys out as bit planes, 64 of them to a word, and compares each with the one d rows
   on: XOR of two planes gives 64 differences at once, carry-save adders count them in a few words, and words in which all
   counts have passed the radius are left. Pairs that are already connected are not compared; what
   comes out is a spanning forest of true links, so a group of near copies gives one link a member.
4. Components of the links give each text the smallest id it can reach.

Only A-Z are lower-cased; a word is a run of characters other than space and 9 to 13. Fewer than n words: the whole sequence
is the n-gram. NULL, empty and blank texts have fingerprint 0, linked like any other. NULL ids are never a component's id; a
component with no other has NULL. Repeated rows come out as often as they go in. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm import words
from canvass.llm.common import NO_ID, pieces, python_ready, written
from canvass.llm.components import components

U = np.uint64
FULL = U(2**64 - 1)
BITS = 64
SEED = 42
#: n-grams whose bits are counted at once.
STEP = 1 << 14
#: Fingerprints of one key that meet as one block.
BLOCK = 4096
#: Rows of keys in one Arrow batch; planes are laid out per batch.
ROWS = 20_000
#: Bit planes taken between two looks at which words are still open.
TURN = 8


def fingerprints(texts: pa.Array, n: int) -> np.ndarray:
    """The fingerprint of each text."""
    starts, flat = words.split(pc.ascii_lower(pc.fill_null(texts, "")))
    out = np.zeros(len(texts), U)
    if not len(flat):
        return out
    # all words joined by one space: an n-gram is a slice of this
    offsets = words.raw(flat)[0]
    first = offsets[:-1] - offsets[0] + np.arange(len(flat))
    end = first + np.diff(offsets)
    joined = b" ".join(flat.cast(pa.binary() if pa.types.is_string(flat.type) else pa.large_binary()).to_pylist())
    row = words.rows_of(starts)
    at = np.arange(len(flat))
    stop = np.minimum(at + n, starts[row + 1])
    keep = (at + n <= starts[row + 1]) | (at == starts[row])
    row, a, b = row[keep], first[keep], end[stop[keep] - 1]
    rows, counts = np.unique(row, return_counts=True)
    ends = np.cumsum(counts)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a.tolist(), b.tolist(), strict=True)], U)
    total = np.zeros((len(rows), BITS), np.int64)
    for low in range(0, len(hashes), STEP):
        high = min(low + STEP, len(hashes))
        r0, r1 = np.searchsorted(ends, [low, high - 1], "right")
        cuts = np.maximum(np.concatenate(([0], ends[r0:r1])) - low, 0)
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total[r0 : r1 + 1] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    more = np.packbits(2 * total > counts[:, None], axis=1, bitorder="little")
    out[rows] = more.view("<u8").reshape(-1)
    return out


def _digests(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                found = pa.array(fingerprints(part.column(1), n).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), found], ["id", "fp"])

    return run


def masks(k: int, radius: int) -> list[int]:
    """The bits of every choice of k out of k + radius blocks, as signed numbers."""
    edges = [BITS * i // (k + radius) for i in range(k + radius + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    full = [sum(choice) for choice in combinations(blocks, k)]
    return [m - 2**64 if m >= 2**63 else m for m in full]


def blocks_for(count: int, radius: int) -> int:
    """The least k whose keys outnumber the fingerprints. It decides the work alone, never which links are found."""
    k = 1
    while k < 5 and BITS * k // (k + radius) < max(count, 1).bit_length():
        k += 1
    return k


def planes(fp: np.ndarray) -> np.ndarray:
    """Bit planes, lowest bit first: 64 fingerprints a word, with a spare word at the end."""
    spare = -len(fp) % BITS + BITS
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = np.concatenate((bits, np.zeros((spare, BITS), np.uint8)))
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _save(a, b, c):
    """Carry-save adder: the sum and the carry of three words."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def within(stack: np.ndarray, d: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Of the wanted rows i, those whose fingerprint and that of row i + d differ in at most `radius` bits."""
    q, s = divmod(d, BITS)
    s = U(s)
    mask = np.packbits(np.concatenate((wanted, np.zeros(-len(wanted) % BITS, bool))), bitorder="little").view("<u8")
    at = np.flatnonzero(mask)
    # counters start so high that they overflow at radius + 1
    size = max(3, radius.bit_length())
    count = [np.full(len(at), FULL if (2**size - 1 - radius) >> i & 1 else U(0)) for i in range(size)]
    open_ = mask[at]
    for low in range(0, BITS, TURN):
        plane = stack[low : low + TURN]
        other = plane[:, at + q]
        if s:
            other = (other >> s) | (plane[:, np.minimum(at + q + 1, plane.shape[1] - 1)] << (U(BITS) - s))
        x = plane[:, at] ^ other
        for i in range(0, TURN, 4):
            count[0], two = _save(count[0], x[i], x[i + 1])
            count[0], also = _save(count[0], x[i + 2], x[i + 3])
            count[1], carry = _save(count[1], two, also)
            for level in range(2, size):
                count[level], carry = count[level] ^ carry, count[level] & carry
            open_ &= ~carry
        left = open_ != 0
        if not left.all():
            at, open_, count = at[left], open_[left], [c[left] for c in count]
            if not len(at):
                break
    bits = np.unpackbits(open_.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(bits)
    return at[word] * BITS + bit


def forest(fp: np.ndarray, run: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect the same fingerprints as all links within the runs do. Rows of a run follow each other;
    where a run holds two blocks, only pairs of different blocks meet."""
    sizes = np.unique(run, return_counts=True)[1]
    length = np.repeat(sizes, sizes)
    first = np.cumsum(sizes) - sizes
    cross = np.repeat(np.maximum.reduceat(block, first) != np.minimum.reduceat(block, first), sizes)
    label = np.arange(len(fp))
    found: list[tuple[int, int]] = []
    rows, stack, d = label, None, 1
    while len(rows):
        if stack is None or d & (d - 1) == 0:
            rows = np.flatnonzero(length > d)
            if not len(rows):
                break
            stack = planes(fp[rows])
        x, y = rows[:-d], rows[d:]
        wanted = (run[x] == run[y]) & (label[x] != label[y]) & (~cross[x] | (block[x] != block[y]))
        hits = within(stack, d, wanted, radius) if wanted.any() else rows[:0]
        for i, j in zip(x[hits].tolist(), y[hits].tolist(), strict=True):
            a, b = i, j
            while label[a] != a:
                a = label[a]
            while label[b] != b:
                b = label[b]
            if a != b:
                label[max(a, b)] = min(a, b)
                found.append((i, j))
        if len(hits):
            while not np.array_equal(up := label[label], label):
                label = up
        d += 1
        if d >= len(rows):
            break
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


def _forests(radius: int):
    """Links of streams sorted by key; a key's rows may span Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, fp: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
            change = np.concatenate(([False], (keys[1:] != keys[:-1]).any(axis=1)))
            a, b = forest(fp, np.cumsum(change), block, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.int64)
            got = got if held is None else np.concatenate((held, got))
            earlier = np.flatnonzero((got[:, :4] != got[-1, :4]).any(axis=1))
            last = int(earlier[-1]) + 1 if len(earlier) else 0
            if last:
                yield links(got[:last, :4], got[:last, 5].copy().view(U), got[:last, 4])
            held = got[last:]
        if held is not None:
            yield links(held[:, :4], held[:, 5].copy().view(U), held[:, 4])

    return run


def near_links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b: long) that connect what all pairs of the distinct fingerprints `fp` within the radius connect."""
    spark = nodes.sparkSession
    choice = enumerate(masks(blocks_for(nodes.count(), radius), radius))
    tables = [F.struct(F.lit(i).cast("long").alias("t"), F.lit(m).cast("long").alias("mask")) for i, m in choice]
    rows = nodes.select("fp", F.explode(F.array(*tables)).alias("m"))
    rows = rows.select(F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("bits"), "fp")
    several = rows.groupBy("t", "bits").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    rows = rows.join(several.withColumn("blocks", F.ceil(F.col("held") / BLOCK)), ["t", "bits"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("fp"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    rows = rows.select("t", "bits", lo, hi, "block", "fp").repartition("t", "bits", "lo", "hi")
    python_ready(spark, ROWS)
    return rows.sortWithinPartitions("t", "bits", "lo", "hi", "fp").mapInArrow(_forests(radius), "a long, b long")


class SimHash:
    """Fingerprints, links and components of a table."""

    def __init__(self, docs: DataFrame, n: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"):
        python_ready(docs.sparkSession)
        rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text_col}`"))
        self.digests = written(rows.mapInArrow(_digests(n), "id long, fp long"), "simhash-digests")
        own = F.when(F.col("id") != NO_ID, F.col("id"))
        self.nodes = written(self.digests.groupBy("fp").agg(F.min(own).alias("least")), "simhash-nodes")
        self.links = written(near_links(self.nodes.select("fp"), radius), "simhash-links")
        self.components = components(self.links)

    def result(self) -> DataFrame:
        """id, fp (long) and component_id of every row."""
        roots = self.nodes.join(self.components.withColumnRenamed("node", "fp"), "fp", "left")
        roots = roots.select("fp", "least", F.coalesce("root", "fp").alias("root"))
        least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
        by_node = roots.join(least, "root").select("fp", "component_id")
        own = F.when(F.col("id") != NO_ID, F.col("id"))
        return self.digests.join(by_node, "fp").select(own.alias("id"), "fp", "component_id")


def simhash_components(docs: DataFrame, n: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id links lead to, its own included)."""
    found = SimHash(docs, n, radius, id_col, text_col).result()
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")
