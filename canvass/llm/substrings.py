"""Repeated word sequences: a De Bruijn graph whose edges are the k-word sequences of all texts.

An edge that stands in one place only is of no interest, so edges are thinned first: each k-word window has a lowest
short n-gram (its anchor), equal windows have equal anchors, and only windows whose anchor stands in a second place
are built as edges. Edges meet by their 64-bit hash and 24 bits of a second one; the first place of an edge is its source
coordinate. Repeated edges that follow each other in a text are compacted to one path, a span (start, length), and the
words that spans cover are removed. `Repeats.spans` also cuts paths where their source coordinates do not follow each
other, as a branch in the graph does.

Rows without text have no words. Rows that share an id count as one document: a window is removed if its sequence also
starts at a smaller (id, position). NULL ids come first and are one document too. Equal rows get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm import words
from canvass.llm.common import NO_ID, pieces, python_ready, written

#: Words of an anchor.
ANCHOR = 6
U = np.uint64
#: Bits of the second hash that travel with an edge.
CHECK = 24


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def _anchors(starts: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes, and the lowest in each window, its anchor (0 where a window leaves its row)."""
    g = words.grams(h, ANCHOR)
    low = words.sliding(g, k - ANCHOR + 1, np.minimum)
    return g, np.where(words.whole(starts, k), low, U(0))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _anchor_rows(k: int):
    """(anchor, id, known, spread) per row and distinct anchor; known: it stands twice in the row or the batch.

    One row of such an anchor goes on under it, for the other batches; the rest go by their row's id (spread).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                starts, flat = words.split(part.column(1))
                if len(flat) < k:
                    continue
                g, low = _anchors(starts, words.hashes(flat), k)
                around = np.concatenate((np.zeros(k - ANCHOR, U), low, np.zeros(k - ANCHOR, U)))
                at = np.flatnonzero(words.sliding(around, k - ANCHOR + 1, np.maximum)[: len(g)] == g)
                anchor, row = g[at], words.rows_of(starts)[at]
                order = np.lexsort((row, anchor))
                anchor, row = anchor[order], row[order]
                again = np.concatenate(([False], anchor[1:] == anchor[:-1]))
                known = again | np.concatenate((again[1:], [False]))
                new = ~again | np.concatenate(([True], row[1:] != row[:-1]))
                anchor, row, again, known = (x[new] for x in (anchor, row, again, known))
                order = np.argsort(row, kind="stable")
                anchor, row, again, known = (x[order] for x in (anchor, row, again, known))
                ids = np.asarray(part.column(0))[row]
                spread = words.mixed(ids.view(U)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(ids), pa.array(known), pa.array(spread, mask=~again)],
                    ["anchor", "id", "known", "spread"],
                )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: number of words, hash of the word sequence, SHA-256 of its words joined by a space."""
    for batch in batches:
        for part in pieces(batch, 1):
            starts, flat = words.split(part.column(1))
            n = np.diff(starts)
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), flat)
            joined = pc.binary_join(lists, " ").to_pylist()
            sha = [_sha(x) for x in joined]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(sha)], ["id", "n_words", "whole"]
            )


def _edge_rows(k: int, sources: bool):
    """Edges whose anchor is repeated: (edge, id, copy, place), and with `sources` (source_id, source_at).

    place is position * 2**25 + bits of a second hash * 2 + 1 if the edge stands earlier in the batch; such an edge goes by
    its row's id, with its earlier place as its source. So no edge has more rows than there are batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                starts, flat = words.split(part.column(1))
                if len(flat) < k:
                    continue
                h = words.hashes(flat)
                _, low = _anchors(starts, h, k)
                fits = np.zeros(len(low), bool)
                for r, found in enumerate(part.column(2)):
                    own = slice(starts[r], max(starts[r], starts[r + 1] - k + 1))
                    fits[own] = np.isin(low[own], np.asarray(found.values).view(U))
                at = np.flatnonzero(fits)
                if not len(at):
                    continue
                row = words.rows_of(starts)[at]
                check = (words.grams(words.hashes(flat, 1), k, 1)[at] >> U(64 - CHECK)).astype(np.int64)
                edge = words.grams(h, k)[at]
                ids, place = np.asarray(part.column(0))[row], at - starts[row]
                copy = np.asarray(part.column(3))[row]
                order = np.lexsort((place, ids, check, edge))
                e, c = edge[order], check[order]
                same = np.concatenate(([False], (e[1:] == e[:-1]) & (c[1:] == c[:-1])))
                source = np.empty(len(at), np.int64)
                source[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                # equal places of rows that share an id are one place
                later = (ids != ids[source]) | (place != place[source])
                spread = words.mixed(ids.view(U))
                columns = [
                    pa.array(np.where(later, spread, edge).view(np.int64)),
                    pa.array(ids),
                    pa.array(copy),
                    pa.array((place << CHECK + 1) | (check << 1) | later),
                ]
                names = ["edge", "id", "copy", "place"]
                if sources:
                    columns += [pa.array(ids[source], mask=~later), pa.array(place[source], mask=~later)]
                    names += ["source_id", "source_at"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, 1):
            starts, flat = words.split(part.column(1))
            out = []
            for r, spans in enumerate(part.column(2).to_pylist()):
                own = flat.slice(starts[r], starts[r + 1] - starts[r])
                gone = np.zeros(len(own), bool)
                for x in spans:
                    gone[x["start"] : x["start"] + x["length"]] = True
                kept = " ".join(own.filter(pa.array(~gone)).to_pylist())
                out.append((_sha(" ".join(own.to_pylist())), int(gone.sum()), _sha(kept), kept))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x) for x in zip(*out, strict=True))],
                ["id", "whole", "n_removed", "kept_sha256", "kept"],
            )


class Repeats:
    """The repeated k-word windows of a table, with their spans and what is left of each row."""

    def __init__(self, docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text"):
        python_ready(docs.sparkSession)
        self.k, self.docs = k, _plain(docs, id_col, text_col)
        self.digests = written(self.docs.mapInArrow(_digests, "id long, n_words long, whole string"), "substring-digests")
        long = self.digests.filter(F.col("n_words") >= k)
        first = long.groupBy("whole").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
        # rows whose whole text stands in an earlier row: every window of them starts earlier
        self.copies = written(
            long.join(first, "whole").filter("id > first").select("id", "whole").distinct(), "substring-copies"
        )
        anchors = self.docs.mapInArrow(_anchor_rows(k), "anchor long, id long, known boolean, spread long")
        here = Window.partitionBy(F.coalesce("spread", "anchor"))
        matched = (
            anchors.withColumn("rows", F.count(F.lit(1)).over(here))
            .filter("rows > 1 or known")
            .groupBy("id")
            .agg(F.collect_set("anchor").alias("anchors"))
        )
        # copies need no edges, as the sources of their windows are elsewhere; rows that share an id stay together
        alone = self.digests.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter("rows = 1")
        needed = matched.join(self.copies.join(alone, "id"), "id", "left_anti").join(
            alone.withColumnRenamed("rows", "single"), "id", "left"
        )
        # rows that share an id are told apart by their texts
        copy = F.when(F.col("single").isNull(), F.xxhash64("text")).otherwise(0)
        texts = self.docs.join(needed, "id").select("id", "text", "anchors", copy.alias("copy"))
        self.touched = written(texts, "substring-texts")

    def _rows(self, sources: bool) -> DataFrame:
        """Edges with their positions (at) and the first place of their key (source)."""
        schema = "edge long, id long, copy long, place long" + (", source_id long, source_at long" if sources else "")
        # dealt by the hash alone: what is derived from place needn't travel
        rows = self.touched.mapInArrow(_edge_rows(self.k, sources), schema).repartition("edge")
        check = F.shiftright("place", 1).bitwiseAND(F.lit(2**CHECK - 1))
        rows = rows.withColumn("at", F.shiftright("place", CHECK + 1)).withColumn("check", check)
        by = Window.partitionBy("edge", "check").orderBy("id", "at")
        return rows.withColumn("source", F.first(F.struct("id", "at")).over(by))

    def edges(self) -> DataFrame:
        """Windows that start earlier elsewhere: id, at, and an earlier place (source_id and source_at)."""
        source = [F.coalesce(f"source_{x}", f"source.{x}").alias(f"source_{x}") for x in ("id", "at")]
        return self._rows(True).select("id", "at", *source).filter("source_id != id or source_at != at").distinct()

    def spans(self) -> DataFrame:
        """Paths compacted: runs of windows whose positions and source coordinates advance together.

        id, start, length in words, source_id, source_start; whole copies are not listed here.
        """
        windows = self.edges().withColumn("shift", F.col("at") - F.col("source_at"))
        diagonal = Window.partitionBy("id", "source_id", "shift").orderBy("at")
        return (
            windows.withColumn("run", F.col("at") - F.row_number().over(diagonal))
            .groupBy("id", "source_id", "shift", "run")
            .agg(F.min("at").alias("start"), (F.max("at") - F.min("at") + self.k).alias("length"))
            .select("id", "start", "length", "source_id", (F.col("start") - F.col("shift")).alias("source_start"))
        )

    def paths(self) -> DataFrame:
        """Repeated edges compacted: id, copy, start and length in words of each run of windows to remove."""
        later = self._rows(False).filter("place % 2 = 1 or source.id != id or source.at != at")
        nth = F.dense_rank().over(Window.partitionBy("id", "copy").orderBy("at"))
        runs = later.select("id", "copy", "at").withColumn("run", F.col("at") - nth)
        length = (F.max("at") - F.min("at") + self.k).cast("long")
        return runs.groupBy("id", "copy", "run").agg(F.min("at").alias("start"), length.alias("length")).drop("run")

    def kept(self) -> DataFrame:
        """Rows with repeated windows: id, whole (digest of the row's words), n_removed, kept_sha256, kept (words left)."""
        spans = self.paths().groupBy("id", "copy").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
        texts = self.touched.join(spans, ["id", "copy"]).select("id", "text", "spans")
        return texts.mapInArrow(_results, "id long, whole string, n_removed long, kept_sha256 string, kept string")


def substring_dedup(docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256. Each k-word sequence is kept where it starts first."""
    found = Repeats(docs, k, id_col, text_col)
    changed = found.kept().select("id", "whole", "n_removed", "kept_sha256").distinct()
    copies = found.copies.withColumn("copy", F.lit(True))
    out = found.digests.join(copies, ["id", "whole"], "left").join(changed, ["id", "whole"], "left")
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(_sha(""))).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
