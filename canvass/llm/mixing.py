"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks. DataFrame functions only.

1. Size of a row: its words. Sources in code-point order, NULL last, take the weights in turn; targets share `share`
   times all sizes, none above `most` times its source's size, the excess going to the others by weight.
2. Each source's rows are put in the order of a digest of their ids (a fixed shuffle) and cut into blocks of `block`
   words. Positions come from two levels of sums: within (source, bucket of the digest), and over a source's buckets.
3. Slot i of the schedule is the golden-ratio point frac(i * phi); the cumulative shares of the sources say whose it is.
   A source's k-th slot takes its block k, from the start again after the last block; the slot that reaches the target
   is cut there. The few slots that the points fall short of are appended, so that each target is met exactly.
4. Slots meet the rows' pieces on (source, block).

NULL and empty texts have size 0 and are never taken; their rows stay in the result. Equal rows are rows of their own.
NULL ids are one more id. Reruns agree whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Words of a block; slots that one window ranks.
BLOCK, RUN = 4096, 16384
#: 2**32 * (1 - 1/phi), for points modulo 2**32 without overflow.
GOLDEN, TURN = 1640531527, 2**32
#: Parts of the unit interval on which points meet the sources' shares.
CELLS = 4096


class Mix:
    def __init__(
        self,
        docs: DataFrame,
        weights: Sequence[int] = WEIGHTS,
        share: float = SHARE,
        most: int = MOST,
        block: int = BLOCK,
        seed: int = 0,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
    ):
        self.weights, self.share, self.most, self.block = tuple(weights), share, most, block
        text = F.col(f"`{text_col}`")
        key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
        sizes = docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{source_col}`").alias("name"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(text).alias("content"),
            F.md5(key).alias("key"),
        )
        self.sizes = written(sizes, "mix-sizes")
        self.sources = written(self._sources(), "mix-sources")
        self.rows = written(self._placed(), "mix-rows")
        self.slots = written(self._slots(), "mix-slots")

    def _sources(self) -> DataFrame:
        """One row per source: source (number), name, source_size, weight, target, goal, blocks, slots, from_slot."""
        all_rows = Window.orderBy(F.col("name").asc_nulls_last())
        cycle = F.array(*[F.lit(w) for w in self.weights])
        named = (
            self.sizes.groupBy("name")
            .agg(F.sum("size").alias("source_size"))
            .withColumn("source", F.row_number().over(all_rows) - 1)
            .withColumn("weight", F.element_at(cycle, (F.col("source") % len(self.weights)) + 1).cast("long"))
            .withColumn("cap", self.most * F.col("source_size"))
        )
        # sources reach their caps in the order of cap / weight; the level is what the weights get once all that do are out
        by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source")
        before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
        after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
        everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        budget = F.lit(float(self.share)) * F.sum("source_size").over(everything)
        level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
        levelled = named.withColumn("at", level).withColumn("level", F.max("at").over(everything))
        goal = F.floor(F.col("target") + 0.5)
        rest = F.col("goal") - F.col("epochs") * F.col("source_size")
        in_order = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
        return (
            levelled.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
            .withColumn("goal", goal)
            .withColumn("blocks", F.ceil(F.col("source_size") / self.block))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0))
            .withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(rest / self.block))
            .withColumn("from_slot", F.coalesce(F.sum("slots").over(in_order), F.lit(0)))
            .select("source", "name", "source_size", "weight", "target", "goal", "blocks", "slots", "from_slot")
        )

    def _placed(self) -> DataFrame:
        """Rows with the place of their first word in the shuffled source: start, and (bucket, nth) to tell rows apart."""
        names = self.sources.select("source", F.col("name").alias("known"))
        rows = self.sizes.join(names, F.col("name").eqNullSafe(F.col("known"))).drop("known", "name")
        rows = rows.withColumn("bucket", F.substring("key", 1, 3))
        totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
        buckets = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select("source", "bucket", F.coalesce(F.sum("held").over(buckets), F.lit(0)).alias("offset"))
        inside = Window.partitionBy("source", "bucket").orderBy("key", "size", "content")
        before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return (
            rows.withColumn("nth", F.row_number().over(inside))
            .withColumn("before", before)
            .join(totals, ["source", "bucket"])
            .select("id", "size", "content", "source", "bucket", "nth", (F.col("offset") + F.col("before")).alias("start"))
        )

    def _slots(self) -> DataFrame:
        """The schedule: slot (its rank), source, epoch, block, and the words of the source it takes: lo to hi."""
        spark, shares = self.sizes.sparkSession, self.sources.filter("slots > 0")
        many = self.sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
        edge = lambda at: F.floor(at / F.lit(float(max(many, 1))) * TURN)
        shares = shares.withColumn("lo", edge(F.col("from_slot"))).withColumn("hi", edge(F.col("from_slot") + F.col("slots")))
        cell = F.lit(TURN // CELLS)
        first, last = F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell)
        shares = shares.filter("hi > lo").select("source", "lo", "hi", F.explode(F.sequence(first, last)).alias("cell"))
        points = spark.range(many).select("id", F.pmod(F.pmod("id", F.lit(TURN)) * GOLDEN, F.lit(TURN)).alias("point"))
        points = points.withColumn("cell", F.floor(F.col("point") / cell)).join(shares, "cell").filter("point >= lo and point < hi")
        points = points.select(F.col("id").alias("slot"), "source", F.floor(F.col("id") / RUN).alias("run"))
        runs = points.groupBy("source", "run").agg(F.count(F.lit(1)).alias("held"))
        earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.select("source", "run", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset"))
        nth = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot"))
        ranked = points.withColumn("nth", nth).join(runs, ["source", "run"])
        ranked = ranked.select("source", "slot", (F.col("offset") + F.col("nth") - 1).alias("rank"))
        got = points.groupBy("source").agg(F.count(F.lit(1)).alias("got"))
        short = self.sources.join(got, "source", "left").withColumn("got", F.coalesce("got", F.lit(0)))
        short = short.filter("got < slots").select(
            "source", (F.col("from_slot") + many).alias("slot"), F.explode(F.sequence("got", F.col("slots") - 1)).alias("rank")
        )
        short = short.withColumn("slot", F.col("slot") + F.col("rank"))
        plan = self.sources.filter("slots > 0").select("source", "source_size", "goal", "blocks", "slots")
        slots = ranked.union(short).join(plan, "source").filter("rank < slots")
        slots = slots.withColumn("epoch", F.floor(F.col("rank") / F.col("blocks")))
        slots = slots.withColumn("block", F.col("rank") - F.col("epoch") * F.col("blocks"))
        slots = slots.withColumn("lo", F.col("block") * self.block)
        left = F.col("goal") - F.col("epoch") * F.col("source_size")
        return slots.select(
            "slot", "source", "epoch", "block", "lo", F.least(F.col("lo") + self.block, F.col("source_size"), left).alias("hi")
        )

    def pieces(self) -> DataFrame:
        """What each slot takes: slot, epoch, and of which row (source, bucket, nth, id) words first to last + 1."""
        full = self.rows.filter("size > 0")
        low, high = F.floor(F.col("start") / self.block), F.floor((F.col("start") + F.col("size") - 1) / self.block)
        cut = full.withColumn("block", F.explode(F.sequence(low, high)))
        met = cut.join(self.slots, ["source", "block"])
        end = F.col("start") + F.col("size")
        return (
            met.withColumn("first", F.greatest("start", "lo") - F.col("start"))
            .withColumn("last", F.least(end, "hi") - F.col("start"))
            .filter("last > first")
            .select("slot", "epoch", "source", "bucket", "nth", "id", "size", "content", "first", "last")
        )

    def result(self) -> DataFrame:
        """doc_id, size, source_size, target and taken of every row."""
        taken = self.pieces().groupBy("source", "bucket", "nth").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
        rows = self.rows.join(taken, ["source", "bucket", "nth"], "left")
        rows = rows.join(self.sources.select("source", "source_size", "target"), "source")
        return rows.select(
            F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each row the mix takes, repeats counted."""
    return Mix(docs, **options).result()


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix with the columns of `docs`: one row per row and epoch, cut to the words taken.

    A row taken whole keeps its text as it is; a row of which an epoch takes some words has those words, joined by
    one space. Rows the mix takes nothing of are gone.
    """
    mix = Mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    spans = (
        mix.pieces()
        .groupBy("source", "bucket", "nth", "id", "size", "content", "epoch")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy("source", "bucket", "nth", "id", "size", "content")
        .agg(F.array_sort(F.collect_list(F.struct("epoch", "first", "last"))).alias("spans"))
        .join(mix.sources.select("source", "name"), "source")
    )
    # equal rows: the k-th of them takes the k-th list of spans
    spans = spans.groupBy("id", "name", "size", "content").agg(F.array_sort(F.collect_list("spans")).alias("lists"))
    spans = spans.toDF("_id", "_name", "_size", "_content", "_lists")
    text, names = F.col(f"d.`{text_col}`"), docs.columns
    here = docs.alias("d").join(
        spans,
        F.col(f"d.`{id_col}`").cast("long").eqNullSafe(F.col("_id"))
        & F.col(f"d.`{source_col}`").eqNullSafe(F.col("_name"))
        & (F.xxhash64(text) == F.col("_content")),
    )
    nth = F.row_number().over(Window.partitionBy("_id", "_name", "_size", "_content").orderBy(F.lit(0)))
    here = here.select(*[F.col(f"d.`{c}`").alias(f"d{i}") for i, c in enumerate(names)], "_size", "_lists", nth.alias("_nth"))
    here = here.withColumn("_span", F.explode(F.get("_lists", F.col("_nth") - 1)))
    at = names.index(text_col)
    found = F.regexp_extract_all(F.col(f"d{at}"), F.lit(f"({WORD})"))
    first, last = F.col("_span.first"), F.col("_span.last")
    some = F.array_join(F.slice(found, (first + 1).cast("int"), (last - first).cast("int")), " ")
    cut = F.when((first == 0) & (last == F.col("_size")), F.col(f"d{at}")).otherwise(some)
    return here.select(*[(cut if i == at else F.col(f"d{i}")).alias(c) for i, c in enumerate(names)])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
  FROM sized GROUP BY source),
capped AS (
  SELECT *, CASE n % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM named),
levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, n
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lvl
  FROM capped),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), max(lvl) OVER () * weight) AS target FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE (goal // source_size) * size
            + greatest(0, least(start + size, goal % source_size) - start) END AS BIGINT) AS taken
FROM placed
"""
