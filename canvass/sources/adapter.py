"""Survey tables derived from all rows of the star-schema test tables, at any scale factor.

An order is a submission, its priority the poll, its customer the device; status, return flags, the brand of its
first part, a numeric rating and a channel are the answers. The answers are written to a JSON document and go
through the same parsing as real submissions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.measures import timestamp_text
from canvass.functions.text import path_depth, path_levels
from canvass.session import written
from canvass.sources import responses as source


CHANNELS = ("Web", "Store", "Phone")


def device(number: Column) -> Column:
    return F.concat(F.lit("dev_"), number.cast("string"))


def device_hash(number: Column) -> Column:
    return F.sha2(device(number), 256)


@dataclass
class Survey:
    spark: SparkSession
    folder: str

    _sessions: ClassVar[dict] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Survey:
        """The survey of a folder, staged once per application: submissions and dimensions are written tables."""
        return cls._sessions.setdefault((spark.sparkContext.applicationId, folder), cls(spark, folder))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """A table for work that is heavy per row: dealt out by its key, as the given files are few and large. With a
        number, as adaptive execution would put so little data back into one task."""
        tasks = max(self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self.table(name).repartition(tasks, key)

    @cached_property
    def base(self) -> DataFrame:
        """One row per order with the values that its document and the dimensions are made of."""
        lines = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_set("l_returnflag")).alias("flags"), F.min("l_partkey").alias("p_partkey"))
        )
        notes = lines.join(self.table("part").select("p_partkey", "p_brand"), "p_partkey", "left")
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        return (
            self.table("orders")
            .join(notes, F.col("l_orderkey") == key, "left")
            .select(
                key.alias("ingestion_id"),
                F.concat(F.lit("poll_"), F.substring("o_orderpriority", 1, 1)).alias("poll_id"),
                F.when(key % 50 == 1, F.lit(""))
                .when(key % 50 != 0, device(customer))
                .alias("device_id"),
                F.when(customer % 10 < 2, device_hash(customer))
                .when(customer % 10 == 2, F.concat(F.lit("  "), F.upper(device_hash(customer)), F.lit(" ")))
                .when(customer % 10 == 3, F.lit("garbage"))
                .otherwise(F.lit(""))
                .alias("external_id"),
                F.when(customer % 3 == 0, F.concat(F.lit("Market "), (customer % 5).cast("string")))
                .otherwise(F.lit(""))
                .alias("market_name"),
                (
                    F.lit("2024-01-02").cast("timestamp_ntz")
                    + F.make_dt_interval(days=(key % 28).cast("int"), secs=(key % 86400).cast("decimal(18,6)"))
                ).alias("submitted"),
                F.col("o_orderstatus").alias("status"),
                "flags",
                F.when(key % 7 == 0, F.lit("   "))
                .otherwise(F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")))
                .alias("typed"),
                "p_brand",
                customer.alias("customer"),
            )
        )

    @cached_property
    def raw(self) -> DataFrame:
        """(ingestion_id, raw): the submission documents."""
        key = F.col("ingestion_id")

        def answer(question: str, value: Column, kind: str, write_in: Column | None = None) -> Column:
            written = F.lit(None).cast("boolean") if write_in is None else F.when(write_in, F.lit(True))
            entry = F.struct(
                F.lit(question).alias("question"), value.alias("answer"), F.lit(kind).alias("type"), written.alias("write_in")
            )
            # as text at once: one list of answers of all types needs each of them as a VARIANT first
            return F.to_json(entry)

        status = answer("status", F.col("status"), "single")
        flags = answer("flags", F.col("flags"), "multi")
        channel = F.col("customer") % 4
        rest = [
            answer("note", F.col("typed"), "text"),
            answer("rating", key % 5, "rating"),
            answer(
                "channel",
                F.when(channel == 3, F.concat(F.lit("Other "), (F.col("customer") % 7).cast("string"))).otherwise(
                    F.element_at(F.array(*[F.lit(v) for v in CHANNELS]), (channel % 3 + 1).cast("int"))
                ),
                "single",
                channel == 3,
            ),
        ]
        listed = F.when(key % 3 == 0, F.concat_ws(",", flags, status, *rest)).otherwise(
            F.concat_ws(",", status, flags, *rest)
        )
        submitted = F.concat(F.translate(timestamp_text(F.col("submitted")), " ", "T"), F.lit("Z"))
        head = F.to_json(
            F.struct("poll_id", "device_id", "external_id", "market_name", submitted.alias("submitted_at"))
        )
        fields = F.nullif(F.substr(head, F.lit(2), F.length(head) - 2), F.lit(""))
        answers = F.concat(F.lit('"answers":['), listed, F.lit("]"))
        return self.base.select(
            "ingestion_id", F.concat(F.lit("{"), F.concat_ws(",", fields, answers), F.lit("}")).alias("raw")
        )

    @cached_property
    def landed(self) -> DataFrame:
        return written(self.raw, "landed")

    @cached_property
    def responses(self) -> DataFrame:
        return written(source.stage(self.landed).drop("raw"), "responses")

    @cached_property
    def options(self) -> DataFrame:
        return written(self._options(), "options")

    @cached_property
    def questions(self) -> DataFrame:
        return written(self._questions(), "questions")

    @cached_property
    def taxonomy(self) -> DataFrame:
        return written(self._taxonomy(), "taxonomy")

    def _options(self) -> DataFrame:
        """Distinct values per poll and question. Ids follow from the values, so no global numbering is needed."""

        def entry(question: str, value: Column, source_: str, number: Column, code: int) -> Column:
            return F.struct(
                F.lit(question).alias("question_key"),
                value.alias("option_value"),
                F.lit(source_).alias("option_source"),
                number.cast("long").alias("ordinal"),
                F.lit(code).cast("long").alias("code"),
            )

        def place(value: Column, listed: str) -> Column:
            return F.instr(F.lit(listed), value)

        brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("long")
        entries = F.concat(
            F.array(entry("status", F.col("status"), "catalog", place(F.col("status"), "FOP"), 1)),
            F.transform(
                F.coalesce("flags", F.array().cast("array<string>")),
                lambda flag: entry("flags", flag, "catalog", place(flag, "ANR"), 2),
            ),
            F.filter(
                F.array(entry("note", F.lower(F.trim("typed")), "response", brand, 3)),
                lambda e: e["option_value"] != "",
            ),
            F.array(*[entry("channel", F.lit(v), "catalog", F.lit(i), 4) for i, v in enumerate(CHANNELS, 1)]),
        )
        distinct = self.base.select("poll_id", F.explode(entries).alias("e")).select("poll_id", "e.*").distinct()
        question, value = F.col("question_key"), F.col("option_value")
        catalog = F.col("option_source") == "catalog"
        return distinct.select(
            self._option_id(F.col("poll_id"), F.col("code"), F.col("ordinal")).alias("option_id"),
            "poll_id",
            "question_key",
            "option_value",
            "option_source",
            F.when(question == "status", F.concat(F.lit("Label "), value)).alias("option_label"),
            F.when(question == "channel", F.concat(F.lit("via "), value)).alias("option_description"),
            ((question == "flags") & (value == "R")).alias("is_catch_all"),
            F.when(catalog, F.col("ordinal") - 1).alias("sort_order"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"),
        )

    @staticmethod
    def _option_id(poll_id: Column, code: Column, ordinal: Column) -> Column:
        return F.substring(poll_id, 6, 1).cast("long") * 100000 + code * 10000 + ordinal

    def _questions(self) -> DataFrame:
        def entry(key: str, kind: str, text: str | None, required: bool, least: int | None) -> Column:
            return F.struct(
                F.lit(key).alias("question_key"),
                F.lit(kind).alias("question_type"),
                F.lit(text).cast("string").alias("question_text"),
                F.lit(required).alias("is_required"),
                F.lit(least).cast("long").alias("min_select"),
            )

        entries = F.array(
            entry("status", "single", "Order status?", True, None),
            entry("flags", "multi", None, True, 2),
            entry("note", "text", "Brand note?", False, None),
            entry("rating", "rating", "How was it?", False, None),
            entry("channel", "single", "Which channel?", False, None),
        )
        polls = self.table("orders").select(
            F.concat(F.lit("poll_"), F.substring("o_orderpriority", 1, 1)).alias("poll_id")
        )
        return polls.distinct().select("poll_id", F.explode(entries).alias("e")).select("poll_id", "e.*")

    def _taxonomy(self) -> DataFrame:
        """Rules of every poll but poll_4, which is not classified yet. Option A of `flags` has two ordered rules."""
        poll, question, value = F.col("poll_id"), F.col("question_key"), F.col("option_value")
        no_text, no_rule = F.lit(None).cast("string"), F.lit(None).cast("array<bigint>")

        def rule(bucket: str, path: Column, key: Column, val: Column, kind: Column, confidence: float, needs: Column):
            return F.struct(
                F.lit(bucket).alias("bucket"),
                path.alias("taxonomy_path"),
                key.alias("demographic_key"),
                val.alias("demographic_value"),
                kind.alias("demographic_type"),
                F.lit(confidence).alias("confidence"),
                needs.alias("condition_sequence"),
            )

        first = self._option_id(poll, F.lit(1), F.lit(1))
        second = self._option_id(poll, F.lit(2), F.lit(2))

        def path(text: str, needs: Column = no_rule, confidence: float = 0.75) -> Column:
            name = F.lit(text) if needs is not no_rule else F.concat(F.lit(text), value)
            return rule("consumption", name, no_text, no_text, no_text, confidence, needs)

        plain = path("Returns|")
        ordered = [
            path("Returns|A|After F", F.array(first), 1.0),
            path("Returns|A|After F then N", F.array(first, second), 1.0),
        ]
        status = rule("preference", F.concat(F.lit("Orders|Status|"), value), no_text, no_text, no_text, 0.9, no_rule)
        rules = (
            F.when(
                question == "status",
                F.array(status),
            )
            .when((question == "flags") & (value == "A"), F.array(plain, *ordered))
            .when(question == "flags", F.array(plain))
            .when(
                question == "note",
                F.array(rule("demographic", no_text, F.lit("brand"), value, F.lit("STRING"), 0.6, no_rule)),
            )
        )
        rows = self.options.where(poll != "poll_4").select("option_id", poll, F.explode(rules).alias("r"))
        levels = F.col("r.taxonomy_path")
        return rows.select(
            "option_id",
            "r.bucket",
            "r.taxonomy_path",
            path_depth(levels).alias("taxonomy_depth"),
            path_levels(levels).alias("taxonomy_levels"),
            "r.demographic_key",
            "r.demographic_value",
            "r.demographic_type",
            "r.confidence",
            "r.condition_sequence",
            (poll == "poll_1").alias("is_approved"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def events(self) -> DataFrame:
        k = F.from_json("props", "k bigint")["k"]
        user = F.col("user_id")
        return self.table("events").select(
            device(user).alias("device_id"),
            F.when(F.col("event_type") == "error", F.lit(None))
            .when(k % 10 == 0, device_hash(user + 1))
            .otherwise(device_hash(user))
            .alias("user_id"),
            F.col("ts").alias("event_time"),
            F.when(F.col("event_type") == "view", F.lit("[Guides-Surveys] view"))
            .otherwise(F.col("event_type"))
            .alias("event_type"),
            F.to_json(
                F.struct(
                    F.when(k % 7 == 0, F.lit(""))
                    .when(k % 11 != 0, F.concat(F.lit("pub_"), (k % 3).cast("string")))
                    .alias("publication_name")
                )
            ).alias("event_properties"),
        )

    @cached_property
    def email(self) -> DataFrame:
        """Two hashes per person, their own and one that three of them share, so that choosing one is exercised."""
        key = F.col("c_custkey")
        hashes = F.array(device_hash(key), device_hash(F.floor(key / 3)))
        return self.table("customer").select(
            key.alias("id"),
            F.explode(hashes).alias("sha256"),
            F.when(key % 13 != 0, key % 5).alias("emailqualitylevel"),
            F.when(key % 17 != 0, key % 7).alias("rankorder"),
            F.date_add(F.lit("2024-01-01").cast("date"), (key % 300).cast("int")).alias("updatedate"),
        )

    @cached_property
    def person(self) -> DataFrame:
        key = F.col("c_custkey")
        code = lambda name, n: F.concat(F.lit(name), (key % n).cast("string"))
        return (
            self.table("customer")
            .where(key % 19 != 0)
            .select(
                key.alias("id"),
                F.when(key % 11 != 0, 18 + key % 70).alias("age"),
                code("gen_", 4).alias("generation"),
                F.when(key % 9 != 0, F.col("c_mktsegment")).alias("income_hh"),
                code("worth_", 3).alias("net_worth_hh"),
                code("edu_", 5).alias("education"),
                code("job_", 6).alias("occupation_category"),
                code("status_", 2).alias("marital_status"),
                code("home_", 2).alias("home_owner"),
                code("group_", 4).alias("ethnic_group"),
                F.when(key % 8 != 0, key % 3).alias("children_hh"),
                F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
                F.when(key % 6 != 0, 1 + key % 4).alias("home_owner_ordinal"),
                F.when(key % 4 != 0, key % 3).alias("owns_investments"),
            )
        )

    @cached_property
    def place(self) -> DataFrame:
        key = F.col("c_custkey")
        nation = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))  # fixed list of nations
        return (
            self.table("customer")
            .where(key % 23 != 0)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                key.alias("id"),
                F.when(key % 5 == 0, "X").alias("gender"),
                F.col("n_name").alias("state"),
                F.col("c_nationkey").alias("dma"),
            )
        )
