"""Named queries opN_<name> over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canvass.llm import line_dedup, mixing
from canvass.llm.common import table
from canvass.llm.conversations import conversation_repair
from canvass.llm.decontaminate import contamination
from canvass.llm.fertility import quality_rules
from canvass.llm.frames import token_frames
from canvass.llm.jaccard import jaccard_components
from canvass.llm.pii import find_pii
from canvass.llm.quality import quality
from canvass.llm.simhash import simhash_components
from canvass.llm.substrings import substring_dedup
from canvass.llm.toxicity import toxicity
from canvass.llm.whitening import embedding_whitening


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.line_dedup(table(spark, sf_dir, "pages")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op8_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(table(spark, sf_dir, "conversations"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii": op2_pii,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_source_mix": op7_source_mix,
    "op8_fertility_rules": op8_fertility_rules,
    "op9_contamination": op9_contamination,
    "op10_token_frames": op10_token_frames,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_simhash": op12_simhash,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op7_source_mix": mixing.ORACLE,
}
