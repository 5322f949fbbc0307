"""Quality rules from what a public tokenizer makes of a text: its fertility.

Per text: characters per token, share of tokens that are single bytes the vocabulary has no piece for, and entropy of
the tokens (bits). Words are encoded one by one, as the vocabulary never joins them. Each measure has a band per
language and length class (power of two of the number of tokens), from all texts of that group that pass the base
rules: quartiles on a fixed grid, widened by `reach` times their distance and at least to a fixed width around the
median. A class of fewer than `least` texts takes in its group's neighbouring classes, as few as give it so many,
and is widened by the distance of the quartiles once more for each length class it reaches out. A text in a language of
fewer than `least` such texts is held to the bands of its script (the one of most of its letters), and if that has too few,
to those of all texts, however few they are. So every text that passes the base rules has a band, and one outside it is
rejected.

Base rules: fewer than 10 words, or more than 20 % of the words in 5-word windows that occur twice or more.

NULL texts are empty. A NULL language is a group of its own. Equal rows each count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm import words
from canvass.llm.byte_bpe import PIECES, IdTable
from canvass.llm.common import pieces, python_ready, written

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SYMBOLS = "[#*$%&|<>]"
BLANK = " \t\n\x0b\x0c\r"
LEAST_WORDS, WINDOW, REPEATS = 10, 5, 20
#: Measure: cells per unit of its grid, least width of the band to either side of the median.
MEASURES = {"chars_per_token": (256, 0.1), "byte_share": (1024, 0.05), "token_entropy": (64, 0.5)}
REACH, LEAST = 2.0, 20
# First code points of blocks, and the script of their letters ("" for marks and other characters).
SCRIPTS = {
    0x41: "latin", 0x5B: "", 0x61: "latin", 0x7B: "", 0xAA: "latin", 0xAB: "", 0xC0: "latin", 0x2B0: "", 0x370: "greek",
    0x400: "cyrillic", 0x530: "armenian", 0x590: "hebrew", 0x600: "arabic", 0x700: "other", 0x900: "devanagari", 0x980: "other",
    0xE00: "thai", 0xE80: "other", 0x1E00: "latin", 0x1F00: "greek", 0x2000: "", 0x3040: "kana", 0x3100: "other", 0x3400: "han",
    0xA000: "other", 0xAC00: "hangul", 0xD7B0: "other", 0x1F000: "", 0x20000: "han",
}


class Vocabulary:
    """Token ids of words, with the words of a process kept."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.known = IdTable()

    def numbers(self, distinct: list[str]) -> np.ndarray:
        new = [w for w in distinct if w not in self.known.index]
        if len(self.known.index) + len(new) > PIECES:
            self.known.clear()
            new = distinct
        self.known.add(new, self.model.encode(new, num_threads=1) if new else [])
        return np.fromiter(map(self.known.index.__getitem__, distinct), np.int64, len(distinct))


def _sums(row: np.ndarray, x: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, x, rows).astype(np.int64)


def _repeat_words(starts: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Per row, the words in windows that occur twice or more in it."""
    row = words.rows_of(starts)
    at = np.flatnonzero(words.whole(starts, WINDOW))
    gram = words.grams(h, WINDOW)[at]
    order = np.lexsort((gram, row[at]))
    same = (gram[order][1:] == gram[order][:-1]) & (row[at][order][1:] == row[at][order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    edges = np.zeros(len(h) + 1, np.int64)
    np.add.at(edges, at[twice], 1)
    np.add.at(edges, at[twice] + WINDOW, -1)
    return np.bincount(row[np.cumsum(edges)[:-1] > 0], minlength=len(starts) - 1)


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    return len(lines) - len(set(lines))


def _entropy(row: np.ndarray, token: np.ndarray, n: np.ndarray) -> np.ndarray:
    pairs = np.sort(row.astype(np.int64) << 20 | token)
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(pairs))).astype(float)
    inner = np.bincount(pairs[first] >> 20, count * np.log2(count), len(n))
    return np.where(n > 0, np.log2(np.maximum(n, 1)) - inner / np.maximum(n, 1), 0.0)


_STARTS = np.array([0, *SCRIPTS])
_NAMES = sorted(set(SCRIPTS.values()))
_OF = np.array([_NAMES.index(x) for x in ("", *SCRIPTS.values())])


def _scripts(distinct: pa.Array, at: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """The script of most letters of each text; of equally many, the first by name, and "" without letters."""
    points = np.frombuffer("".join(distinct.to_pylist()).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(distinct)), np.asarray(pc.utf8_length(distinct), np.int64))
    script = _OF[np.searchsorted(_STARTS, points, "right") - 1]
    held = np.bincount(owner * len(_NAMES) + script, minlength=len(distinct) * len(_NAMES)).reshape(-1, len(_NAMES))
    found = np.stack([np.bincount(row, held[at, k], rows) for k in range(len(_NAMES))], 1)
    found[:, 0] = 0.5  # that of no script counts less than any letter
    return pa.array(np.array(_NAMES, object)[found.argmax(axis=1)], pa.string())


def _measures(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Vocabulary(vocabulary)
        for batch in batches:
            for part in pieces(batch, 1):
                texts, rows = pc.fill_null(part.column(1), ""), part.num_rows
                starts, flat = words.split(texts)
                row = words.rows_of(starts)
                code = flat.dictionary_encode()
                at = np.asarray(code.indices)
                number = coder.numbers(code.dictionary.to_pylist())[at]
                chars = _sums(row, np.asarray(pc.utf8_length(code.dictionary), np.int64)[at], rows)
                lengths = coder.known.lengths[number]
                tokens = coder.known.joined(number)
                n = _sums(row, lengths, rows)
                token_row = np.repeat(row, lengths)
                of_bytes = np.bincount(token_row[coder.is_byte[tokens]], minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        _scripts(code.dictionary, at, row, rows),
                        pa.array(np.diff(starts)),
                        pa.array(chars),
                        pc.cast(pc.count_substring_regex(texts, SYMBOLS), pa.int64()),
                        pa.array([_dup_lines(t) for t in texts.to_pylist()], pa.int64()),
                        pa.array(_repeat_words(starts, words.hashes(flat))),
                        pa.array(n),
                        pa.array(chars / np.maximum(n, 1)),
                        pa.array(of_bytes / np.maximum(n, 1)),
                        pa.array(_entropy(token_row, tokens, n)),
                    ],
                    ["doc_id", "lang", "script", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", *MEASURES],
                )

    return run


def _with_neighbours(counts: DataFrame, least: int) -> DataFrame:
    """Cells of every class with those of the classes up to `near` away: the least distance that gives `least` texts, and
    all classes where there are fewer.

    A group's classes are one short list, as there are at most 64 of them.
    """
    each = counts.filter(F.col("m") == next(iter(MEASURES))).groupBy("group", "size").agg(F.sum("held").alias("n"))
    listed = each.groupBy("group").agg(F.collect_list(F.struct("size", "n")).alias("classes"))
    target = listed.select("group", "classes", F.explode("classes.size").alias("to"))

    def enough(r):
        inside = F.filter("classes", lambda c: F.abs(c["size"] - F.col("to")) <= r)
        return F.aggregate(inside, F.lit(0).cast("long"), lambda n, c: n + c["n"]) >= least

    near = F.coalesce(F.array_min(F.filter(F.sequence(F.lit(0), F.lit(63)), enough)), F.lit(63))
    target = target.withColumn("near", near)
    target = target.select(F.col("group").alias("to_group"), "to", "near", F.explode(F.expr("sequence(to - near, to + near)")).alias("of"))
    met = counts.join(target, (F.col("group") == F.col("to_group")) & (F.col("size") == F.col("of")))
    return met.groupBy("group", F.col("to").alias("size"), "near", "m", "cell").agg(F.sum("held").alias("held"))


def _group(kind: str, name: Column | None = None) -> Column:
    """Name of a group of texts; NULL is a language of its own."""
    return F.lit(kind) if name is None else F.concat_ws(":", F.lit(kind), name)


def grouped(measured: DataFrame, least: int) -> DataFrame:
    """Texts with the group whose bands they are held to. Languages and scripts are few; their counts are joined."""
    passed = measured.filter("not base_failed").groupBy("lang", "script").agg(F.count(F.lit(1)).alias("n"))
    passed = written(passed, "fertility-groups")
    enough = lambda c: passed.groupBy(c).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select(F.col(c).alias(f"own_{c}"))
    lang, script = (enough(c).withColumn(f"has_{c}", F.lit(True)) for c in ("lang", "script"))
    rows = measured.join(lang, F.col("lang").eqNullSafe(F.col("own_lang")), "left").join(script, F.col("script") == F.col("own_script"), "left")
    group = F.when(F.col("has_lang"), _group("lang", F.col("lang"))).when(F.col("has_script"), _group("script", F.col("script")))
    return rows.select(*measured.columns, F.coalesce(group, _group("all")).alias("group"))


def bands(measured: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """One row per group (language, script, all) and length class: low_<measure> and high_<measure>."""
    cells = [F.struct(F.lit(m).alias("m"), F.floor(F.col(m) * g).alias("cell")) for m, (g, _) in MEASURES.items()]
    counts = (
        measured.filter("not base_failed")
        .select("lang", "script", "size", F.explode(F.array(*cells)).alias("x"))
        .groupBy("lang", "script", "size", "x.m", "x.cell")
        .agg(F.count(F.lit(1)).alias("held"))
    )
    groups = F.array(_group("lang", F.col("lang")), _group("script", F.col("script")), _group("all"))
    counts = counts.withColumn("group", F.explode(groups)).groupBy("group", "size", "m", "cell").agg(F.sum("held").alias("held"))
    counts = _with_neighbours(counts, least)
    group = Window.partitionBy("group", "size", "m")
    counts = counts.withColumn("up_to", F.sum("held").over(group.orderBy("cell"))).withColumn("all", F.sum("held").over(group))
    quarter = lambda q: F.min(F.when(F.col("up_to") >= q * F.col("all"), F.col("cell")))
    found = counts.groupBy("group", "size", "near", "m").agg(
        quarter(0.25).alias("q1"), quarter(0.5).alias("q2"), quarter(0.75).alias("q3")
    )
    grid = F.create_map(*[F.lit(x) for m, (g, _) in MEASURES.items() for x in (m, float(g))])[F.col("m")]
    width = F.create_map(*[F.lit(x) for m, (_, w) in MEASURES.items() for x in (m, w)])[F.col("m")]
    spread = (reach + F.col("near")) * (F.col("q3") - F.col("q1"))
    found = found.withColumn("low", F.least((F.col("q1") - spread) / grid, F.col("q2") / grid - width))
    found = found.withColumn("high", F.greatest((F.col("q3") + 1 + spread) / grid, (F.col("q2") + 1) / grid + width))
    one = [F.max(F.when(F.col("m") == m, F.col(c))).alias(f"{c}_{m}") for m in MEASURES for c in ("low", "high")]
    return found.groupBy("group", "size").agg(*one)


def quality_rules(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    reach: float = REACH,
    least: int = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, and the three measures."""
    python_ready(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").alias("lang"),
    )
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long"
    kinds = ", ".join(f"{m} double" for m in MEASURES)
    measured = rows.mapInArrow(_measures(vocabulary), f"doc_id long, lang string, script string, {counts}, {kinds}")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATS * F.col("n_words"))
    size = F.floor(F.log2(F.greatest("n_tokens", F.lit(1)).cast("double"))).cast("int")
    measured = written(measured.withColumn("base_failed", failed).withColumn("size", size), "fertility")
    # a row per group and length class: as a table of known size it goes to the texts, not they to it
    limits = written(bands(measured, reach, least), "fertility-bands").withColumnsRenamed({"group": "of_group", "size": "of_size"})
    rows = grouped(measured, least)
    met = rows.join(limits, (F.col("group") == F.col("of_group")) & (F.col("size") == F.col("of_size")), "left")
    inside = F.lit(True)
    for m in MEASURES:
        # only texts that fail the base rules may have no band
        inside = inside & F.coalesce(F.col(m).between(F.col(f"low_{m}"), F.col(f"high_{m}")), F.lit(False))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return met.select(*base, (~F.col("base_failed") & inside).alias("kept"), *MEASURES)
