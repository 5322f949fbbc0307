"""Quality of texts by supervised subword embeddings.

A text's features are its words, their character n-grams and its pairs of neighbouring words, hashed to a fixed number of
buckets; a word that repeats the one before it counts as the pair (same, same), whichever word it is. The vectors of all
features of a text are averaged; a linear layer and softmax give the class. Vectors and layer are trained by stochastic
gradient descent in numpy on the driver, on a bounded sample of the labelled rows (ROWS of each class, with BUCKETS a
bound on memory too).

To score, the trained model is a table with one number per bucket (its vector's share of the log odds), so every
distinct word of a batch is looked up once. NULL and empty texts have no features and get the score of the layer's bias.
Without labels of both classes every score is the share of class 1. Equal rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm import subwords, words
from canvass.llm.common import pieces, python_ready
from canvass.llm.labelled import held_out, sample

U = np.uint64
BITS, WIDTH, ROWS, EPOCHS, RATE = 16, 8, 1000, 8, 0.5
#: Steps of a small sample.
LEAST_STEPS = 5000


def _pairs(starts: np.ndarray, h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the neighbouring pairs."""
    at = np.flatnonzero(words.whole(starts, 2))
    a, b = h[at], h[at + 1]
    pair = words.mixed(a * U(0x9E3779B97F4A7C15) + b)
    return words.rows_of(starts)[at], (np.where(a == b, U(2**63), pair) >> U(64 - bits)).astype(np.int64)


def _inputs(texts: pa.Array, bits: int):
    """Starts of the rows, number of the distinct word at each place, (word, bucket) and (row, bucket) features."""
    starts, flat = words.split(texts)
    code = flat.dictionary_encode()
    at = np.asarray(code.indices, np.int64)
    distinct = code.dictionary
    h = words.hashes(distinct)[at] if len(distinct) else np.zeros(0, U)
    return starts, at, subwords.features(distinct, bits), _pairs(starts, h, bits)


def _bags(bits: int):
    """Per training row: label, and its distinct buckets with their share of the features (uint32, float32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                _, at, (number, bucket), (_, pair) = _inputs(one.column(1), bits)
                times = np.bincount(at)
                held = np.bincount(bucket, times[number] if len(at) else None, 1 << bits) + np.bincount(pair, minlength=1 << bits)
                here = np.flatnonzero(held)
                share = (held[here] / max(held.sum(), 1)).astype("<f4")
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(2), pa.array([here.astype("<u4").tobytes()], pa.binary()), pa.array([share.tobytes()], pa.binary())],
                    ["id", "label", "buckets", "shares"],
                )

    return run


@dataclass
class Model:
    """weights: a bucket's share of the log odds of class 1; bias: the rest."""

    weights: np.ndarray
    bias: float
    bits: int


def train(
    bags: list[tuple[int, np.ndarray, np.ndarray]],
    odds: float,
    bits: int = BITS,
    width: int = WIDTH,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 0,
) -> Model:
    """Softmax over averaged vectors by stochastic gradient descent, one text after the other.

    bags: (label, buckets, shares). The sample is balanced; `odds` puts the share of class 1 back.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    layer, bias = np.zeros((width, 2), np.float32), np.zeros(2, np.float32)
    if {label for label, _, _ in bags} < {0, 1}:
        return Model(np.zeros(1 << bits, np.float32), odds, bits)
    counts = np.bincount([label for label, _, _ in bags], minlength=2)
    epochs = max(epochs, LEAST_STEPS // len(bags))
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            label, buckets, shares = bags[i]
            speed = rate * (1 - step / steps)
            step += 1
            x = shares @ vectors[buckets]
            z = x @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            p *= len(bags) / (2 * counts[label])
            back = layer @ p
            layer -= speed * np.outer(x, p)
            bias -= speed * p
            # shares are far below one, so a text's step is scaled to its vector: as if each feature were one text
            vectors[buckets] -= np.outer(shares / (shares @ shares), speed * 0.05 * back).astype(np.float32)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]) + odds, bits)


def log_odds(texts: pa.Array, model: Model) -> np.ndarray:
    starts, at, (number, bucket), (row, pair) = _inputs(texts, model.bits)
    rows, n = len(texts), int(at.max()) + 1 if len(at) else 0
    value = np.bincount(number, model.weights[bucket], n)
    count = np.bincount(number, minlength=n)
    where = words.rows_of(starts)
    total = np.bincount(where, value[at], rows) + np.bincount(row, model.weights[pair], rows)
    many = np.bincount(where, count[at], rows) + np.bincount(row, minlength=rows)
    return total / np.maximum(many, 1) + model.bias


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, batch.schema.get_field_index("_text")):
                z = log_odds(pc.fill_null(part.column("_text"), ""), model.value)
                score = pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))
                rest = part.drop_columns(["_text"])
                yield pa.RecordBatch.from_arrays([*rest.columns, score], [*rest.schema.names, "_score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on at most `rows` labelled rows of each class; the sample reaches the driver as bags of buckets."""
    python_ready(docs.sparkSession)
    found, odds = sample(docs, labels, label, (rows, rows), id_col, text_col)
    found = found.withColumn("text", F.coalesce("text", F.lit("")))
    bags = found.mapInArrow(_bags(BITS), "id long, label int, buckets binary, shares binary").collect()
    bags = [
        (r.label, np.frombuffer(r.buckets, "<u4").astype(np.int64), np.frombuffer(r.shares, "<f4"))
        for r in sorted(bags, key=lambda r: (r.id, r.label, bytes(r.buckets), bytes(r.shares)))
    ]
    return train([b for b in bags if len(b[1])], odds)


def with_score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all, if None), as c0, c1, …, with _score."""
    names = docs.columns if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{text_col}`").alias("_text"))
    schema = rows.drop("_text").schema.add("_score", "double")
    return rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), schema)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (of label 1) and predicted (score >= 0.5)."""
    scored = with_score(docs, fit(docs, labels, id_col=id_col, text_col=text_col), text_col, [id_col])
    return scored.select(
        F.col("c0").cast("long").alias("doc_id"),
        held_out(F.col("c0")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are predicted to be good, with their columns."""
    names = docs.columns
    scored = with_score(docs, fit(docs, labels, id_col=id_col, text_col=text_col), text_col)
    return scored.filter("_score >= 0.5").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
