"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling.

A word's input is its own vector plus the vectors of its character n-grams (hashed to a fixed number of buckets), added and
divided by the root of their number. Words
of at least LEAST training texts have vectors of their own, found by 64 hash bits; all others share one, so a word that
occurs once can't stand for its text's label. The first entry of a word's vector starts from the log odds of the texts
that hold it, drawn to the classes' odds by SMOOTH texts more.

Two gated recurrent layers read a window of LENGTH words from both ends; attention weighs the states, and a linear layer
gives the window's log odds. A text's value is the highest of all its windows, which overlap by half; a logistic fit on
rows that the network wasn't trained on turns it into a probability.

Training is in numpy on the driver, on a bounded sample (`rows` labelled rows of the two classes, as whole texts with
`each` words on average at most; parameters of `fit`). A label belongs to the text, not to a window, so each round learns
from the TOP windows of each toxic text that are the most toxic so far, from the most toxic window of each clean text, and
from random windows of the clean ones. In the first round, windows are as toxic as the log odds above zero of their words.

NULL and empty texts have no windows: their score is the share of toxic rows. Without labels of both classes all scores
are. Equal rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm import subwords, words
from canvass.llm.common import pieces, python_ready
from canvass.llm.labelled import held_out, sample

U = np.uint64
BITS, WIDTH, STATE = 17, 12, 8
LENGTH, STRIDE = 32, 16
ROWS, WORDS, ROUNDS, BATCH, RATE = (1800, 700), 1600, 8, 128, 0.01
LEAST, SMOOTH, MOST, TOP = 3, 2.0, 3.0, 2
#: Steps of gradient descent at least: a small sample gets more rounds.
STEPS = 180
THRESHOLD = 0.7
#: Windows computed at once when scoring.
TOGETHER = 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Vocabulary:
    """Distinct words and their features: the place of the word's vector, and its n-grams as (word number, bucket)."""

    own: np.ndarray
    number: np.ndarray
    bucket: np.ndarray
    count: np.ndarray = field(init=False)

    def __post_init__(self):
        self.count = np.sqrt(np.maximum(np.bincount(self.number, minlength=len(self.own)), 1)).astype(np.float32)

    @classmethod
    def of(cls, distinct: pa.Array, known: np.ndarray) -> Vocabulary:
        """known: sorted hashes of the words with vectors of their own; place 0 is that of all others."""
        number, bucket = subwords.features(distinct, BITS)
        n, h = len(distinct), words.hashes(distinct)
        place = np.searchsorted(known, h)
        own = np.zeros(n, np.int64)
        inside = np.flatnonzero(place < len(known))
        inside = inside[known[place[inside]] == h[inside]]
        own[inside] = place[inside] + 1
        return cls(own, number[n:], bucket[n:])


def _spread(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of `rows` by index."""
    return np.stack([np.bincount(index, rows[:, j], size) for j in range(rows.shape[1])], 1).astype(np.float32)


class Network:
    """Parameters by name, the forward pass, and the gradient of the logistic loss."""

    def __init__(self, seed: int = 0, bits: int = BITS, width: int = WIDTH, state: int = STATE, known: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        near = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.state, self.known = state, known
        self.p = {
            "words": rng.normal(0, 0.02, (1 << bits if known is None else len(known) + 1, width)).astype(np.float32),
            "chars": rng.normal(0, 0.1, (1 << bits, width)).astype(np.float32),
            "query": near(2 * state, state), "look": near(state, 1), "out": near(2 * state, 1), "bias": np.zeros(1, np.float32),
        }
        for d in "fb":  # update, reset and new state, side by side
            self.p |= {f"{d}.in": near(width, 3 * state), f"{d}.state": near(state, 3 * state), f"{d}.bias": np.zeros(3 * state, np.float32)}

    def inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        # one column at a time: the vectors of all n-grams would be much larger than those of the words
        columns = np.ascontiguousarray(self.p["chars"].T)
        number, bucket, n = vocabulary.number, vocabulary.bucket, len(vocabulary.own)
        chars = np.stack([np.bincount(number, c[bucket], n) for c in columns], 1).astype(np.float32)
        return self.p["words"][vocabulary.own] + chars / vocabulary.count[:, None]

    def _run(self, d: str, projected: np.ndarray, at: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
        """States (time, window, state) of one direction; `keep` gets what the gradient needs."""
        s, steps = self.state, range(at.shape[1])
        h = np.zeros((at.shape[0], s), np.float32)
        out = np.empty((at.shape[1], at.shape[0], s), np.float32)
        weights = self.p[f"{d}.state"]
        for t in steps if d == "f" else reversed(steps):
            x, u = projected[at[:, t]], h @ weights
            gates = _sigmoid(x[:, : 2 * s] + u[:, : 2 * s])
            new = np.tanh(x[:, 2 * s :] + gates[:, s:] * u[:, 2 * s :])
            after = new + gates[:, :s] * (h - new)
            if mask is not None:
                after = np.where(mask[:, t, None], after, h)
            if keep is not None:
                keep.append((t, h, gates, new, u[:, 2 * s :]))
            out[t] = h = after
        return out

    def forward(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray | None = None, keep: dict | None = None) -> np.ndarray:
        """Log odds of windows; at: (window, time) numbers of words, mask: which of them are there."""
        kept = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        both = [self._run(d, x @ self.p[f"{d}.in"] + self.p[f"{d}.bias"], at, mask, kept[d]) for d in "fb"]
        h = np.concatenate(both, 2)
        looked = np.tanh(h @ self.p["query"])
        e = (looked @ self.p["look"])[:, :, 0]
        if mask is not None:
            e = np.where(mask.T, e, -np.inf)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tb,tbs->bs", a, h)
        if keep is not None:
            keep |= {"kept": kept, "h": h, "looked": looked, "a": a, "pooled": pooled, "mask": mask, "x": x, "at": at}
        return (pooled @ self.p["out"])[:, 0] + self.p["bias"][0]

    def gradient(self, k: dict, back: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters above the inputs, and of the inputs x; back: gradient of the log odds."""
        p, s, g = self.p, self.state, {}
        h, a, looked = k["h"], k["a"], k["looked"]
        g["out"], g["bias"] = k["pooled"].T @ back[:, None], back.sum(keepdims=True)
        pooled = back[:, None] * p["out"][:, 0]
        states = a[:, :, None] * pooled
        of_a = np.einsum("bs,tbs->tb", pooled, h)
        of_e = a * (of_a - (a * of_a).sum(0))
        of_look = of_e[:, :, None] * p["look"][:, 0] * (1 - looked**2)
        g["look"] = np.einsum("tbs,tb->s", looked, of_e)[:, None]
        g["query"] = np.einsum("tbs,tbq->sq", h, of_look)
        states += of_look @ p["query"].T
        x, at, mask = k["x"], k["at"], k["mask"]
        of_x = np.zeros_like(x)
        for n, d in enumerate("fb"):
            up, weights = states[:, :, n * s : (n + 1) * s], p[f"{d}.state"]
            of_h, of_w = np.zeros_like(up[0]), np.zeros_like(weights)
            steps = np.zeros((at.shape[1], at.shape[0], 3 * s), np.float32)
            for t, before, gates, new, u in reversed(k["kept"][d]):
                dh = up[t] + of_h
                pass_on = np.zeros_like(dh)
                if mask is not None:
                    m = mask[:, t, None]
                    pass_on, dh = np.where(m, 0, dh), np.where(m, dh, 0)
                z, r = gates[:, :s], gates[:, s:]
                dn = dh * (1 - z) * (1 - new**2)
                dz, dr = dh * (before - new) * z * (1 - z), dn * u * r * (1 - r)
                du = np.concatenate((dz, dr, dn * r), 1)
                steps[t] = np.concatenate((dz, dr, dn), 1)
                of_w += before.T @ du
                of_h = dh * z + du @ weights.T + pass_on
            flat, words_at = steps.reshape(-1, 3 * s), at.T.reshape(-1)
            by_word = _spread(words_at, flat, len(x))
            g[f"{d}.state"], g[f"{d}.bias"], g[f"{d}.in"] = of_w, flat.sum(0), x.T @ by_word
            of_x += by_word @ p[f"{d}.in"].T
        return g, of_x

    def input_gradient(self, vocabulary: Vocabulary, of_x: np.ndarray) -> dict[str, np.ndarray]:
        share = of_x / vocabulary.count[:, None]
        return {
            "words": _spread(vocabulary.own, of_x, len(self.p["words"])),
            "chars": _spread(vocabulary.bucket, share[vocabulary.number], len(self.p["chars"])),
        }


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            scale = self.rate / (1 - 0.9**self.t)
            self.p[k] -= scale * self.m[k] / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def windows(starts: np.ndarray, length: int = LENGTH, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and first place of every window, and its length: every `stride` words, and one that ends where the row ends."""
    n = np.diff(starts)
    many = np.where(n > 0, 1 + np.maximum(0, -(-(n - length) // stride)), 0)
    row = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    first = np.minimum(nth * stride, np.maximum(n[row] - length, 0))
    return row, starts[row] + first, np.minimum(n[row], length)


def _window_values(network: Network, x: np.ndarray, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.empty(len(first), np.float32)
    for short in (False, True):
        chosen = np.flatnonzero((size < LENGTH) == short)
        for k in range(0, len(chosen), TOGETHER):
            some = chosen[k : k + TOGETHER]
            longest = int(size[some].max())
            place = np.arange(longest)
            mask = place < size[some][:, None] if short else None
            here = at[np.minimum(first[some][:, None] + place, len(at) - 1)]
            out[some] = network.forward(x, here, mask)
    return out


def text_values(texts: pa.Array, network: Network) -> np.ndarray:
    """The highest window value of each text; -inf without words."""
    starts, flat = words.split(texts)
    out = np.full(len(texts), -np.inf)
    if len(flat):
        code = flat.dictionary_encode()
        x = network.inputs(Vocabulary.of(code.dictionary, network.known))
        row, first, size = windows(starts)
        np.maximum.at(out, row, _window_values(network, x, np.asarray(code.indices, np.int64), first, size))
    return out


@dataclass
class Model:
    network: Network | None
    slope: float
    shift: float
    odds: float

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.odds)
        value = text_values(texts, self.network)
        return np.where(np.isfinite(value), self.slope * np.where(np.isfinite(value), value, 0) + self.shift, self.odds)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit with a slight penalty on the slope; Newton's method."""
    b = np.array([1.0, 0.0])
    a = np.stack((x, np.ones_like(x)), 1)
    for _ in range(50):
        p = _sigmoid(np.clip(a @ b, -30, 30))
        g = a.T @ (weight * (p - y)) + [0.05 * (b[0] - 1), 0.05 * b[1]]
        h = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + 0.05 * np.eye(2)
        move = np.linalg.solve(h, g)
        b -= move * min(1, 2 / (np.abs(move).max() + 1e-9))
    return float(max(b[0], 1e-3)), float(b[1])


def _whole(texts: list[str], labels: list[int], most: tuple[int, int]) -> tuple[list[pa.Array], list[int]]:
    """Words of whole texts and their labels, in order, as far as `most` words of each class allow; a text that no longer
    fits is left out, as a part of it may not show what its label says."""
    left, lists, kept = list(most), [], []
    for text, label in zip(texts, labels, strict=True):
        w = words.split(pa.array([text]))[1]
        if len(w) <= left[label]:
            left[label] -= len(w)
            lists.append(w)
            kept.append(label)
    return lists, kept


def _evidence(distinct: pa.Array, at: np.ndarray, row: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words in at least LEAST of the texts, and the log odds of the texts that hold each over those of
    all texts, at most MOST to either side; at, row: word and text of every place, y: labels of the texts."""
    n = len(distinct)
    pairs = np.unique(at * len(y) + row)
    word, toxic = pairs // len(y), y[pairs % len(y)]
    held, found = np.bincount(word, minlength=n), np.bincount(word, toxic, n)
    h = words.hashes(distinct)
    chosen = np.flatnonzero(held >= LEAST)
    chosen = chosen[np.argsort(h[chosen])]
    share = np.bincount(y[np.unique(row)], minlength=2) / max(len(np.unique(row)), 1)
    p = (found[chosen] + SMOOTH * share[1]) / (held[chosen] + SMOOTH)
    odds = np.log(np.maximum(p, 1e-9) / np.maximum(1 - p, 1e-9)) - np.log(max(share[1], 1e-9) / max(share[0], 1e-9))
    return h[chosen], np.clip(odds, -MOST, MOST)


def train(
    texts: list[str],
    labels: list[int],
    odds: float,
    rounds: int = ROUNDS,
    seed: int = 0,
    most: tuple[int, int] = (WORDS * ROWS[0], WORDS * ROWS[1]),
) -> Model:
    """One text in five is left for the logistic fit; most: words of each class."""
    lists, labels = _whole(texts, labels, most)
    y = np.array(labels)
    if len(np.unique(y)) < 2:
        return Model(None, 1, 0, odds)
    rng = np.random.default_rng(seed)
    starts = np.concatenate(([0], np.cumsum([len(w) for w in lists])))
    code = pa.concat_arrays(lists).dictionary_encode()
    del lists
    at = np.asarray(code.indices, np.int64)
    row, first, size = windows(starts)
    learns = np.arange(len(y)) % 5 != 4 if len(y) > 20 else np.ones(len(y), bool)
    order = np.argsort(row, kind="stable")
    cuts = np.searchsorted(row[order], np.arange(len(y) + 1))
    text_of = words.rows_of(starts)
    known, evidence = _evidence(code.dictionary, at[learns[text_of]], text_of[learns[text_of]], y)
    vocabulary = Vocabulary.of(code.dictionary, known)
    network = Network(seed, known=known)
    network.p["words"][1:, 0] += evidence.astype(np.float32)
    adam = Adam(network.p, RATE)
    place = np.arange(LENGTH)
    clean = np.flatnonzero(learns[row] & (y[row] == 0))
    per_row = [order[cuts[r] : cuts[r + 1]] for r in np.flatnonzero(learns) if cuts[r] < cuts[r + 1]]
    a_round = sum(min(len(w), TOP if y[row[w[0]]] else 1) for w in per_row) + min(len(per_row) // 3, len(clean))
    rounds = max(rounds, -(-STEPS // max(-(-a_round // BATCH), 1)))
    told = np.concatenate(([0.0], np.cumsum(np.maximum(np.append(0, evidence), 0)[vocabulary.own][at])))
    for n in range(rounds):
        adam.rate = RATE * (1 - n / rounds) ** 0.5
        if n == 0:
            value = told[first + size] - told[first]
        else:
            value = _window_values(network, network.inputs(vocabulary), at, first, size)
        chosen = np.concatenate([w[np.argsort(-value[w], kind="stable")[: TOP if y[row[w[0]]] else 1]] for w in per_row])
        chosen = np.concatenate((chosen, rng.choice(clean, min(len(per_row) // 3, len(clean)), replace=False)))
        chosen = rng.permutation(chosen)
        for k in range(0, len(chosen), BATCH):
            some = chosen[k : k + BATCH]
            here = at[np.minimum(first[some][:, None] + place, len(at) - 1)]
            used, here = np.unique(here, return_inverse=True)
            here = here.reshape(len(some), LENGTH)
            member = np.zeros(len(vocabulary.own), np.int64) - 1
            member[used] = np.arange(len(used))
            own = member[vocabulary.number]
            part = Vocabulary(vocabulary.own[used], own[own >= 0], vocabulary.bucket[own >= 0])
            kept: dict = {}
            z = network.forward(network.inputs(part), here, place < size[some][:, None], kept)
            g, of_x = network.gradient(kept, ((_sigmoid(z) - y[row[some]]) / len(some)).astype(np.float32))
            adam.step(g | network.input_gradient(part, of_x))
    value = np.full(len(y), -np.inf)
    np.maximum.at(value, row, _window_values(network, network.inputs(vocabulary), at, first, size))
    rest = np.isfinite(value) & (~learns if len(np.unique(y[~learns])) == 2 else learns)
    rate = _sigmoid(np.array(odds))
    weight = np.where(y == 1, rate, 1 - rate) / np.where(y == 1, max((y[rest] == 1).sum(), 1), max((y[rest] == 0).sum(), 1)) * rest.sum()
    slope, shift = _logistic(value[rest], y[rest], weight[rest])
    return Model(network, slope, shift, odds)


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1, 2 << 20):
                z = model.value.log_odds(pc.fill_null(part.column(1), ""))
                score = pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))
                yield pa.RecordBatch.from_arrays([part.column(0), score], ["doc_id", "score"])

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    rows: tuple[int, int] = ROWS,
    each: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model from at most `rows` labelled rows of the classes 0 and 1, with `each` words on average at most."""
    found, odds = sample(docs, labels, label, rows, id_col, text_col)
    got = sorted((r._id, r.text or "", r.label) for r in found.collect())
    rng = np.random.default_rng(0)
    got = [got[i] for i in rng.permutation(len(got))]
    return train([t for _, t, _ in got], [c for _, _, c in got], odds, most=(each * rows[0], each * rows[1]))


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, score (of label 1) and predicted (score >= threshold)."""
    spark = docs.sparkSession
    python_ready(spark)
    model = spark.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text_col=text_col))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scored = rows.mapInArrow(_scores(model), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
