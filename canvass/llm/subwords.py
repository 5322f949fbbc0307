"""Hashed features of words: the word and its character n-grams, for whole arrays of distinct words at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from canvass.llm import words

U = np.uint64
GRAMS = (3, 4, 5)
#: Code points that mark a word's start and end; no character has them.
FIRST, LAST = 0x110000, 0x110001


def features(distinct: pa.Array, bits: int, grams: tuple[int, ...] = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of every word: itself, and its n-grams with the marks, below 2 ** bits."""
    n = len(distinct)
    data = np.frombuffer("".join(distinct.to_pylist()).encode("utf-32-le"), "<u4")
    lengths = np.asarray(pc.utf8_length(distinct), np.int64)
    number = [np.arange(n, dtype=np.int32)]
    bucket = [(words.hashes(distinct) >> U(64 - bits)).astype(np.int32)]
    marked = np.empty(int(lengths.sum()) + 2 * n, np.uint32)
    ends = np.cumsum(lengths + 2) - 1
    starts = ends - lengths - 1
    inner = np.ones(len(marked), bool)
    inner[starts], inner[ends] = False, False
    marked[starts], marked[ends] = FIRST, LAST
    marked[inner] = data
    owner = np.repeat(number[0], lengths + 2)
    for g in grams:
        if len(marked) < g:
            continue
        h = np.full(len(marked) - g + 1, U(g))
        for j in range(g):
            h = h * U(0x100000001B3) + marked[j : j + len(h)]
        own = owner[: len(h)] == owner[g - 1 :]
        number.append(owner[: len(h)][own])
        bucket.append((words.mixed(h[own]) >> U(64 - bits)).astype(np.int32))
    return np.concatenate(number), np.concatenate(bucket)
