"""Words, word n-grams and their 64-bit hashes, for whole Arrow columns at once.

A word is a run of characters other than space and the control characters 9 to 13.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes hashed at once.
STEP = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = U(base), U(pow(base, -1, 2**64))
        self.up = self.down = np.ones(1, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << max(12, (n - 1).bit_length())
            self.up, self.down = (self._run(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, base, U)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTES = [_Powers(0x9E3779B97F4A7C15), _Powers(0xD1342543DE82EF95)]
_WORDS = [_Powers(0xA0761D6478BD642F), _Powers(0xE7037ED1A0B428DB)]
_TABLE = [mixed(np.arange(1, 257, dtype=U) * U(m)) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each row's words start in the list of all words (one entry more than rows), and that list."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    starts = np.asarray(lists.offsets, np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        starts = np.concatenate(([0], np.cumsum(full)))[starts]
        flat = flat.filter(pa.array(full))
    return starts, flat


def raw(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (one more than words) and bytes of a string array."""
    width = np.int64 if pa.types.is_large_string(flat.type) else np.int32
    if not len(flat):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(flat.buffers()[1], width)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    data = flat.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def hashes(flat: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes, from prefix sums, scrambled."""
    offsets, data = raw(flat)
    n = len(flat)
    out = np.empty(n, U)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP, "right")) - 1)
        first, last = offsets[a], offsets[b]
        up, down = _BYTES[seed].to(int(last - first) + 1)
        sums = np.zeros(last - first + 1, U)
        np.cumsum(_TABLE[seed][data[first:last]] * up[:-1], out=sums[1:])
        at = offsets[a : b + 1] - first
        out[a:b] = (sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]]
        a = b
    return mixed(out + U(seed + 1))


def grams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each position on, over all rows' words in one list; never 0, short of the last k - 1."""
    n = len(h)
    if n < k:
        return np.zeros(0, U)
    up, down = _WORDS[seed].to(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(h * up[:-1], out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * down[: n - k + 1] + U(k)) | U(1)


def rows_of(starts: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def whole(starts: np.ndarray, k: int) -> np.ndarray:
    """For each position that has k words from it on in the list: whether they belong to one row."""
    n = int(starts[-1])
    if n < k:
        return np.zeros(0, bool)
    row = rows_of(starts)
    return row[: n - k + 1] == row[k - 1 :]


def sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """`pick` (np.minimum or np.maximum) over each run of w values."""
    if len(x) < w:
        return x[:0]
    done, out = 1, x
    while done * 2 <= w:
        out = pick(out[:-done], out[done:])
        done *= 2
    return pick(out[: len(x) - w + 1], out[w - done : w - done + len(x) - w + 1]) if done < w else out
