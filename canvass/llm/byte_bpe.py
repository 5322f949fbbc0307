"""Byte-level BPE of whole columns with a cache of parts, equal to encoding each text at once.

The public byte-level pattern always starts a new piece at certain places: at a space or line break before
a visible character, at an ASCII mark after a letter, at a line break after a visible character, and after a line break. All texts of a slice are
cut at these places in their common buffer, distinct parts are looked up or encoded once, and the ids are joined. Texts
that open a special token, and all texts if the vocabulary cuts or normalises in another way, are encoded as a whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from canvass.llm import words

#: Parts kept by a process in each of two tables; bounds memory, not results.
PIECES = 600_000
# A Latin word, which the pattern never cuts.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
# The model shows a byte that isn't printable as the next free character from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PLAIN)}
# Classes of bytes: letters of ASCII, visible other ASCII, lead bytes of the letters from 0xC0 to 0x17F.
_LETTER, _MARK, _LEAD = 1, 2, 4
_CLASS = np.zeros(256, np.uint8)
for _b in range(33, 127):
    _CLASS[_b] = _LETTER if chr(_b).isalpha() else _MARK
_CLASS[0xC3:0xC6] = _LEAD


def _before(x: np.ndarray, fill) -> np.ndarray:
    """Each byte's predecessor."""
    return np.concatenate(([fill], x[:-1])) if len(x) else x


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every byte of UTF-8 texts that end before `ends`, whether a piece surely starts there; that texts' first bytes
    do is left to the caller."""
    kind = _CLASS[data]
    # multiplication and division signs are the only others with these lead bytes
    lead = kind == _LEAD
    lead[:-1] &= ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    letter_ends = (kind == _LETTER) | _before(lead, False)
    visible = (kind == _LETTER) | (kind == _MARK) | lead
    line = data == 10
    found = _before(letter_ends, False) & (kind == _MARK) & ((data < 48) | (data > 57))
    found |= line & _before(letter_ends | (kind == _MARK), False)
    found |= visible & _before(line, False)
    # of a run of white space before something visible, the last character is a piece or the front of one
    next_visible = np.concatenate((visible[1:], [False]))
    next_visible[ends - 1] = False
    found |= ((data == 32) | line) & next_visible
    return found


class IdTable:
    """Token ids of distinct pieces of text, one after the other in one array."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def add(self, pieces: list[str], lists: list) -> None:
        """New pieces, each with its ids."""
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        k, n = len(self.index), int(lengths.sum())
        while k + len(lists) > len(self.starts):
            self.starts, self.lengths = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.lengths))
        while self.used + n > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + n] = np.fromiter(chain.from_iterable(lists), np.uint32, n)
        self.lengths[k : k + len(lists)] = lengths
        self.starts[k : k + len(lists)] = self.used + np.cumsum(lengths) - lengths
        self.index.update(zip(pieces, range(k, k + len(lists)), strict=True))
        self.used += n

    def get(self, piece: str) -> list[int] | None:
        if (k := self.index.get(piece)) is None:
            return None
        return self.ids[self.starts[k] : self.starts[k] + self.lengths[k]].tolist()

    def joined(self, k: np.ndarray) -> np.ndarray:
        """The ids of pieces number k, in that order."""
        if not len(k):
            return self.ids[:0]
        lengths = self.lengths[k]
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(self.starts[k] - ends + lengths, lengths) + np.arange(ends[-1])]


def cut_by_pattern(path: str) -> bool:
    """Whether the vocabulary's file asks for the pattern above and nothing else before its model."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    before = told.get("pre_tokenizer") or {}
    return (
        told.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("add_prefix_space") is False
        and before.get("use_regex", True)
        and told["model"].get("type") == "BPE"
    )


class ByteBPE:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), cut_by_pattern(path)
        self.known, self.older = IdTable(), IdTable()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.opening = "<|" if all(t.startswith("<|") for t in special) else None

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _ids(self, part: str) -> list[int]:
        """The ids of a new part; a word or a single mark is a piece, which the model itself encodes."""
        if (ids := self.older.get(part)) is not None:
            return ids
        word = part[1:] if part[0] == " " else part
        if word.isascii() and (word.isalpha() or len(part) == 1 and "!" <= part <= "~"):
            shown = "\u0120" + word if part[0] == " " else part
        elif part == "\n":
            shown = "\u010a"
        elif _WORD.fullmatch(part):
            shown = part.encode().decode("latin-1").translate(_SHOWN)
        else:
            return self._whole(part)
        return [token.id for token in self.tokenizer.model.tokenize(shown)]

    def _numbers(self, distinct: list[str]) -> np.ndarray:
        """The numbers of distinct parts in the table, new ones encoded. A full table becomes the older one, which
        still saves encoding the parts that come again."""
        index = self.known.index
        new = [p for p in distinct if p not in index]
        if len(index) + len(new) > PIECES:
            self.older, self.known, new = self.known, IdTable(), distinct
        self.known.add(new, [self._ids(p) for p in new])
        return np.fromiter(map(self.known.index.__getitem__, distinct), np.int64, len(distinct))

    def encode(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """The ids (uint32) of each text, `end` after them; NULL is empty."""
        texts = pc.fill_null(texts, "")
        last = np.array([end], np.uint32)
        if not self.plain or self.opening is None:
            return [np.concatenate((np.array(self._whole(t), np.uint32), last)) for t in texts.to_pylist()]
        odd = np.flatnonzero(np.asarray(pc.match_substring(texts, self.opening)))
        offsets, data = words.raw(texts)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if len(data):
            full = np.diff(offsets) > 0
            found = cuts(data, offsets[1:][full])
            found[offsets[:-1][full]] = True
            at = np.flatnonzero(found)
            edges = np.append(at, len(data)).astype(np.int32 if len(data) < 2**31 else np.int64)
            kind = pa.string() if edges.dtype == np.int32 else pa.large_string()
            parts = pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(edges), pa.py_buffer(data)])
            code = parts.dictionary_encode()
            number = self._numbers(code.dictionary.to_pylist())[np.asarray(code.indices)]
            ids, ends = self.known.joined(number), np.concatenate(([0], np.cumsum(self.known.lengths[number])))
            ends = ends[np.searchsorted(at, offsets)]
        else:
            ids, ends = np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ids = np.insert(ids, ends[1:], end)
        ends = ends + np.arange(len(ends))
        out = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i in odd.tolist():
            out[i] = np.concatenate((np.array(self._whole(texts[i].as_py()), np.uint32), last))
        return out
