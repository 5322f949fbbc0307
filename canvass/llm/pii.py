"""Personal data in whole texts: an Aho-Corasick automaton finds anchors, local parsers expand them to spans.

Anchors are the at-sign, the plus sign, the ten digits, URL schemes and cues of identifiers. From an anchor, a parser
looks at the characters next to it only, in time linear in the span, and validates the boundaries:

    email    around an at-sign: local part to the left, not into an earlier match, and a dotted domain to the right
    ip       a chain of digit groups with single dots, taken four by four, each at most 255
    card     digits with single spaces or hyphens between, 12 to 19 of them, right by the Luhn sum
    phone    from a plus sign, 9 to 15 digits
    url      from a scheme to the first character that can't be in a URL, without closing punctuation
    account  after a cue (account, acct, a/c, iban, konto, compte, cuenta, kontonummer): 6 to 34 letters and digits in
             groups; with an IBAN's shape, its check digits must be right

Matches of one kind are leftmost and don't overlap; one that fails is dropped and not tried again from elsewhere. The
last two kinds come on top, they never replace a span of the first four. Positions are code points, ends exclusive.
NULL texts are empty. Every row gives one row, equal rows included.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import pieces, python_ready

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "a/c", "iban", "kontonummer", "konto", "compte", "cuenta")

# Run on a small window at an anchor; none of them can backtrack over more than one span.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]*")
_URL = re.compile(r"[^\s\"'<>\\^`{|}]+")
_CUE_GAP = re.compile(r"(?:\s*(?:number|no\.?|nr\.?|num\.?|n°|#))?\s{0,3}[:=#.]?\s{0,3}")
_LETTERED = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]+)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9]){5,33}(?![A-Za-z0-9])")
#: An account number with letters has at most so many groups of four characters after its first four.
GROUPS = 8


def _automaton():
    found = ahocorasick.Automaton()
    for word in ("@", "+", *"0123456789"):
        found.add_word(word, (word if word in "@+" else "0", 1))
    for kind, many in (("url", SCHEMES), ("account", CUES)):
        for word in many:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _email(text: str, at: int, done: int) -> tuple[int, int] | None:
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def _ips(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Spans of the chain of digit groups that begins here, and its end."""
    m = _CHAIN.match(text, at)
    groups, out, place = m[0].split("."), [], at
    for i in range(0, len(groups), 4):
        four = groups[i : i + 4]
        size = sum(map(len, four)) + len(four) - 1
        if len(four) == 4 and all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in four):
            out.append((place, place + size))
        place += size + 1
    return out, m.end()


def _phone(text: str, at: int) -> tuple[int, int, bool] | None:
    m = _PHONE.match(text, at)
    if not m:
        return None
    end = m.end()
    while text[end - 1] not in "0123456789":
        end -= 1
    return (at, end, 9 <= len(_digits(text[at:end])) <= 15) if end >= at + 4 else None


def _iban(s: str) -> bool:
    moved = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _number(text: str, at: int) -> int:
    """End of the account number at a place, or that place itself. One with letters: as many whole runs of capitals and
    digits, one space between them, as make GROUPS groups of at most four; nothing is tried twice."""
    if m := _DIGITS.match(text, at):
        return m.end()
    # more characters than that are too many groups in any case
    m = _LETTERED.match(text, at, at + 6 + 10 * GROUPS)
    if not m:
        return at
    end, start, groups, size = at, at + 4, 0, 0
    for run in text[start : m.end()].split(" "):
        groups, size = groups - -len(run) // 4, size + len(run)
        start += len(run)
        if groups > GROUPS:
            break
        # two characters at least, and no letter or digit after them
        if size > 1 and not (text[start : start + 1].isascii() and text[start : start + 1].isalnum()):
            end = start
        start += 1
    return end


def _account(text: str, after: int) -> tuple[int, int] | None:
    gap = _CUE_GAP.match(text, after)
    start = gap.end()
    if start == after or (end := _number(text, start)) == start:
        return None
    plain = text[start:end].replace(" ", "")
    return (start, end) if not plain[0].isalpha() or (15 <= len(plain) <= 34 and _iban(plain)) else None


def find(text: str, automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans, by start, then in the order of KINDS."""
    out: list[tuple[int, str, int]] = []
    email = chain = card = phone = url = account = 0  # where the next match of each kind may begin
    plain = text if text.isascii() else text.translate(_ONE)
    for last, (kind, size) in automaton.iter(plain.lower()):
        start = last - size + 1
        if kind == "0":
            if start >= chain:
                found, chain = _ips(text, start)
                out += [(a, "ip", b) for a, b in found]
            if start >= card:
                m = _CARD.match(text, start)
                card = m.end()
                number = _digits(m[0])
                if 12 <= len(number) <= 19 and luhn(number):
                    out.append((start, "card", card))
        elif kind == "@":
            if span := _email(text, start, email):
                email = span[1]
                out.append((span[0], "email", span[1]))
        elif kind == "+":
            if start >= phone and (span := _phone(text, start)):
                phone = span[1]
                if span[2]:
                    out.append((start, "phone", span[1]))
        elif kind == "url":
            if start >= url and (start == 0 or not text[start - 1].isalnum()) and (m := _URL.match(text, last + 1)):
                end = m.start() + len(m[0].rstrip(".,;:!?)]"))
                if end > last + 1:
                    url = end
                    out.append((start, "url", end))
        elif start >= account and (start == 0 or not text[start - 1].isalnum()) and (span := _account(text, last + 1)):
            account = span[1]
            out.append((span[0], "account", span[1]))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


class _One(dict):
    """Characters whose lower case has another length stay as they are."""

    def __missing__(self, code: int) -> int:
        self[code] = kept = code if len(chr(code).lower()) == 1 else 0xFFFD
        return kept


_ONE = _One()


def _row(text: str, automaton) -> tuple:
    spans = find(text, automaton)
    listed = [f"{kind}:{a}:{b}" for a, kind, b in spans]
    base = ",".join(s for s, (_, kind, _) in zip(listed, spans, strict=True) if kind in BASE)
    counts = [sum(kind == k for _, kind, _ in spans) for k in KINDS]
    return (*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(listed))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    for batch in batches:
        for part in pieces(batch, 1):
            rows = [_row(t or "", automaton) for t in part.column(1).to_pylist()]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_<kind> of each kind, base_sha256 and spans ("kind:start:end", comma-joined)."""
    python_ready(docs.sparkSession)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _scan, f"doc_id long, {counts}, base_sha256 string, spans string"
    )
