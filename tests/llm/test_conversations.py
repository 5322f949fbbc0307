"""Conversation repair against an exhaustive search of edits."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from canvass.llm import conversations as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def legal(roles: str) -> bool:
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def plain(rows):
    """Cheapest edits by best-first search over whole edit lists."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        full = text.strip(SPACE)
        faults.append("blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else None)
        seen.add((role, text))
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, left = heapq.heappop(heap)
        roles = "".join((r[0][:1] or "?") for r in left)
        if at == len(rows) and legal(roles):
            break
        if (at, roles[-2:], len(left) == 0, roles[:1]) in done:
            continue
        done.add((at, roles[-2:], len(left) == 0, roles[:1]))
        want = "su" if not roles else "u" if roles[-1] in "sa" else "a"
        for name in ("user", "assistant"):
            if name[0] in want:
                heapq.heappush(heap, (cost + 3, audit + "I", at, left + ((name, ""),)))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, left))
            if faults[at] in (None, "truncated"):
                extra = 3 if faults[at] else 0
                if role[:1] and role[:1] in want:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, left + ((role, text),)))
                for name in ("user", "assistant"):
                    if name[0] in want:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, left + ((name, text),)))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    text = "\n".join(f"{r}:{t}" for r, t in left)
    return (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), list(left)


def expected(rows, hurt=damage):
    by = defaultdict(list)
    for r in rows:
        by[r[0]] += []
    for r in hurt(rows):
        by[r[0]].append(r)
    return {k: plain(v)[0] for k, v in by.items()}


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def invented():
    rng = random.Random(5)
    rows = []
    for conv in range(300):
        kept = []
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "ux"])
            text = rng.choice(["Yes.", "No!", "so", "  ", "", None, "a?\n", "é.", "x" + str(turn) + "."])
            kept.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
        rows += kept + ([kept[0]] if conv % 7 == 0 else [])
    return rows + [(None, i, ["user", "assistant"][i % 2], f"n{i}.") for i in range(5)]


def test_against_search(spark, invented):
    df = spark.createDataFrame(invented, SCHEMA).repartition(5)
    found = c.conversation_repair(df)
    assert found.count() == len({r[0] for r in invented})
    assert got(found) == expected(invented)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(c.conversation_repair(df)) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_repaired_turns_agree_with_their_digest(spark, invented):
    df = spark.createDataFrame(invented, SCHEMA).repartition(3)
    rows = c.damaged(c.turns(df))
    report = c.repair_report(rows)
    by = defaultdict(list)
    for r in sorted(c.repaired_turns(rows, report).collect(), key=lambda r: (r.conv_id or -1, r.place)):
        by[r.conv_id].append(r)
    for r in report.collect():
        left = by[r.conv_id]
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in left).encode()).hexdigest() == r.repaired_sha256
        assert "".join(x.edit for x in left) == r.audit.replace("D", "")
        assert legal("".join(x.role[:1] for x in left))
        assert all((x.turn is None and x.text == "") for x in left if x.edit == "I")


def test_conversations_without_turns(spark):
    dropped = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)
    zero = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(c.conversation_repair(df)) == {dropped: zero}
    assert c.conversation_repair(df.limit(0)).collect() == []


def test_long_conversation_shares_pieces(spark, monkeypatch):
    """Turns all of one role: audits that part early stay comparable over many pieces."""
    monkeypatch.setattr(c, "PIECE", 8)
    rows = [(1, i, "user", f"t{i}.") for i in range(61)]
    automaton = c.Automaton()
    report = c._Report(1, automaton)
    for _, turn, role, text in rows:
        report.read(turn, role.encode(), text.encode(), False)
    assert report.row()[1:] == plain(rows)[0]
    assert len(report.repair.tops) <= 8


def test_extra_columns(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "Hi.", "x", "y", "z")], SCHEMA + ", digest string, gone string, first string"
    )
    assert list(got(c.repair_report(c.turns(df)))) == [1]


def test_audit_order():
    letters = ["", "D", "DK", "K" * 2000, "K" * 1024 + "D", "K" * 1024, "KKD", "K" * 3000 + "I"]
    built = []
    for s in letters:
        a = c.Audit()
        for x in s:
            a = a + x
        built.append(a)
    for s, a in zip(letters, built, strict=True):
        assert str(a) == s
        for t, b in zip(letters, built, strict=True):
            assert (a < b) == (s < t)
