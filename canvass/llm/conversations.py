"""Repair of conversations whose turns break the role grammar, by generalised LR parsing with weighted edits.

The grammar of role initials becomes an LR automaton. A graph-structured stack reads a conversation's turns: a stack is a
chain of nodes, equal stacks are one node, and each holds its cheapest edits so far. At every turn a stack may keep the
turn (0), give it another role (3) or delete it (4), and between turns insert an empty one (3). Stacks that become
equal are merged by the least (cost, audit), the audit being the initials of the edits in order.

Faults of a turn, the first of them counts: blank (no character but space and 9 to 13), duplicate (role and text of an
earlier turn), truncated (the last such character isn't one of `.!?`). Blank and duplicate turns must be deleted; a
truncated turn that stays costs 3.

Turns of one conversation come by turn number, NULL first, then by role and text. They pass through one task as a sorted
stream: a SHA-256 of all of them has no parallel form. Held at a time are the stacks (seven at most for this grammar),
one digest per stack and the audits; texts are not. Earlier turns are found by a grouping of digests, not by a set in the task.

NULL roles and texts are one space. A NULL conversation id is a conversation, NULL turn numbers come first. A
conversation without turns, or with none left, gives zeros and an empty audit. Repeated rows are turns, and duplicates.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from canvass.llm.common import python_ready

#: Rules as (head, body); the first head is the start. Capital-free one-letter symbols are role initials.
GRAMMAR = (
    ("talk", ()),
    ("talk", ("body",)),
    ("talk", ("s", "body")),
    ("body", ("pair",)),
    ("body", ("body", "pair")),
    ("pair", ("u", "a")),
)
END = "end"
#: Roles that a turn may be given, or that an inserted turn may have.
ROLES = (b"user", b"assistant")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = (b"su", b"ua", b"au")
SPACE = b" \t\n\x0b\x0c\r"
#: Letters of an audit that are kept as one piece.
PIECE = 1024


class Stack:
    """A node of the graph-structured stack: an automaton state upon the node below; equal stacks are one object."""

    __slots__ = ("state", "below", "above", "moves")

    def __init__(self, state: int, below: Stack | None = None):
        self.state, self.below = state, below
        self.above: dict[int, Stack] = {}
        self.moves: dict[str, list[Stack]] = {}

    def push(self, state: int) -> Stack:
        if state not in self.above:
            self.above[state] = Stack(state, self)
        return self.above[state]


class Automaton:
    """The LR(0) states of a grammar; reductions are taken where the next symbol may follow the head."""

    def __init__(self, grammar=GRAMMAR):
        self.rules = [("", (grammar[0][0], END)), *grammar]
        self.heads = {head for head, _ in self.rules}
        follow = self._follow()
        first = self._closure({(0, 0)})
        states, todo = {first: 0}, [first]
        self.shifts: list[dict[str, int]] = []
        self.reductions: list[dict[str, list[int]]] = []
        while todo:
            items = todo.pop(0)
            moved: dict[str, set] = {}
            reduce: dict[str, list[int]] = {}
            for rule, dot in sorted(items):
                head, body = self.rules[rule]
                if dot < len(body):
                    moved.setdefault(body[dot], set()).add((rule, dot + 1))
                elif rule:
                    for symbol in follow[head]:
                        reduce.setdefault(symbol, []).append(rule)
            goto = {}
            for symbol, kernel in moved.items():
                target = self._closure(kernel)
                if target not in states:
                    states[target] = len(states)
                    todo.append(target)
                goto[symbol] = states[target]
            self.shifts.append(goto)
            self.reductions.append(reduce)
        self.root = Stack(0)

    def _closure(self, items: set) -> frozenset:
        found, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            for i, (head, _) in enumerate(self.rules):
                if dot < len(body) and head == body[dot] and (i, 0) not in found:
                    found.add((i, 0))
                    todo.append((i, 0))
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        """The symbols that may come after each head."""
        empty: set[str] = set()
        first = {h: set() for h in self.heads}
        follow = {h: set() for h in self.heads}

        def begins(body) -> set[str]:
            found = set()
            for symbol in body:
                found |= first.get(symbol, {symbol})
                if symbol not in empty:
                    break
            return found

        size = -1
        while size != (size := len(empty) + sum(map(len, (*first.values(), *follow.values())))):
            for head, body in self.rules:
                if all(symbol in empty for symbol in body):
                    empty.add(head)
                first[head] |= begins(body)
                for i, symbol in enumerate(body):
                    if symbol in self.heads:
                        rest = body[i + 1 :]
                        follow[symbol] |= begins(rest)
                        if all(x in empty for x in rest):
                            follow[symbol] |= follow[head]
        return follow

    def advance(self, stack: Stack, symbol: str) -> list[Stack]:
        """The stacks after `symbol`, all reductions before it done."""
        if symbol not in stack.moves:
            found, todo = [], [stack]
            while todo:
                top = todo.pop()
                if symbol in self.shifts[top.state]:
                    found.append(top.push(self.shifts[top.state][symbol]))
                for rule in self.reductions[top.state].get(symbol, ()):
                    head, body = self.rules[rule]
                    below = top
                    for _ in body:
                        below = below.below
                    todo.append(below.push(self.shifts[below.state][head]))
            stack.moves[symbol] = found
        return stack.moves[symbol]


class Audit:
    """Edit initials; the front is a chain of full pieces that other audits may share."""

    __slots__ = ("front", "tail")

    def __init__(self, front: tuple | None = None, tail: str = ""):
        self.front, self.tail = front, tail

    def __add__(self, letter: str) -> Audit:
        tail = self.tail + letter
        if len(tail) < PIECE:
            return Audit(self.front, tail)
        return Audit((self.front, tail, self.front[2] + 1 if self.front else 1), "")

    def __lt__(self, other: Audit) -> bool:
        if self.front is other.front:
            return self.tail < other.tail
        mine, theirs = self.tail, other.tail
        x, y = self.front, other.front
        while (x[2] if x else 0) > (y[2] if y else 0):
            mine, x = x[1] + mine, x[0]
        while (y[2] if y else 0) > (x[2] if x else 0):
            theirs, y = y[1] + theirs, y[0]
        less = mine < theirs
        while x is not y:
            if x[1] != y[1]:
                less = x[1] < y[1]
            x, y = x[0], y[0]
        return less

    def __str__(self) -> str:
        pieces, x = [self.tail], self.front
        while x:
            pieces.append(x[1])
            x = x[0]
        return "".join(reversed(pieces))


class Trace:
    """The cheapest edits that lead to a stack, and the digest of the turns they leave."""

    __slots__ = ("cost", "audit", "source", "turn", "digest")

    def __init__(self, cost: int, audit: Audit, source: Trace | None = None, turn: tuple[bytes, bytes] | None = None):
        self.cost, self.audit, self.source, self.turn, self.digest = cost, audit, source, turn, None

    def then(self, cost: int, letter: str, turn: tuple[bytes, bytes] | None = None) -> Trace:
        return Trace(self.cost + cost, self.audit + letter, self, turn)

    def before(self, other: Trace) -> bool:
        return self.cost < other.cost or self.cost == other.cost and self.audit < other.audit

    def settle(self) -> None:
        """Brings the digest up to this edit and lets go of what came before."""
        if self.source is not None:
            self.source.settle()
            digest, some = self.source.digest
            if self.turn is not None:
                digest = digest.copy()
                digest.update((b"\n" if some else b"") + self.turn[0] + b":" + self.turn[1])
                some = True
            self.digest, self.source, self.turn = (digest, some), None, None
        elif self.digest is None:
            self.digest = (hashlib.sha256(), False)


class Repair:
    """One conversation: its turns in order through `read`, then `best`."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.tops: dict[Stack, Trace] = {}
        self._reach(self.tops, automaton.root, Trace(0, Audit()))
        self._insert()

    @staticmethod
    def _reach(tops: dict[Stack, Trace], stack: Stack, trace: Trace) -> bool:
        if stack in tops and not trace.before(tops[stack]):
            return False
        tops[stack] = trace
        return True

    def _insert(self) -> None:
        todo = list(self.tops)
        while todo:
            stack = todo.pop()
            trace = self.tops[stack]
            for role in ROLES:
                for after in self.automaton.advance(stack, chr(role[0])):
                    if after not in self.tops or trace.cost + INSERT <= self.tops[after].cost:
                        if self._reach(self.tops, after, trace.then(INSERT, "I", (role, b""))):
                            todo.append(after)
        for trace in self.tops.values():
            trace.settle()

    def read(self, role: bytes, text: bytes, fault: str | None) -> None:
        tops: dict[Stack, Trace] = {}
        extra = TRUNCATED if fault == "truncated" else 0
        for stack, trace in self.tops.items():
            self._reach(tops, stack, trace.then(DELETE, "D"))
            if fault in ("blank", "duplicate"):
                continue
            for after in self.automaton.advance(stack, role[:1].decode("latin-1")):
                self._reach(tops, after, trace.then(extra, "K", (role, text)))
            for other in ROLES:
                for after in self.automaton.advance(stack, chr(other[0])):
                    self._reach(tops, after, trace.then(REROLE + extra, "R", (other, text)))
        self.tops = tops
        self._insert()

    def best(self) -> Trace:
        ends: dict[None, Trace] = {}
        for stack, trace in self.tops.items():
            if self.automaton.advance(stack, END):
                self._reach(ends, None, trace)
        return ends[None]


def fault_of(text: bytes, duplicate: bool) -> str | None:
    full = text.rstrip(SPACE)
    if not full:
        return "blank"
    return "duplicate" if duplicate else None if full[-1:] in (b".", b"!", b"?") else "truncated"


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
    """conv_id, turn, role, text, gone of each row; roles and texts without NULL. No turn is gone here."""
    columns = [F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn")]
    words = [F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(k) for c, k in ((role, "role"), (text, "text"))]
    return conversations.select(*columns, *words, F.lit(False).alias("gone"))


def damaged(rows: DataFrame) -> DataFrame:
    """Turns with damage, by crc32(`conv_id:turn`) % 20: 0 is gone, 1 loses its text, 2 its `.!?`, 3 comes twice, 4 is the
    user's. NULL is one space in that key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(True), F.when(F.col("kind") == 3, 2).otherwise(1)))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("gone") | (F.col("kind") == 0)).alias("gone"),
        times.alias("copy"),
    )
    return rows.drop("copy")


def _sorted(rows: DataFrame) -> DataFrame:
    """The turns as sorted streams, one conversation in one partition, with whether role and text stand at an earlier turn.

    The grouping shuffles digests only, and only groups of several turns are joined back; what is gone stays, without
    its text, so that its conversation is not lost.
    """
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    rows = rows.withColumn("digest", F.when(~F.col("gone"), digest))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    several = (
        rows.filter("not gone")
        .groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d"))
        .agg(F.count(F.lit(1)).alias("held"), F.min(order).alias("first"))
        .filter("held > 1")
        .select("c", "d", "first")
    )
    met = rows.join(several, F.expr("conv_id <=> c and digest = d"), "left")
    again = F.coalesce(F.col("first") < order, F.lit(False))
    text = F.when(~F.col("gone"), F.col("text").cast("binary"))
    met = met.select("conv_id", "turn", "gone", again.alias("again"), F.col("role").cast("binary").alias("role"), text.alias("text"))
    return met.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"
    )


class _Report:
    """Counts of one conversation and its repair."""

    def __init__(self, conv, automaton: Automaton):
        self.conv, self.repair = conv, Repair(automaton)
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last = self.low = self.high = None
        self.distinct = 0

    def read(self, turn, role: bytes, text: bytes, again: bool) -> None:
        row = (turn, role, text)
        fault = fault_of(text, again or row == self.last)
        if fault:
            self.counts[fault] += 1
        if self.last is not None and self.last[1][:1] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        if turn is not None:
            self.distinct += self.high is None or turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.last = row
        self.repair.read(role, text, fault)

    def row(self) -> tuple:
        best = self.repair.best()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, *self.counts.values(), best.cost, str(best.audit), best.digest[0].hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _reports(conv_type: pa.DataType, size: int = 2000):
    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv_id", *COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, now, done = Automaton(), None, []
        for batch in batches:
            for conv, turn, gone, again, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Report(conv, automaton)
                if not gone:
                    now.read(turn, role, text, again)
            if len(done) >= size:
                yield out(done)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield out(done)

    return run


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation of `turns` rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    gaps are turn numbers missing between the least and the greatest; illegal counts neighbours whose role initials are
    none of su, ua, au; repaired_sha256 is of the repaired turns' `role:text`, joined by line breaks.
    """
    python_ready(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COLUMNS[:6]) + ", audit string, repaired_sha256 string"
    return _sorted(rows).mapInArrow(_reports(to_arrow_type(kind)), schema)


def _applied(conv_type: pa.DataType):
    """The repaired turns of streams in which a conversation's audit comes before its turns."""
    names = ["conv_id", "place", "edit", "turn", "role", "text"]
    kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        conv = letters = stack = None
        at = place = 0

        def given(letter: str, conv, turn, role: bytes, text: bytes) -> tuple:
            nonlocal stack, place
            if letter in "IR":
                role = next(r for r in ROLES if automaton.advance(stack, chr(r[0])))
            stack = automaton.advance(stack, role[:1].decode("latin-1"))[0]
            place += 1
            return conv, place, letter, turn, role.decode(), text.decode()

        for batch in batches:
            found = []
            for conv, audit, turn, gone, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if audit is not None:
                    letters, at, place, stack = audit, 0, 0, automaton.root
                while at < len(letters) and letters[at] == "I":
                    found.append(given("I", conv, None, b"", b""))
                    at += 1
                if audit is None and not gone:
                    if letters[at] != "D":
                        found.append(given(letters[at], conv, turn, role, text))
                    at += 1
                    while at < len(letters) and letters[at] == "I":
                        found.append(given("I", conv, None, b"", b""))
                        at += 1
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 1), edit (K, R or I), turn (NULL if inserted), role, text.

    `report` is the repair_report of `rows`. Its audits meet the turns as first row of a sorted stream.
    """
    python_ready(rows.sparkSession)
    none = F.lit(None)
    turn = F.col("turn").cast("long").alias("turn")
    body = [F.col(c).cast("binary").alias(c) for c in ("role", "text")]
    first = [none.cast("long").alias("turn"), F.lit(False).alias("gone"), *[none.cast("binary").alias(c) for c in ("role", "text")]]
    streams = report.select("conv_id", "audit", *first).union(
        rows.select("conv_id", none.cast("string").alias("audit"), turn, "gone", *body)
    )
    streams = streams.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text"
    )
    kind = rows.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, place long, edit string, turn long, role string, text string"
    return streams.mapInArrow(_applied(to_arrow_type(kind)), schema)


def conversation_repair(conversations: DataFrame) -> DataFrame:
    """The report on `conversations` after damage."""
    return repair_report(damaged(turns(conversations)))
