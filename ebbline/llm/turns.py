"""Conversations whose roles break their grammar, repaired at the least cost by generalised LR parsing.

The role grammar is turned into an LR table. A row may be kept, given another role or
deleted, and a turn may be inserted anywhere; each choice is one more way to go on, so a
parse holds many stacks. Stacks are nodes that share what lies below them. Parses whose
stack tops are equal go on alike, and of them only the one of the least (cost, audit)
stays; an audit is the initials of the edits in order. Two audits of one place, stack
and cost are never one the beginning of the other (it would have cost less), so what is
least so far stays least whatever follows.

Rows are dealt over tasks by ranges of (conversation, turn, role, text), so a
conversation that holds a large part of all rows lies over many tasks; equal rows are one
row with a count. A task settles the conversations that it holds whole. Of others it
hands on segments, each with the least (cost, audit) from every stack that may stand at
its beginning to every one at its end. Segments are put together in order, and the
repaired text of each is then written where its rows are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import small, small_batches
from ebbline.session import store

# Fixed values: (s?(ua)+)? over the initials of roles, and what edits cost.
GRAMMAR = [("C", ""), ("C", "sP"), ("C", "P"), ("P", "PX"), ("P", "X"), ("X", "ua")]
START = "C"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\v\f\r"

# Rows and characters of a segment of a conversation that lies over several tasks.
SEGMENT_ROWS = 4096
SEGMENT_CHARS = 1 << 22
# Conversations a task remembers by the signs of their rows; more change nothing but time.
REMEMBERED = 50_000

DELETED, OTHER = "x", "o"  # signs of rows: x, or the initial, in upper case if truncated

SEGMENTS = (
    "conv_id {kind}, whole boolean, seq bigint, least array<struct<entry:int,exit:int,cost:bigint,audit:string>>, signs string, roles array<string>, texts array<string>, "
    "rows bigint, first_turn bigint, last_turn bigint, turns bigint, first_role string, last_role string, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
COUNTS = ["blank", "duplicate", "truncated", "illegal"]
TURNS = ["rows", "first_turn", "last_turn", "turns", "first_role", "last_role"]


class Parser:
    """An SLR table of the grammar and the stacks that it can come to.

    The grammar is left-recursive and nothing in it nests, so stacks are finitely many.
    """

    def __init__(self, grammar: list[tuple[str, str]] = GRAMMAR, start: str = START):
        self.rules = [("^", start), *grammar]
        self.heads = {head for head, _ in self.rules}
        self.signs = sorted({c for _, body in grammar for c in body} - self.heads)
        self._follow()
        self.states = [self._closed({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for k, state in enumerate(self.states):  # grows while it is walked
            for c in {self.rules[r][1][at] for r, at in state if at < len(self.rules[r][1])}:
                onward = self._closed({(r, at + 1) for r, at in state if self.rules[r][1][at : at + 1] == c})
                if onward not in self.states:
                    self.states.append(onward)
                self.goto[k, c] = self.states.index(onward)
        # Stacks: the state on top and the stack below it. All that signs lead to.
        self.stacks: list[tuple[int, int]] = [(0, -1)]
        self.after: list[dict[str, int]] = []
        for top in range(1 << 16):
            if top == len(self.stacks):
                break
            self.after.append({c: onward for c in self.signs if (onward := self._shift(top, c)) is not None})
        reached = [0]
        for top in reached:  # grows while it is walked
            reached += [n for n in self.after[top].values() if n not in reached]
        self.reached = sorted(reached)
        self.accepts = [self._accepts(top) for top in range(len(self.after))]
        self.given = [{c: n for c, n in onward.items() if c in ROLES} for onward in self.after]
        if any(len(g) > 1 for g in self.given):
            raise ValueError("an edit has to determine its role")

    def _closed(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        while True:
            heads = {self.rules[r][1][at] for r, at in items if at < len(self.rules[r][1])}
            more = {(r, 0) for r, (head, _) in enumerate(self.rules) if head in heads} | items
            if more == items:
                return frozenset(items)
            items = more

    def _follow(self) -> None:
        empty = {head for head, body in self.rules if not body}
        while any(head not in empty and all(c in empty for c in body) for head, body in self.rules):
            empty |= {head for head, body in self.rules if all(c in empty for c in body)}
        first: dict[str, set[str]] = {c: {c} for _, body in self.rules for c in body if c not in self.heads} | {h: set() for h in self.heads}
        self.follow: dict[str, set[str]] = {h: {"$"} if h == "^" else set() for h in self.heads}
        for _ in range(2 * len(self.rules) ** 2):  # enough rounds to come to rest
            for head, body in self.rules:
                ahead, behind = set(), set(self.follow[head])
                for c in body:
                    ahead |= first[c]
                    if c not in empty:
                        break
                first[head] |= ahead
                for c in reversed(body):
                    if c in self.heads:
                        self.follow[c] |= behind
                    behind = behind | first[c] if c in empty else set(first[c])

    def _stack(self, state: int, below: int) -> int:
        if (state, below) not in self.stacks:
            self.stacks.append((state, below))
        return self.stacks.index((state, below))

    def _reduced(self, top: int, ahead: str | None) -> int:
        """The stack after every reduction that the next sign asks for, or, without one, that nothing else contends with."""
        while True:
            state = self.states[self.stacks[top][0]]
            rules = [r for r, at in state if at == len(self.rules[r][1]) and r and (ahead is None and len(state) == 1 or ahead in self.follow[self.rules[r][0]])]
            if not rules:
                return top
            head, body = self.rules[rules[0]]
            for _ in body:
                top = self.stacks[top][1]
            top = self._stack(self.goto[self.stacks[top][0], head], top)

    def _shift(self, top: int, sign: str) -> int | None:
        top = self._reduced(top, sign)
        state = self.goto.get((self.stacks[top][0], sign))
        return None if state is None else self._reduced(self._stack(state, top), None)

    def _accepts(self, top: int) -> bool:
        return (0, 1) in self.states[self.stacks[self._reduced(top, "$")][0]]


Tops = dict[int, tuple[int, str]]


@dataclass
class Repair:
    """Least edits of the rows of a conversation, or of a segment of one."""

    parser: Parser = field(default_factory=Parser)
    known: dict[str, tuple[int, str]] = field(default_factory=dict)

    def inserted(self, tops: Tops) -> Tops:
        """With every turn that may be put in here."""
        todo = list(tops)
        while todo:
            top = todo.pop()
            cost, audit = tops[top]
            for onward in self.parser.given[top].values():
                more = cost + INSERT, audit + "I"
                if onward not in tops or more < tops[onward]:
                    tops[onward] = more
                    todo.append(onward)
        return tops

    def run(self, tops: Tops, signs: str) -> Tops:
        """The least (cost, audit) of every stack top after the rows of these signs."""
        for sign in signs:
            after: Tops = {}
            role = sign.lower()
            extra = TRUNCATED if sign != role else 0
            for top, (cost, audit) in self.inserted(tops).items():
                ways = [(top, (cost + DELETE, audit + "D"))]
                if sign != DELETED:
                    onward = self.parser.after[top].get(role)
                    if onward is not None:
                        ways.append((onward, (cost + KEEP + extra, audit + "K")))
                    ways += [(onward, (cost + REROLE + extra, audit + "R")) for onward in self.parser.given[top].values()]
                for onward, more in ways:
                    if onward not in after or more < after[onward]:
                        after[onward] = more
            tops = after
        return tops

    def accepted(self, tops: Tops) -> tuple[int, int, str]:
        """(cost, audit) of the least that may end here, and the stack that its rows end at."""
        return min((*self.inserted({top: least}).get(end, (1 << 62, "")), top) for top, least in tops.items() for end, ok in enumerate(self.parser.accepts) if ok)

    def whole(self, signs: str) -> tuple[int, str]:
        found = self.known.get(signs)
        if found is None:
            cost, audit, _ = self.accepted(self.run({0: (0, "")}, signs))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[signs] = cost, audit
        return found

    def table(self, signs: str) -> list[dict]:
        """The least (cost, audit) from every stack to every stack over these rows."""
        return [
            {"entry": entry, "exit": end, "cost": cost, "audit": audit}
            for entry in self.parser.reached
            for end, (cost, audit) in self.run({entry: (0, "")}, signs).items()
        ]

    def written(self, audit: str, signs: str, roles: list[str], texts: list[str], top: int = 0) -> list[str]:
        """The lines `role:text` that the edits leave, from a stack on."""
        out, rows, kept = [], iter(signs), zip(roles, texts)
        for edit in audit:
            if edit == "I":
                (sign, top), = self.parser.given[top].items()
                out.append(f"{ROLES[sign]}:")
                continue
            sign = next(rows)
            role, text = next(kept) if sign != DELETED else ("", "")
            if edit == "K":
                top = self.parser.after[top][sign.lower()]
                out.append(f"{role}:{text}")
            elif edit == "R":
                (sign, top), = self.parser.given[top].items()
                out.append(f"{ROLES[sign]}:{text}")
        return out


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of conversations damaged by the checksum of `conv_id:turn`.

    Null roles, texts and parts of the checksummed key are one space. Of a conversation's
    dropped rows one without copies stays, so that the conversation is known.
    """
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = rows.select(F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"), blank(F.col("role")).alias("role"), blank(F.col("text")).alias("text"))
    kind = F.crc32(F.concat(blank(F.col("conv_id")), F.lit(":"), blank(F.col("turn")))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    gone = lambda c, there: F.when(kind != 0, there).alias(c)
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies")
    return rows.select("conv_id", gone("turn", F.col("turn")), gone("role", role), gone("text", text), copies)


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Faults, least edits and the repaired text of every conversation.

    Takes conv_id, turn, role, text and copies, the number of equal rows (0: a mark
    without a row). Rows are in the order of turn, nulls first, then role and text. Rows of
    null conv_id are one conversation. One row per conv_id; an empty table has none.
    """
    small_batches(rows.sparkSession)
    keys = ["conv_id", "turn", "role", "text"]
    kind = rows.schema["conv_id"].dataType.simpleString()
    when = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn").alias("turn"))
    said = [F.xxhash64("role", "text").alias("key1"), F.xxhash64(F.lit("text"), "text", "role").alias("key2")]

    # What one conversation says in several turns, and in which of them first.
    turns = rows.filter("copies > 0").select("conv_id", *said, when.alias("at")).groupBy("conv_id", "key1", "key2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    again = turns.filter("first <> last").select(F.col("conv_id").alias("of"), F.col("key1").alias("same1"), F.col("key2").alias("same2"), "first")
    merged = rows.groupBy(*keys).agg(F.sum("copies").alias("copies")).select("*", *said)
    joined = merged.join(small(again), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key1") == F.col("same1")) & (F.col("key2") == F.col("same2")), "left")
    marked = joined.select(*keys, "copies", F.coalesce(when > F.col("first"), F.lit(False)).alias("seen"), *_faults())
    order = [F.asc_nulls_first(c) for c in keys]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    done = store(dealt.mapInArrow(partial(_settle, limit=segment_rows), SEGMENTS.format(kind=kind)))

    whole = done.filter("whole").select("conv_id", _gaps().alias("gaps"), *RESULT[2:])
    parts = done.filter("NOT whole")
    slim = parts.select("conv_id", "seq", "least", *TURNS, *COUNTS)
    ends = f"{', '.join(f'{c} bigint' for c in ['gaps', *COUNTS, 'cost'])}, audit string"
    chosen = store(_by_conversation(slim).mapInArrow(_put_together, f"at bigint, entry int, passed string, {ends}"))
    texts = parts.select("conv_id", "seq", "signs", "roles", "texts").join(chosen, F.col("seq") == F.col("at")).drop("at")
    written = texts.mapInArrow(_write, f"conv_id {kind}, seq bigint, lines bigint, repaired string, {ends}")
    return whole.unionByName(_by_conversation(written).mapInArrow(_digest, f"conv_id {kind}, {ends}, repaired_sha256 string").select(*RESULT))


def _faults() -> list[Column]:
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    return [(trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated")]


def _gaps() -> Column:
    return F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))


def _by_conversation(segments: DataFrame) -> DataFrame:
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq")


class _Open:
    """A conversation, or a segment of one, while its rows are read."""

    def __init__(self, conv: object):
        self.conv, self.parts = conv, 0
        self.clear()

    def clear(self) -> None:
        self.signs: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.initials: list[str] = []
        self.turns: list[int] = []
        self.blank = self.duplicate = self.truncated = self.chars = 0

    def add(self, turn: int | None, role: str, text: str, seen: bool, blank: bool, truncated: bool) -> None:
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        initial = role[:1]
        self.initials.append(initial)
        if blank or seen:
            self.blank += blank
            self.duplicate += not blank
            self.signs.append(DELETED)
            return
        self.truncated += truncated
        sign = initial if initial in ("s", "u", "a") else OTHER
        self.signs.append(sign.upper() if truncated else sign)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def close(self, repair: Repair, whole: bool, seq: int) -> dict:
        signs = "".join(self.signs)
        row = {
            "conv_id": self.conv, "whole": whole, "seq": seq, "rows": len(signs), "turns": len(self.turns),
            "first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None,
            "first_role": self.initials[0] if signs else None, "last_role": self.initials[-1] if signs else None,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": sum(a + b not in LEGAL for a, b in pairwise(self.initials)),
        }
        if whole:
            row["cost"], row["audit"] = repair.whole(signs)
            lines = repair.written(row["audit"], signs, self.roles, self.texts)
            row["repaired_sha256"] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        else:
            row |= {"least": repair.table(signs), "signs": signs, "roles": self.roles, "texts": self.texts}
        self.parts += 1
        self.clear()
        return row


WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
SETTLED = [
    pa.field(name, kind)
    for kind, names in [
        (pa.bool_(), "whole"), (pa.int64(), "seq"), (WAYS, "least"), (pa.string(), "signs"), (pa.list_(pa.string()), "roles texts"),
        (pa.int64(), "rows first_turn last_turn turns"), (pa.string(), "first_role last_role"),
        (pa.int64(), "blank duplicate truncated illegal cost"), (pa.string(), "audit repaired_sha256"),
    ]
    for name in names.split()
]


def _settle(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows in order to whole conversations; the first and the last of a task, and long ones, to segments."""
    repair, seq, open_, first, out = Repair(), TaskContext.get().partitionId() << 32, None, True, []
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv_id"), *SETTLED])
        for row in batch.to_pylist():
            if open_ is None or row["conv_id"] != open_.conv:
                if open_ is not None:
                    out.append(open_.close(repair, not first and not open_.parts, seq))
                    seq, first = seq + 1, False
                open_ = _Open(row["conv_id"])
            for copy in range(row["copies"]):
                if len(open_.signs) >= limit or open_.chars >= SEGMENT_CHARS:
                    out.append(open_.close(repair, False, seq))
                    seq += 1
                open_.add(row["turn"], row["role"], row["text"], row["seen"] or copy > 0, row["blank"], row["truncated"])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if open_ is not None:
        yield pa.RecordBatch.from_pylist([open_.close(repair, False, seq)], schema)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bool, pa.Field]]:
    """Segments in order, each with whether its conversation ends with it and the field of its key."""
    held = None
    for batch in batches:
        key = batch.schema.field("conv_id")
        for row in batch.to_pylist():
            if held is not None:
                yield held, row["conv_id"] != held["conv_id"], key
            held = row
    if held is not None:
        yield held, True, key


ENDS = [pa.field(c, pa.int64()) for c in ["gaps", *COUNTS, "cost"]] + [pa.field("audit", pa.string())]


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every segment the stack that it begins with and its edits; for the last also the whole's figures."""
    schema = pa.schema([("at", pa.int64()), ("entry", pa.int32()), ("passed", pa.string()), *ENDS])
    repair = Repair()
    tops: Tops = {0: (0, "")}
    steps: list[tuple[int, dict[int, tuple[int, str]]]] = []  # per segment: for each end the beginning and the edits
    sums, turns, last_role, last_turn = dict.fromkeys(COUNTS, 0), 0, None, None
    first_turn = None
    for row, ends, _ in _conversations(batches):
        after: Tops = {}
        came: dict[int, tuple[int, str]] = {}
        for way in row["least"]:
            if way["entry"] in tops:
                cost, audit = tops[way["entry"]]
                more = cost + way["cost"], audit + way["audit"]
                if way["exit"] not in after or more < after[way["exit"]]:
                    after[way["exit"]], came[way["exit"]] = more, (way["entry"], way["audit"])
        tops = after
        steps.append((row["seq"], came))
        sums = {c: sums[c] + row[c] for c in COUNTS}
        if row["rows"]:
            sums["illegal"] += last_role is not None and last_role + row["first_role"] not in LEGAL
            last_role = row["last_role"]
        if row["turns"]:
            turns += row["turns"] - (last_turn == row["first_turn"])
            first_turn, last_turn = row["first_turn"] if first_turn is None else first_turn, row["last_turn"]
        if ends:
            cost, audit, top = repair.accepted(tops)
            rest = audit[len(tops[top][1]) :]
            out = [{"gaps": 0 if first_turn is None else last_turn - first_turn + 1 - turns, **sums, "cost": cost, "audit": audit}]
            for k, (seq, came) in enumerate(reversed(steps)):
                top, passed = came[top]
                out[-1] |= {"at": seq, "entry": top, "passed": passed + (rest if k == 0 else "")}
                out.append({})
            for low in range(0, len(out) - 1, 256):
                yield pa.RecordBatch.from_pylist(out[: len(out) - 1][low : low + 256], schema)
            tops, steps = {0: (0, "")}, []
            sums, turns, last_role, last_turn, first_turn = dict.fromkeys(COUNTS, 0), 0, None, None, None


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    repair = Repair()
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv_id"), ("seq", pa.int64()), ("lines", pa.int64()), ("repaired", pa.string()), *ENDS])
        out = []
        for row in batch.to_pylist():
            lines = repair.written(row["passed"], row["signs"], row["roles"], row["texts"], row["entry"])
            out.append({f.name: row.get(f.name) for f in schema} | {"lines": len(lines), "repaired": "\n".join(lines)})
        yield pa.RecordBatch.from_pylist(out, schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of a conversation's lines, segment by segment."""
    said, lines = hashlib.sha256(), 0
    for row, ends, key in _conversations(batches):
        said.update(("\n" if lines and row["lines"] else "").encode() + row["repaired"].encode())
        lines += row["lines"]
        if ends:
            schema = pa.schema([key, *ENDS, ("repaired_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist([{f.name: row.get(f.name) for f in schema} | {"repaired_sha256": said.hexdigest()}], schema)
            said, lines = hashlib.sha256(), 0
