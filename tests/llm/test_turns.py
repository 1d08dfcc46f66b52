"""Repairs of conversations against every sequence of edits tried out, and against segments of any length."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from ebbline.llm import catalog, turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, signs string, key1 int"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    """The contract said once more, a row at a time."""
    out = []
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        role, text = said(role), said(text)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def brute(rows):
    """gaps, faults, least edits and lines of one conversation by trying every edit."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        last = BLANK.findall(text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    ways = {"": (0, "", ())}  # by output so far: least (cost, audit, lines)
    # All outputs are told apart, unless there are too many rows for that.
    short = (lambda said: re.sub("(ua)+", "ua", said)) if len(rows) > 30 else str

    def put_in(ways):
        out = dict(ways)
        for many in (1, 2):
            for roles in product("ua", repeat=many):
                for said, (cost, audit, lines) in ways.items():
                    name = short(said + "".join(roles))
                    if re.fullmatch("s?(ua)*u?", name):
                        more = (cost + 3 * many, audit + "I" * many, lines + tuple({"u": "user:", "a": "assistant:"}[r] for r in roles))
                        if name not in out or more[:2] < out[name][:2]:
                            out[name] = more
        return out

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        extra = 3 * (fault == "truncated")
        for said, (cost, audit, lines) in put_in(ways).items():
            options = [(said, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                options.append((said + (role[:1] or "-"), (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                options += [(said + r, (cost + 3 + extra, audit + "R", (*lines, f"{full}:{text}"))) for r, full in (("u", "user"), ("a", "assistant"))]
            for name, more in options:
                name = short(name)
                if re.fullmatch("s?(ua)*u?", name) and (name not in after or more[:2] < after[name][:2]):
                    after[name] = more
        ways = after
    cost, audit, lines = min(w for name, w in put_in(ways).items() if re.fullmatch("(s?(ua)+)?", name))
    known = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def expected(rows):
    left = {}
    for row in damage(rows):
        left.setdefault(row[0], []).append(row)
    return {conv: brute(left.get(conv, [])) for conv in {r[0] for r in rows}}


def found(df):
    got = [tuple(r) for r in df.select(*turns.RESULT).collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def drawn(seed, conversations, longest):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "alien", "s"]
    texts = ["yes.", "no!", "cut off", "cut off", " \n", None, "", "so?  \n", "x" * 50 + ".", "."]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(draw.randrange(1, longest)):
            plain = draw.random() < 0.5
            role = ("user", "assistant")[turn % 2] if plain else draw.choice(roles)
            rows.append((conv, draw.choice([turn, turn, turn + 3, None]), role, f"{conv} {turn}." if plain else draw.choice(texts)))
    return rows


@pytest.mark.parametrize(("seed", "conversations", "longest", "limit"), [(1, 150, 12, 4096), (2, 60, 9, 2), (3, 4, 120, 7)])
def test_equals_every_edit_tried(spark, seed, conversations, longest, limit):
    rows = drawn(seed, conversations, longest)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    assert found(turns.repair(turns.damaged(df), limit)) == expected(rows)


def test_one_conversation_over_many_tasks(spark):
    """A conversation with most of the rows is dealt over tasks, whatever the limit of a segment."""
    rows = [(7, t, ("user", "assistant", "user", "system")[t % 4 if t % 11 else 2], f"{t % 300}.") for t in range(1500)] + [(8, 1, "user", "Hi.")] * 300
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    assert found(turns.repair(turns.damaged(df), 100)) == expected(rows)


def test_stacks_are_those_of_the_grammar():
    parser = turns.Parser()
    for n in range(7):
        for said in map("".join, product("sua", repeat=n)):
            top = 0
            for c in said:
                top = parser.after[top].get(c) if top is not None else None
            assert (top is not None and parser.accepts[top]) == bool(re.fullmatch("(s?(ua)+)?", said))


def test_dropped_whole_and_no_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.", "", 1)], SCHEMA)
    assert found(turns.repair(turns.damaged(df))) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert turns.repair(turns.damaged(df.limit(0))).collect() == []


def test_conversations_named_by_text(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "user", "You?"), ("b", 1, "assistant", "No")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert found(turns.repair(turns.damaged(df))) == expected(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(catalog.QUERIES["op13_turns"](spark, "/root/testdata/sf0.001")) == expected(rows)
