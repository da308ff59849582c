"""Conversation repair against an exhaustive search, and against a plain dynamic programme."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from scoremill.llm import conversation_repair as C

BLANK = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def damaged_rows(conversations):
    """Rows after damage by conversation, in order."""
    out = {}
    for conv_id, turn, role, text in conversations:
        rows = out.setdefault(conv_id, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rows in out.items()}


def row_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(BLANK)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, found):
    """Forward search over (row, state) by (cost, audit); each state keeps its least."""
    nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}

    def insert(states):
        for _ in range(3):
            for state, (cost, audit, text) in list(states.items()):
                role = "user" if nexts[state] == "u" else "assistant"
                new = (cost + 5, audit + "I", [*text, f"{role}:"])
                if nexts[state] not in states or new[:2] < states[nexts[state]][:2]:
                    states[nexts[state]] = new
        return states

    states = insert({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, found, strict=True):
        after = {}

        def offer(state, option, after=after):
            if state not in after or option[:2] < after[state][:2]:
                after[state] = option

        for state, (cost, audit, lines) in states.items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] and role[0] in allowed[state]:
                offer(role[0], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            new = "user" if nexts[state] == "u" else "assistant"
            offer(new[0], (cost + more + 1, audit + "R", [*lines, f"{new}:{text}"]))
        states = insert(after)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def plain(conversations):
    out = {}
    for conv_id, rows in damaged_rows(conversations).items():
        found = row_faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = plain_repair(rows, found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [found.count(kind) for kind in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def exhaustive(roles, found):
    """Least cost and audit of all edit sequences with at most two inserts at a place."""
    best = None
    for edits in product("KRD", repeat=len(roles)):
        if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, found, strict=True)):
            continue
        for inserts in product(range(3), repeat=len(roles) + 1):
            audit = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""], strict=True))
            cost = 5 * sum(inserts) + sum({"K": 0, "R": 1, "D": 2}[e] for e in edits)
            cost += sum(5 for e, f in zip(edits, found, strict=True) if e != "D" and f == "truncated")
            if best is not None and (cost, audit) >= best:
                continue
            free = [i for i, e in enumerate(audit) if e in "RI"]
            kept = iter([r for r, e in zip(roles, edits, strict=True) if e == "K"])
            shape = [next(kept) if e == "K" else "?" for e in audit if e != "D"]
            wild = [i for i, x in enumerate(shape) if x == "?"]
            assert len(wild) == len(free)
            for choice in product("ua", repeat=len(wild)):
                for i, x in zip(wild, choice, strict=True):
                    shape[i] = x
                if GRAMMAR.match("".join(shape)):
                    best = (cost, audit)
                    break
    return best


def made(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")


def result(spark, rows):
    conversations = made(spark, [(*r, "x") for r in rows])
    found = C.repair(C.damage(conversations), conversations).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r)[1:] for r in found}


TEXTS = ["Fine.", "Fine?", "cut off", "", " \t\n", "Fine!  \n", None, "x" * 500 + ".", "ends with é", "."]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "sys"]


def drawn(draw, conv_id, n):
    turns = [draw.choice([i, i, i, i + 1, None]) for i in range(n)]
    return [(conv_id, t, draw.choice(ROLES), draw.choice(TEXTS)) for t in turns]


def test_tables_equal_an_exhaustive_search():
    draw = random.Random(1)
    for _ in range(120):
        n = draw.randrange(5)
        roles = [draw.choice("suao") for _ in range(n)]
        found = [draw.choice(["", "", "blank", "duplicate", "truncated"]) for _ in range(n)]
        signs = ["X" if f in ("blank", "duplicate") else r.upper() if f else r for r, f in zip(roles, found, strict=True)]
        whole = C.NOTHING
        for sign in reversed(signs):
            whole = C.node(sign, whole)
        assert C.ended(whole) == exhaustive(roles, found), signs


def test_tables_join_like_the_signs():
    draw = random.Random(2)
    for _ in range(200):
        signs = draw.choices("suaoSUAOX", k=draw.randrange(1, 14))
        at = draw.randrange(len(signs))

        def of(some):
            whole = C.NOTHING
            for sign in reversed(some):
                whole = C.node(sign, whole)
            return whole

        assert C.joined(of(signs[:at]), of(signs[at:])) == of(signs)
        assert C.unpack(C.pack(of(signs))) == of(signs)


def test_conversations_with_all_faults(spark):
    draw = random.Random(3)
    rows = [row for conv_id in range(250) for row in drawn(draw, conv_id, draw.randrange(1, 12))]
    rows += drawn(draw, None, 20) + [(900, 0, "user", "Only."), *[(901, 1, "user", "Same.")] * 5]
    draw.shuffle(rows)
    assert result(spark, rows) == plain(rows)


@pytest.mark.parametrize("block, fold", [(3, 2), (8, 4)])
def test_long_conversations_in_blocks(spark, monkeypatch, block, fold):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "FOLD", fold)
    draw = random.Random(block)
    rows = [row for conv_id in range(8) for row in drawn(draw, conv_id, draw.choice([1, 9, 70, 400]))]
    rows += [(50, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(700)]
    rows += [(51, 0, "user", "Hot.")] * 300
    draw.shuffle(rows)
    assert result(spark, rows) == plain(rows)


def test_no_rows_and_rows_all_dropped(spark):
    assert result(spark, []) == {}
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert result(spark, [(dropped, 0, "user", "Gone.")]) == {dropped: nothing}


def test_repaired_rows_follow_the_grammar(spark):
    draw = random.Random(5)
    conversations = made(spark, [(*row, "x") for i in range(60) for row in drawn(draw, i, 7)])
    rows = C.faults(C.damage(conversations))
    fixed = C.repaired_rows(rows, C.audits(C.blocks(rows))).collect()
    by_conv = {}
    for row in sorted(fixed, key=lambda r: (r["conv_id"], r["turn"])):
        by_conv.setdefault(row["conv_id"], []).append(row["role"][0])
    assert by_conv and all(GRAMMAR.match("".join(x)) for x in by_conv.values())


def test_query_over_the_given_conversations(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in C.op13_conversation_repair(spark, data).collect()}
    assert found == plain([tuple(r) for r in rows])
