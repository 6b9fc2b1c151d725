"""Conversation repair against a search of all edit sequences."""

import hashlib
import heapq
import os
import random
import re
import zlib
from itertools import product

import pytest

from amity.llm import conversations as C

ROWS = "conv_id bigint, turn bigint, role string, text string, Audit string, plan int"
GRAMMAR = re.compile("(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """The first fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        chars = BLANK.findall(text)
        if not chars:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if chars[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired): a best-first search over edits, by (cost, audit)."""
    marks = faults(rows)
    names = {"u": "user", "a": "assistant"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, made = heapq.heappop(heap)
        if at == len(rows) and GRAMMAR.fullmatch(roles):
            return cost, audit, made
        state = (at, roles[-1:])
        if state in seen:
            continue
        seen.add(state)

        def push(extra, letter, step, more, row):
            new = roles + more
            if not more or re.fullmatch("s?(ua)*u?", new):
                heapq.heappush(heap, (cost + extra, audit + letter, at + step, new, made + row))

        for r in "ua":
            push(2, "I", 0, r, ((names[r], ""),))
        if at < len(rows):
            role, text = rows[at]
            push(3, "D", 1, "", ())
            if marks[at] not in ("blank", "duplicate"):
                more = int(marks[at] == "truncated")
                push(more, "K", 1, role[:1] or "?", ((role, text),))
                for r in "ua":
                    push(2 + more, "R", 1, r, ((names[r], text),))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = [" " if v is None else v for v in (role, text)]
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(original, changed, ties):
    """Rows by conv_id; ``ties`` orders (role, text) within a turn."""
    out = {}
    for conv in {r[0] for r in original}:
        rows = sorted((r for r in changed if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, ties(r[2], r[3])))
        known = [r[1] for r in rows if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [(r[2], r[3]) for r in rows]
        marks = faults(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, made = cheapest(pairs)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def by_hash(spark, rows):
    """The documented order of rows within a turn."""
    pairs = sorted({(r[2], r[3]) for r in rows})
    df = spark.createDataFrame(pairs, "role string, text string").select("role", "text", *C._hashes())
    known = {(r.role, r.text): (r.role, r.h1, r.h2) for r in df.collect()}
    return lambda role, text: known[role, text]


@pytest.mark.parametrize("size", range(6))
def test_automaton_finds_the_least_audit(size):
    texts = {"c": "Fine %d.", "t": "cut %d", "x": ""}
    automaton, words = C.Automaton(), {}
    for kinds in product([r + k for r in "suaz" for k in "ctx"], repeat=size) if size < 4 else \
            [tuple(random.Random(i).choices([r + k for r in "suaz" for k in "ctx"], k=size + i % 5)) for i in range(300)]:
        rows = [({"s": "system", "u": "user", "a": "assistant", "z": "tool"}[k[0]], texts[k[1]] % i if k[1] != "x" else "")
                for i, k in enumerate(kinds)]
        symbol = {"c": str.lower, "t": str.upper, "x": lambda c: str("suao".index(c) + 1)}
        words["".join(symbol[k[1]](k[0] if k[0] != "z" else "o") for k in kinds)] = rows
    for word in sorted(words, key=lambda w: w[::-1]):
        cost, illegal, audit = automaton.read(word)
        assert (cost, audit) == cheapest(words[word])[:2], word
        roles = [r[0][0] for r in words[word]]
        assert illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        assert [(r, t) for _, r, t in C.apply_audit(audit, words[word])] == list(cheapest(words[word])[2])
    suffixes = {w[i:] for w in words for i in range(len(w))}
    assert automaton.made == len(suffixes)  # a node for each suffix, made once
    assert automaton.worked_out <= 12 * len(automaton.unique)


def make_rows():
    rnd = random.Random(7)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "umpire"]
    texts = ["Yes.", "No!", "why?", "cut off", " \t", "", None, "Fine. ", "Done?\n", "é…", "x" * 5000 + "."]
    rows = []
    for conv in range(120):
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, turn * 2, None, -3]), rnd.choice(roles), rnd.choice(texts)))
    rows += [(None, t, rnd.choice(roles), rnd.choice(texts)) for t in (0, 1, 2, None, 1)]
    rows += [(1000, None, "user", "no turn."), (1000, None, "assistant", "none.")]
    rows += [(1001, t, "user", "same.") for t in (0, 0, 1, 2)] + [(1002, 2 ** 62, "user", "far."), (1002, -5, "assistant", "near.")]
    dropped = next(c for c in range(2000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "This row goes.")], dropped


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(3)
    given = C.turns(df)
    found = C.damaged(given)
    out = C.repaired_digests(found, C.repair_plan(found, given.select("conv_id")))
    got = {r.conv_id: tuple(r)[1:] for r in out.collect()}
    assert out.columns == [*C.PLAN, "repaired_sha256"]
    return got


def test_query_equals_search(spark):
    rows, dropped = make_rows()
    changed = damage(rows)
    got = run(spark, rows)
    assert got == expected(rows, changed, by_hash(spark, changed))
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_small_pieces_and_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 2)
    rows, _ = make_rows()
    rows += [(3000, t, "assistant" if t % 2 else "user", f"turn {t}.") for t in range(400)]
    rows += [(3001, t // 50, "user", "again.") for t in range(900)]
    got, changed = run(spark, rows), damage(rows)
    assert got == expected(rows, changed, by_hash(spark, changed))
    mine = [r for r in changed if r[0] == 3001]
    assert got[3001][2] == sum(bool(r[3].strip()) for r in mine) - 1
    df = C.damaged(C.turns(spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)))
    by_conv = {}
    for r in sorted(C.repaired_turns(df, C.repair_plan(df)).collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.place)):
        by_conv.setdefault(r.conv_id, []).append(r)
    for conv, turns in by_conv.items():
        assert GRAMMAR.fullmatch("".join(r.role[0] for r in turns)) and [r.place for r in turns] == list(range(len(turns)))
        assert [r.edit for r in turns] == [x for x in got[conv][6] if x != "D"]
        text = "\n".join(f"{r.role}:{r.text}" for r in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == got[conv][7]
    ordered = [(t, r, x) for c, t, r, x in sorted((r for r in changed if r[0] == 3000), key=lambda r: r[1])]
    assert got[3000][5] == cheapest([(r, x) for _, r, x in ordered])[0]


def test_empty_table(spark):
    assert run(spark, []) == {}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
def test_query_on_driver_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    changed = damage(rows)
    got = C.op11_conversation_repair(spark, sf).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows, changed, by_hash(spark, changed))
    assert len(got) == len({r[0] for r in rows})
