"""Conversation repair against a search over all edits in plain Python."""

import functools
import hashlib
import random
import re
import sys
import zlib

import numpy as np

from cohortlift.llm import repair
from cohortlift.llm.queries import QUERIES

sys.setrecursionlimit(20_000)
SMALL = "/root/testdata/sf0.001"
LETTER = {0: "u", 1: "u", 2: "a", 3: "u"}
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired rows) of rows (role, text, must_go, truncated), by backward minima of (cost, audit)."""
    n = len(rows)

    @functools.cache
    def best(i, q, inserts):
        found = [(0, "", ())] if i == n and q in (0, 3) else []
        go = LETTER[q]
        if inserts < 3:
            c, a, out = best(i, STEP[q, go], inserts + 1)
            found.append((3 + c, "I" + a, ((ROLE[go], ""), *out)))
        if i < n:
            role, text, must_go, truncated = rows[i]
            c, a, out = best(i + 1, q, 0)
            found.append((4 + c, "D" + a, out))
            if not must_go:
                extra = 3 if truncated else 0
                if (q, role[:1]) in STEP:
                    c, a, out = best(i + 1, STEP[q, role[:1]], 0)
                    found.append((extra + c, "K" + a, ((role, text), *out)))
                c, a, out = best(i + 1, STEP[q, go], 0)
                found.append((3 + extra + c, "R" + a, ((ROLE[go], text), *out)))
        return min(found) if found else (10**6, "", ())

    return best(0, 0, 0)


def report(conv_id, rows):
    """The report of rows (turn, role, text) after damage, in order."""
    seen, faults, marked = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, out = cheapest(tuple(marked))
    said = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (conv_id, gaps, *faults.values(), illegal, cost, audit, said)


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv_id, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows, every=()):
    convs = {c: [] for c in every}
    for conv_id, turn, role, text in rows:
        convs.setdefault(conv_id, []).append((turn, role, text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest())
    return sorted((report(c, sorted(r, key=key)) for c, r in convs.items()), key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


TURNS = "conv_id long, turn long, role string, text string, at long, symbols string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = rows_of(QUERIES["op11_conversation_repair"](spark, SMALL))
    assert found == expected(damage(rows), {r[0] for r in rows})


def test_nulls_ties_long_texts_and_repeated_rows(spark):
    texts = [None, "", " \t", "Yes.", "No", "Why? ", "é!\n", "long " * 60_000 + ".", "a "]
    rng = random.Random(5)
    rows = [
        (rng.choice([None, 0, 1, 2, -3]), rng.choice([None, 0, 1, 2, 3, 9]), rng.choice([None, "", "user", "assistant", "system", "tool", "ü"]), rng.choice(texts))
        for _ in range(60)
    ]
    rows = [r for r in rows if r[2] != ""] + [(7, 0, "user", "Hi.")] * 9
    damaged = frame(spark, rows)
    want = expected(damage(rows), {r[0] for r in rows})
    found = repair.repair(repair.damaged(damaged), damaged, segment_rows=4)
    assert rows_of(found) == want


def test_empty_table_and_conversations_without_rows(spark):
    rows = frame(spark, [])
    assert rows_of(repair.repair(repair.damaged(rows), rows)) == []
    # 0:8 is dropped
    gone = next(t for t in range(200) if zlib.crc32(f"0:{t}".encode()) % 20 == 0)
    rows = frame(spark, [(0, gone, "user", "Hi.")])
    empty = (0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows_of(repair.repair(repair.damaged(rows), rows)) == [empty]


def test_a_hot_conversation_in_many_segments(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"n{t}.", f"m{t}"])) for t in range(300)]
    rows += [(2 + k, t, r, "Hi.") for k in range(30) for t, r in enumerate(["user", "assistant"])]
    assert rows_of(repair.repair(frame(spark, rows), segment_rows=16)) == expected(rows)


def _sequential(symbols, right):
    v, out = repair.closed(np.array([right])), []
    for s in symbols[::-1]:
        v = repair.before(v, np.array([s]))
        out.append(v[0])
    return np.array(out[::-1])


def test_chunks_give_the_sequential_costs():
    """Random rows converge; rows of one role do not, and are rerun throughout."""
    rng = np.random.default_rng(3)
    for symbols in (rng.integers(0, 10, 1000), np.full(700, repair.SYMBOLS.index("s")), np.full(500, repair.SYMBOLS.index("b")), rng.integers(2, 6, 33)):
        for right in (repair.END[0], repair.UNITS[2]):
            cost, left = repair.backward(symbols, np.array([len(symbols)]), right[None])
            want = _sequential(symbols, right)
            real = want < repair.NEVER
            assert (cost[real] == want[real]).all() and (cost[~real] >= repair.NEVER).all()
            assert (left[0] == cost[0]).all()
