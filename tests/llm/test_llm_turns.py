import hashlib
import heapq
import os
import re
import zlib
from itertools import groupby, product

import pytest
import xxhash

from tidemark.llm import queries, turns

DIR = "/root/testdata/sf0.001"


def order(row):
    conv, turn, role, text = row
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return (turn is not None, turn or 0, role, h - (1 << 64) * (h >> 63))


def symbols(rows):
    """Fault and initial of each row, in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((fault, role[:1]))
    return out


def cheapest(faults):
    """Shortest path over (row, state), least (cost, audit) first: a plain Dijkstra with whole strings."""
    heap, done = [(0, "", 0, "", ())], set()
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}
    while heap:
        cost, audit, at, state, kept = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(faults) and state in ("", "a"):
            return cost, audit, kept
        for role in grammar[state]:
            if role != "s":
                heapq.heappush(heap, (cost + 5, audit + "I", at, role, (*kept, (None, role))))
            if at < len(faults) and faults[at][0] not in ("blank", "duplicate"):
                late = 5 * (faults[at][0] == "truncated")
                if role == faults[at][1]:
                    heapq.heappush(heap, (cost + late, audit + "K", at + 1, role, (*kept, (at, None))))
                elif role != "s":
                    heapq.heappush(heap, (cost + 1 + late, audit + "R", at + 1, role, (*kept, (at, role))))
        if at < len(faults):
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, kept))


def brute(conversations):
    """``conversations``: id to rows (conv, turn, role, text), none where all were dropped."""
    out = []
    for conv, rows in conversations.items():
        rows = sorted([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], key=order)
        faults, at = symbols(rows), [r[1] for r in rows if r[1] is not None]
        cost, audit, kept = cheapest(faults) if rows else (0, "", ())
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names[role] if role else rows[i][2]}:{'' if i is None else rows[i][3]}" for i, role in kept]
        count = lambda kind: sum(f == kind for f, _ in faults)
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def test_automaton_on_all_short_signatures():
    """Every signature of up to four rows, in reversed order as a task reads them."""
    kinds = {"s": (None, "s"), "u": (None, "u"), "a": (None, "a"), "o": (None, "t"), "S": ("truncated", "s"),
             "U": ("truncated", "u"), "A": ("truncated", "a"), "O": ("truncated", ""), "x": ("blank", "u")}
    endings = turns.Endings()
    texts = sorted("".join(s) for n in range(5) for s in product(kinds, repeat=n))
    for reverse in texts:
        assert endings.read(reverse) == cheapest([kinds[s] for s in reversed(reverse)])[:2], reverse
    # Each ending became a node once, and few classes of nodes there are.
    assert endings.made == len(texts) - 1 and len(endings.machine.costs) < 60


ODD = [
    (1, 0, "system", "Be good."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi."),
    (2, None, "user", None), (2, None, None, "What."), (2, 5, "assistant", "So. \n"), (2, 9, "tool", "é!"),
    (None, 1, "user", "x"), (None, None, "assistant", "y."), (3, 1, "user", "a."), (3, 1, "user", "a."), (3, 1, "user", "b."),
    (3, 7, "user", "a."), (4, 1, "User", "A!"), (5, 1, "", ""), (6, 2, "assistant", "B." * 5000), (7, 1, "user", " "),
    (8, 1, "s", "odd."), (8, 2, "ugly", "odd."), (8, 3, "a", "odd."),
] + [(9, i, ("user", "assistant")[i % 2], f"Text {i}.") for i in range(400)] + [(10, i, "user", "the same.") for i in range(60)]


def test_odd_conversations(spark, scratch):
    df = spark.createDataFrame([(*r, "c", 1, True) for r in ODD], "conv_id long, turn long, role string, text string, copy string, h int, again boolean")
    plain = {k: list(g) for k, g in groupby(sorted(ODD, key=lambda r: repr(r[0])), key=lambda r: r[0])}
    got = sorted((tuple(r) for r in turns.repair(df, scratch).collect()), key=repr)
    assert got == brute(plain)


def test_repaired_rows(spark, scratch):
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    got = {}
    for r in sorted(turns.repaired_rows(df, scratch).collect(), key=lambda r: (repr(r.conv_id), r.place)):
        got.setdefault(r.conv_id, []).append(r)
    assert [r.place for r in got[9]] == list(range(400)) and "".join(r.edit for r in got[9]) == "K" * 400
    assert [(r.edit, r.role, r.text) for r in got[1]] == [("K", "system", "Be good."), ("K", "user", "Hello?"), ("K", "assistant", "Hi.")]
    for conv, rows in got.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rows)), conv


def test_no_conversations(spark, scratch):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turns.repair(df, scratch).collect() == []


def test_all_rows_dropped(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD[:3], "conv_id long, turn long, role string, text string")
    row = turns.repair(df, scratch, F.lit(True)).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op12_conversations"](spark, DIR).collect()), key=repr)
    assert got == brute(damage(rows))
