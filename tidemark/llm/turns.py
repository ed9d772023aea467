"""Repair of conversation structure over an automaton of role and fault signatures.

A conversation's rows, in order, become a signature of one symbol a row: the role's part in the grammar ``(s?(ua)+)?`` and
the fault. The cheapest edits that lead to a sentence of the grammar depend on what is still to come, so
signatures are read from their end: they are range-partitioned and sorted by their reverse, equal
endings lie side by side, and each ending is one node of an automaton whose path is kept on a stack.
A node is made once for all conversations that share the ending. It holds, for each state of the
grammar, the cost to go and the first edits of the best audit suffix with the state they lead to, so
the suffix itself is the chain of nodes behind it; nodes whose costs and edits agree up to a constant
are one class of the minimal automaton, whose transitions are computed once. Of edits that cost the same the least
letter wins: from one state no two edits begin with the same letter, so comparing the first is enough.

Duplicates and gaps are found with Spark; rows move narrow (hashes in place of texts) until the
audits are known, then texts move once, and the repaired text is hashed as it streams. A conversation
needs one byte a row for its signature, in one task, and the hash of its repaired text is that of
one stream; nothing else of it is held together. Equal rows of a conversation are one row with a
count until then, and a frequent signature is spread over the ranges.

Defined cases: null roles and texts count as one blank; a null conversation is one too, a null turn
comes first; rows of one turn are ordered by role, then by the hash of the text; repeated rows are
rows; roles other than user, assistant and system by their initial fit no place; a conversation
without rows, or whose rows all go, has an empty repair; an empty table gives no rows; a conversation
of any length is read whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar: at the start, after s, after u, after a. What each may be followed by.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
#: Symbols: the initial of the role in the grammar or o, upper case if truncated; x must go.
INITIALS = "sua"
MUST_GO = "x"
#: Characters of a reversed signature that place it in a range.
PLACE = 64


class Automaton:
    """Classes of endings by their costs to go, up to a constant, and the transitions between them.

    ``step(cls, symbol)`` is the class of the ending with the symbol put before it, what is added to
    its cost, and for each state the edits up to and with that of the symbol's row, and the state after.
    """

    def __init__(self):
        self.costs: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, ...], int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int, tuple]] = {}
        base = [(0, "") if s in ENDS else None for s in range(4)]
        done = self._with_inserts([b and (b[0], b[1], s) for s, b in enumerate(base)])
        self.end, self.end_cost = self._class(done)
        self.last = tuple((e, s) for _, e, s in done)

    def _class(self, done: list) -> tuple[int, int]:
        least = min(d[0] for d in done)
        costs = tuple(d[0] - least for d in done)
        cls = self.known.setdefault(costs, len(self.costs))
        if cls == len(self.costs):
            self.costs.append(costs)
        return cls, least

    @staticmethod
    def _with_inserts(best: list) -> list:
        """``(cost, edits, state after)`` of each state, with inserts before the row where they pay."""
        best = list(best)
        for _ in range(len(best)):
            for state, follow in NEXT.items():
                for role, after in follow.items():
                    if role in ROLES and best[after]:
                        cost, edits, to = best[after]
                        mine = (cost + INSERT, "I" + edits, to)
                        if best[state] is None or mine[:2] < best[state][:2]:
                            best[state] = mine
        return best

    def step(self, cls: int, symbol: str) -> tuple[int, int, tuple]:
        made = self.steps.get((cls, symbol))
        if made is None:
            rest, best = self.costs[cls], []
            late = TRUNCATED if symbol.isupper() else 0
            for state, follow in NEXT.items():
                options = [(DELETE + rest[state], "D", state)]
                if symbol != MUST_GO:
                    for role, after in follow.items():
                        if role == symbol.lower():
                            options.append((KEEP + late + rest[after], "K", after))
                        elif role in ROLES:
                            options.append((REROLE + late + rest[after], "R", after))
                best.append(min(options))
            done = self._with_inserts(best)
            into, least = self._class(done)
            made = self.steps[cls, symbol] = (into, least, tuple((e, s) for _, e, s in done))
        return made


class Endings:
    """The nodes of the ending read last, from the end: class and cost to go of each."""

    def __init__(self):
        self.machine = Automaton()
        self.signature = ""  # reversed
        self.cls = array("i", [self.machine.end])
        self.cost = array("q", [self.machine.end_cost])
        self.made = 0

    def read(self, reverse: str) -> tuple[int, str]:
        """Cost and audit of the signature whose reverse is given; shared nodes are not made again."""
        same = _common(self.signature, reverse)
        del self.cls[same + 1 :], self.cost[same + 1 :]
        cls, cost = self.cls[same], self.cost[same]
        for symbol in reverse[same:]:
            cls, more, _ = self.machine.step(cls, symbol)
            cost += more
            self.cls.append(cls)
            self.cost.append(cost)
        self.made += len(reverse) - same
        self.signature = reverse
        state, edits = START, []
        for at in range(len(reverse) - 1, -1, -1):
            more, state = self.machine.steps[self.cls[at], reverse[at]][2][state]
            edits.append(more)
        edits.append(self.machine.last[state][0])
        return cost + self.machine.costs[cls][START], "".join(edits)


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def _rows(table: DataFrame, dropped: Column | None) -> DataFrame:
    """``conv_id, turn, role, text, h, dropped``; ``h`` orders rows of one turn and role."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return table.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.xxhash64(text).alias("h"), F.coalesce(dropped if dropped is not None else F.lit(False), F.lit(False)).alias("dropped"),
    )


def _narrow(rows: DataFrame) -> DataFrame:
    """Equal rows of a conversation once, with their number and their own faults; what was dropped is
    one row of no number."""
    body = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    there = ~F.col("dropped")
    facts = {
        "turn": F.when(there, F.col("turn")), "role": F.when(there, F.col("role")).otherwise(""),
        "h": F.when(there, F.col("h")).otherwise(0), "whole": F.when(there, F.xxhash64(F.lit("text"), "text")).otherwise(0),
        "blank": there & (body == ""), "late": there & (body != "") & ~F.substring(body, -1, 1).isin(".", "!", "?"),
    }
    return (
        rows.select("conv_id", "dropped", *[c.alias(n) for n, c in facts.items()])
        .groupBy("conv_id", "dropped", *facts).agg(F.count("*").alias("n"))
    )


def _sequence(batches):
    """One row a conversation from its rows in order: signature reversed, and counts."""

    def stream():
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in batch.schema.names), strict=True)

    done = []
    for conv, group in groupby(stream(), key=lambda r: r[0]):
        signature, counts, before = [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), None
        low = high = last = None
        distinct = 0
        for _, dropped, turn, role, blank, late, again, n in group:
            if dropped:
                continue
            if turn is not None:
                low, high = turn if low is None else low, turn
                distinct += turn != last
                last = turn
            initial = role[:1]
            counts["illegal"] += (before is not None and before + initial not in ("su", "ua", "au")) + (n - 1)
            before = initial
            gone = "blank" if blank else "duplicate" if again else "truncated" if late else None
            if gone:
                counts[gone] += 1
            counts["blank" if blank else "duplicate"] += n - 1
            symbol = MUST_GO
            if not (blank or again):
                symbol = initial if initial and initial in INITIALS else "o"
                symbol = symbol.upper() if late else symbol
            signature.append(symbol + MUST_GO * (n - 1))
        gaps = 0 if low is None else high - low + 1 - distinct
        done.append((conv, "".join(signature)[::-1], gaps, *counts.values()))
        if len(done) >= 1000:
            yield _records(done)
            done = []
    if done:
        yield _records(done)


SEQUENCE = "conv_id long, reverse string, gaps long, blank long, duplicate long, truncated long, illegal long"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if i == 1 else pa.int64()) for i, c in enumerate(columns)],
        names=["conv_id", "reverse", *COUNTS],
    )


def _audit(batches):
    endings = Endings()
    for batch in batches:
        found = [endings.read(r) for r in batch["reverse"].to_pylist()]
        columns = [batch[c] for c in ("conv_id", *COUNTS)]
        costs, audits = [f[0] for f in found], [f[1] for f in found]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(costs, pa.int64()), pa.array(audits, pa.string())], names=["conv_id", *COUNTS, "cost", "audit"]
        )


def audits(rows: DataFrame, stage) -> DataFrame:
    """``conv_id``, the counts, ``cost`` and ``audit`` of every conversation of ``rows``."""
    narrow = stage.put(_narrow(rows), "turns")
    # The first turn of a text and role that stand in several turns; null turns come first.
    key = ["conv_id", "role", "h", "whole"]
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    several = narrow.where("NOT dropped AND NOT blank").groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1")
    several = several.select(*[F.col(c).alias(f"_{c}") for c in key], "first")
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    again = F.coalesce(place > F.col("first"), F.lit(False))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h"), F.col("whole")]
    sequences = (
        narrow.join(several, same, "left").withColumn("again", again)
        .repartition("conv_id").sortWithinPartitions(*order)
        .select("conv_id", "dropped", "turn", "role", "blank", "late", "again", "n")
        .mapInArrow(_sequence, SEQUENCE)
    )
    sequences = stage.put(sequences, "signatures")
    # The conversation parts a frequent signature; a prefix keeps the sampled splitters short.
    ranges = [F.substring("reverse", 1, PLACE), F.xxhash64("conv_id")]
    return (
        sequences.repartitionByRange(*ranges).sortWithinPartitions("reverse")
        .mapInArrow(_audit, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    )


def _repairs(batches):
    """``(summary, edits)`` of each conversation: its row of counts and a stream of
    ``(edit, role, text)`` in order."""

    def stream():
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield from batch.slice(at, 256).to_pylist()

    def edits(audit, group):
        at, state = 0, START

        def to(role: str) -> None:
            nonlocal state
            state = NEXT[state][role]

        def inserts():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                role = "a" if state == USER else "u"
                to(role)
                at += 1
                yield "I", ROLES[role], ""

        for r in group:
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit == "R":
                role = "a" if state == USER else "u"
                to(role)
                yield "R", ROLES[role], r["text"]
            elif edit == "K":
                to(r["role"][:1])
                yield "K", r["role"], r["text"]
            else:
                yield "D", r["role"], r["text"]
        yield from inserts()

    for _, group in groupby(stream(), key=lambda r: r["conv_id"]):
        summary = next(group)
        yield summary, edits(summary["audit"], group)


def _dealt(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The audit of each conversation, then its rows in order."""
    kept = rows.where("NOT dropped").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "h", "text")
    told = found.withColumn("kind", F.lit(0))
    order = [F.col("conv_id"), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]
    return told.unionByName(kept, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)


def repair(table: DataFrame, stage, dropped: Column | None = None) -> DataFrame:
    """One row a conversation of ``table`` (``conv_id, turn, role, text``): counts of faults, cost and
    audit of the cheapest repair, and the SHA-256 of the repaired ``role:text`` lines. Rows where
    ``dropped`` holds are not there, but their conversation is told."""
    rows = _rows(table, dropped)
    names = ["conv_id", *COUNTS, "cost", "audit"]

    def digest(batches):
        done = []
        for summary, edits in _repairs(batches):
            digest, first = hashlib.sha256(), True
            for edit, role, text in edits:
                if edit != "D":
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            done.append({**{c: summary[c] for c in names}, "repaired_sha256": digest.hexdigest()})
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    schema = pa.schema([(c, pa.string() if c == "audit" else pa.int64()) for c in names] + [("repaired_sha256", pa.string())])
    found = stage.put(audits(rows, stage), "audits")
    return _dealt(rows, found).mapInArrow(
        digest, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
        " audit string, repaired_sha256 string",
    )


def repaired_rows(table: DataFrame, stage, dropped: Column | None = None) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the repaired conversations, places from 0."""
    rows = _rows(table, dropped)

    def tell(batches):
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        for summary, edits in _repairs(batches):
            left, place = [], 0
            for edit, role, text in edits:
                if edit != "D":
                    left.append({"conv_id": summary["conv_id"], "place": place, "edit": edit, "role": role, "text": text})
                    place += 1
                if len(left) >= 256:
                    yield pa.RecordBatch.from_pylist(left, schema=schema)
                    left = []
            if left:
                yield pa.RecordBatch.from_pylist(left, schema=schema)

    found = stage.put(audits(rows, stage), "audits")
    return _dealt(rows, found).mapInArrow(tell, "conv_id long, place long, edit string, role string, text string")
