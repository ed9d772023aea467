"""Hierarchical multi-length packing of documents into training windows.

A document's full windows stand alone. What is left of it is routed by length to a context-size
tier; each tier opens its windows with its own pieces and fills their gaps from the shorter tiers,
the best fit first, and a last gap by cutting a short piece. Windows of a tier are full, so nothing
is padded, and step groups take windows of one tier up to a set number of tokens, so the
steps cost the same. Each task packs the documents it reads: no shuffle, and what does not fill a
window is carried on; only a task's very last tokens go to windows of decreasing powers of two.

Defined cases: a null text is an empty one (its end id is one token); null ids and repeated rows are
packed row by row; an empty table gives no rows; a very long document is cut like any other;
columns other than the two named ones are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encode import STRETCH_BYTES, encoder
from tidemark.llm.repeats import sub_batches

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)
#: Tokens of a step group.
STEP_TOKENS = 128 * WINDOW
PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, sequence_length long, step_group long"
)


@dataclass(order=True)
class Piece:
    length: int
    serial: int
    doc: int | None = field(compare=False)
    start: int = field(compare=False)
    ids: np.ndarray = field(compare=False)
    doc_tokens: int = field(compare=False)

    def cut(self, n: int, serial: int) -> tuple["Piece", "Piece"]:
        """The first ``n`` ids, and the rest under a new serial."""
        head = Piece(n, self.serial, self.doc, self.start, self.ids[:n], self.doc_tokens)
        tail = Piece(self.length - n, serial, self.doc, self.start + n, self.ids[n:], self.doc_tokens)
        return head, tail


class Packer:
    """Packs pieces as they come; ``rows`` gathers the packed ones."""

    def __init__(self, part: int, window: int = WINDOW, tiers: tuple = TIERS, step: int = STEP_TOKENS):
        self.tiers, self.window, self.step = tiers, window, step
        self.base = part << 36
        self.sequences = 0
        self.serial = 0
        self.held = 0  # tokens in the pool
        self.in_tier: dict[int, int] = {}
        self.pool: list[Piece] = []
        self.rows: list[tuple] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.window
        for at in range(0, whole, self.window):
            self._emit([self._piece(doc, at, ids[at : at + self.window], n)])
        if whole < n:
            insort(self.pool, self._piece(doc, whole, ids[whole:], n))
            self.held += n - whole

    def _piece(self, doc, start, ids, total) -> Piece:
        self.serial += 1
        return Piece(len(ids), self.serial, doc, start, ids, total)

    def pack(self) -> None:
        """Fill windows tier by tier, longest first, while the pool lasts."""
        shortest = self.tiers[-1]
        for tier in self.tiers:
            floor = tier // 2 if tier > shortest else 0
            while self.held >= tier and floor < self.pool[-1].length <= tier:
                self._emit(self._fill(tier))

    def _fill(self, tier: int) -> list[Piece]:
        chosen = [self.pool.pop()]
        gap = tier - chosen[0].length
        while gap:
            at = bisect_right(self.pool, gap, key=lambda p: p.length)
            if at:
                piece = self.pool.pop(at - 1)
            else:  # every piece is longer than the gap: cut the shortest
                self.serial += 1
                piece, rest = self.pool.pop(0).cut(gap, self.serial)
                insort(self.pool, rest)
            chosen.append(piece)
            gap -= piece.length
        self.held -= tier
        return chosen

    def finish(self) -> None:
        """The last tokens, in windows of decreasing powers of two."""
        self.pack()
        while self.held:
            size = min(self.window, 1 << self.held.bit_length() - 1)
            chosen, need = [], size
            while need:
                piece = self.pool.pop()
                if piece.length > need:
                    self.serial += 1
                    piece, rest = piece.cut(need, self.serial)
                    insort(self.pool, rest)
                chosen.append(piece)
                need -= piece.length
            self._emit(chosen)
            self.held -= size

    def _emit(self, pieces: list[Piece]) -> None:
        total = sum(p.length for p in pieces)
        nth = self.in_tier.get(total, 0)
        self.in_tier[total] = nth + 1
        # Groups of one tier hold as many tokens as those of any other.
        group = self.base | nth // max(1, self.step // total) << 12 | total.bit_length() - 1
        offset = 0
        for p in pieces:
            self.rows.append(
                (p.doc, p.start, p.length, zlib.crc32(p.ids.astype("<u4").tobytes()), p.doc_tokens,
                 self.base | self.sequences, offset, total, group)
            )
            offset += p.length
        self.sequences += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        names = [x.split()[0] for x in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack_documents(
    docs: DataFrame, path: str, white_space: str = "leading", end_id: int = 1,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece; see ``PACKED`` for its columns."""
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )

    def pack(batches):
        encode = encoder(path, white_space)
        end = np.array([end_id], "<u4")
        packer = Packer(TaskContext.get().partitionId())
        for batch in (b for whole in batches for b in sub_batches(whole, most=STRETCH_BYTES)):
            for key, ids in zip(batch["doc_id"].to_pylist(), encode.batch(batch["text"]), strict=True):
                packer.add(key, np.concatenate([ids, end]))
                if len(packer.pool) >= 4096:
                    packer.pack()
                if len(packer.rows) >= 20_000:
                    yield packer.take()
        packer.finish()
        if packer.rows:
            yield packer.take()

    return rows.mapInArrow(pack, PACKED)
