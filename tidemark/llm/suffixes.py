"""Exact substring dedup on bytes by distributed suffix sorting.

A document loses every byte covered by a 50-byte string that also starts in a document with a
smaller id. Only suffixes that begin at a repeated winnowed anchor are sorted (see ``repeats``): each
travels with its leading bytes and the few before it. Splitters sampled from the texts
range-partition the suffixes by their leading 16 bytes; a bucket sorts its own by multikey quicksort
on 8-byte words, then compares neighbours: of all suffixes with the same leading bytes and the
same bytes before them, those of the smallest document stay.

Boundaries: an anchor is longer than a splitter, so suffixes that can share a 50-byte string agree
in all that a splitter sees and never lie on two sides of one; equal splitters are merged. So no
match has to be carried from one bucket to the next. A hot anchor does not fill its bucket: a task sends one suffix per distinct
surrounding, that of its smallest document, and marks the rest itself.

Defined cases: a null text is empty; a null id matches nothing and loses nothing; rows with one id
do not remove each other; of equal texts the smallest id keeps its bytes; an empty table gives no
rows; columns other than the two named ones are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view as windows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.repeats import blob_batch, pack, runs, slices, unpack
from tidemark.llm.rolling import chain
from tidemark.llm.scratch import Scratch

SPAN = 50
ANCHOR = 20
LEAD = 16
#: Suffixes whose neighbours are compared at once.
STRETCH = 1 << 15
#: Documents whose suffixes the splitters are drawn from, about, and suffixes taken of each.
SAMPLE_DOCS = 4000
SAMPLE_EACH = 16
_NO_SPANS = np.empty((0, 2), np.int64)
_KINDS = (np.int64, np.uint32, np.uint32, np.uint8, np.uint8)


def flatten(column: pa.Array) -> repeats.Flat:
    """UTF-8 bytes of all rows, end to end."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


PLAN = repeats.Plan(SPAN, ANCHOR, flatten)


def big_endian(matrix: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of 8-byte words that compare like the bytes."""
    wide = -matrix.shape[1] % 8
    padded = np.pad(matrix, ((0, 0), (0, wide))) if wide else np.ascontiguousarray(matrix)
    return padded.view(">u8").astype(np.uint64)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows by multikey sorting: by the first word, then only those still tied by the
    next, each group on its own."""
    n = len(words)
    order = np.argsort(words[:, 0], kind="stable") if n else np.empty(0, np.int64)
    group = _ranks(words[order, 0])
    for k in range(1, words.shape[1]):
        size = np.bincount(group, minlength=1)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        rows = order[tied]
        inner = np.lexsort((words[rows, k], group[tied]))
        order[tied] = rows[inner]
        new = np.zeros(n, bool)
        new[1:] = group[1:] != group[:-1]
        w = words[order[tied], k]
        same = (tied[1:] == tied[:-1] + 1) & (group[tied][1:] == group[tied][:-1])
        new[tied[1:][same & (w[1:] != w[:-1])]] = True
        group = np.cumsum(new)
    return order


def _ranks(values: np.ndarray) -> np.ndarray:
    new = np.zeros(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.cumsum(new)


def splitters(rows: DataFrame, buckets: int) -> np.ndarray:
    """Leading bytes that part the suffixes of a bounded sample of texts evenly."""
    total = rows.count()
    sample = rows.select("text").sample(min(1.0, SAMPLE_DOCS / max(1, total)), seed=1)

    def leads(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                raw = text.as_py().encode()
                at = np.linspace(0, len(raw) - SPAN, SAMPLE_EACH, dtype=int) if len(raw) >= SPAN else []
                out += [raw[i : i + LEAD] for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["lead"])

    found = np.array(sorted(bytes(r[0]) for r in sample.mapInArrow(leads, "lead binary").collect()), f"S{LEAD}")
    if not len(found):
        return found
    return np.unique(found[np.linspace(0, len(found) - 1, buckets + 1).astype(int)[1:-1]])


def marks(texts: DataFrame, cuts: np.ndarray, buckets: int) -> DataFrame:
    """``doc_id, h32, marks``: blobs of (anchor place, bit per offset) for each text."""
    before = PLAN.w - 1

    def make(batches):
        for batch in batches:
            for part in repeats.sub_batches(batch, most=1 << 20):  # leaves before the next is cut
                yield blob_batch(_suffix_blobs(part, cuts, buckets, before))

    def compare(kinds):
        if 0 in kinds:
            doc, h32, place, mask = _compare(kinds[0], before)
            yield blob_batch(repeats.by_text(buckets, doc, h32, place, mask))
        if 1 in kinds:
            yield blob_batch(repeats.by_text(buckets, *_marked(kinds[1])))

    def gather(kinds):
        doc, h32, place, mask = _marked(kinds[1])
        order = np.lexsort((h32, doc))
        doc, h32 = doc[order], h32[order]
        firsts = runs(doc, h32)
        if len(firsts):
            pairs = np.stack([place[order], mask[order]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[firsts]), pa.array(h32[firsts].astype(np.int64)), repeats.binary(pairs, firsts)],
                names=["doc_id", "h32", "marks"],
            )

    return repeats.shuffled(
        texts.select("doc_id", "h1", "text", "keys"), buckets, make, compare, gather,
        "doc_id long, h32 long, marks binary",
    )


def _marked(blobs: list[bytes]) -> list[np.ndarray]:
    found = [unpack(d, np.int64, np.uint32, np.uint32, np.uint32) for d in blobs]
    return [np.concatenate([f[i] for f in found]) for i in range(4)]


def _suffix_blobs(batch: pa.RecordBatch, cuts: np.ndarray, buckets: int, before: int) -> list:
    flat = flatten(batch["text"])
    items, offsets = flat
    rows, places, lows, highs = [], [], [], []
    for low, h, row, first, end, least in repeats.wanted_runs(batch, flat, PLAN):
        while len(row):
            # The leftmost place of the minimum, and the windows it is the leftmost in.
            near = windows(np.append(h, np.full(PLAN.w - 1, h[-1])), PLAN.w)[first] == least[:, None]
            at = first + near.argmax(axis=1)
            last = np.minimum(end, at + 1)
            rows.append(row)
            places.append(at + low)
            lows.append(at - last + 1)
            highs.append(at - first)
            more = last < end
            row, first, end, least = row[more], last[more], end[more], least[more]
    if not rows:
        return []
    row, place, o1, o2 = (np.concatenate(x) for x in (rows, places, lows, highs))
    padded = np.concatenate([np.zeros(before, np.uint8), items, np.zeros(SPAN, np.uint8)])
    context = windows(padded, before + SPAN)[place]
    doc = batch["doc_id"].to_numpy()[row]
    h32 = (batch["h1"].to_numpy()[row] & 0xFFFFFFFF).astype(np.uint32)
    place = (place - offsets[row]).astype(np.uint32)
    o1, o2 = o1.astype(np.uint8), o2.astype(np.uint8)
    # Equal surroundings within the task: the smallest document's leave, the others' are marked.
    name = np.zeros(len(row), np.uint64)
    with np.errstate(over="ignore"):
        for word in big_endian(context).T:
            name = chain(name, word)
        name = chain(name, o1.astype(np.uint64) << np.uint64(8) | o2)
    order = np.lexsort((doc, name))
    firsts = runs(name[order])
    least = np.repeat(doc[order][firsts], np.diff(np.append(firsts, len(order))))
    stay = doc[order] == least
    known, order = order[~stay], order[stay]
    blobs = []
    if len(known):
        mask = ((np.uint64(2) << o2[known].astype(np.uint64)) - (np.uint64(1) << o1[known].astype(np.uint64)))
        blobs = repeats.by_text(
            buckets, doc[known], h32[known], place[known], mask.astype(np.uint32)
        )
    lead = np.ascontiguousarray(context[order, before : before + LEAD]).view(f"S{LEAD}").reshape(-1)
    turn = np.argsort(lead, kind="stable")
    order = order[turn]
    to = np.searchsorted(cuts, lead[turn], "right") if len(cuts) else np.zeros(len(order), np.int64)
    for k, a, b in slices(to):
        own = order[a:b]
        body = context[own].tobytes() + pack(doc[own], h32[own], place[own], o1[own], o2[own])
        blobs.append((k, 0, np.array([len(own)], "<u4").tobytes() + body))
    return blobs


def _compare(blobs: list[bytes], before: int) -> tuple:
    """Sort a bucket's suffixes and mark, for each, the offsets of the windows that a smaller
    document holds too."""
    width = before + SPAN
    contexts, columns = [], []
    for data in blobs:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        contexts.append(np.frombuffer(data, np.uint8, n * width, 4).reshape(n, width))
        columns.append(unpack(data[4 + n * width :], *_KINDS))
    context = np.concatenate(contexts)
    doc, h32, place, o1, o2 = (np.concatenate([c[i] for c in columns]) for i in range(5))
    order = multikey_order(big_endian(context[:, before:]))
    context, doc, h32, place, o1, o2 = (x[order] for x in (context, doc, h32, place, o1, o2))
    # Bytes that each suffix shares with the one before it.
    shared = np.zeros(len(doc), np.int64)
    for a in range(1, len(doc), STRETCH):
        b = min(len(doc), a + STRETCH)
        apart = context[a:b, before:] != context[a - 1 : b - 1, before:]
        shared[a:b] = np.where(apart.any(axis=1), apart.argmax(axis=1), SPAN)
    mask = np.zeros(len(doc), np.uint32)
    left = np.zeros(len(doc), np.uint64)
    for o in range(before + 1):
        if o:
            left = chain(left, context[:, before - o].astype(np.uint64))
        active = np.flatnonzero((o1 <= o) & (o <= o2))
        if len(active) < 2:
            continue
        group = np.cumsum(shared < SPAN - o).astype(np.uint64)
        name = chain(group[active], left[active])
        turn = np.argsort(name, kind="stable")
        firsts = runs(name[turn])
        own = doc[active[turn]]
        least = np.repeat(np.minimum.reduceat(own, firsts), np.diff(np.append(firsts, len(own))))
        mask[active[turn][own > least]] |= np.uint32(1 << o)
    hit = mask > 0
    return doc[hit], h32[hit], place[hit], mask[hit]


def covered(size: int, marks_of_text: bytes) -> np.ndarray:
    """Which bytes the marked windows cover."""
    place, mask = np.frombuffer(marks_of_text, "<u4").reshape(-1, 2).T
    bits = (mask[:, None] >> np.arange(PLAN.w, dtype=np.uint32)) & 1
    which, offset = np.nonzero(bits)
    starts = place[which].astype(np.int64) - offset
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + SPAN, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup_substrings(
    docs: DataFrame, stage: Scratch, doc_id: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, kept`` (the bytes that stay, or with ``as_text`` the whole
    characters among them), ``n_bytes, n_removed``,
    ``removed`` (maximal runs, as first byte and length) and ``carried``, a struct of the columns
    named in ``carry``."""
    rows = repeats.text_rows(docs, doc_id, text, carry)
    buckets = repeats.bucket_count(rows)
    usable = rows.where("doc_id IS NOT NULL")
    first = repeats.first_holders(rows)
    anchors = stage.put(repeats.repeated_anchors(usable, PLAN, buckets), "anchors")
    texts = repeats.texts_with(usable, anchors, first)
    found = stage.put(marks(texts, splitters(rows, buckets), buckets), "marks")
    known = repeats.judged(rows, found, first)

    def cut(batches):
        for batch in batches:
            for part in repeats.sub_batches(batch):
                kept, sizes, spans = [], [], []
                for body, lists, copy in zip(part["text"], part["marks"], part["copy"], strict=True):
                    raw = np.frombuffer(body.as_py().encode(), np.uint8)
                    if copy.as_py() and raw.size >= SPAN:
                        gone = np.ones(raw.size, bool)
                    elif lists.is_valid:
                        gone = covered(raw.size, b"".join(lists.as_py()))
                    else:
                        gone = None
                    sizes.append(raw.size)
                    left = (raw if gone is None else raw[~gone]).tobytes()
                    kept.append(whole_characters(left) if as_text else left)
                    spans.append(_NO_SPANS if gone is None else repeats.stretches(gone))
                lost = [int(s[:, 1].sum()) for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(lost, pa.int64()), repeats.span_lists(spans), part["carried"]],
                    names=["doc_id", "kept", "n_bytes", "n_removed", "removed", "carried"],
                )

    along = known.schema["carried"].dataType.simpleString()
    return known.mapInArrow(
        cut, f"doc_id long, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long,"
        f" removed array<struct<first:long,length:long>>, carried {along}",
    )


def whole_characters(kept: bytes) -> str:
    """Kept bytes as text. A removed run may begin or end inside a character; what is left of such
    a character is no text and goes."""
    return kept.decode("utf-8", "ignore")
