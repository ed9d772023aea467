"""Exact substring dedup on words by shared seeds and hashed windows.

A document loses every word of a 20-word window whose words also start earlier: in a document with
a smaller id, or before it in the same one. Seeds are winnowed anchors of six words that two texts
share, or one text twice. Documents are not joined on seeds and no match is extended word by word:
that would list the pairs of documents that share a passage, the square of its number. Instead every
window of 20 words that holds a seed is named by a 96-bit hash of its words, and those of one name find
their earliest. A longer repeat holds further seeds; a maximal repeat is the union of its marked windows.

Defined cases: a null text has no words; a null id matches nothing and loses nothing; of equal
texts the smallest id is the earliest; windows of two rows with the same id and start are equally
early; an empty table gives no rows; columns other than the two named ones are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.repeats import blob_batch, pack, runs, slices, unpack
from tidemark.llm.rolling import gram_hashes
from tidemark.llm.scratch import Scratch

SPAN = 20
ANCHOR = 6
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_NO_SPANS = np.empty((0, 2), np.int64)
_KINDS = (np.uint64, np.uint32, np.uint32, np.int64, np.uint32)


def flatten(column: pa.Array) -> repeats.Flat:
    """64-bit hashes of the words of all rows, end to end."""
    from xxhash import xxh64_intdigest

    lists = pc.ascii_split_whitespace(column.cast(pa.large_string()))
    words = lists.flatten()
    owner = np.repeat(np.arange(len(column)), np.diff(lists.offsets.to_numpy()))
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.dictionary_encode()
    names = np.array([xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    items = names[coded.indices.to_numpy()] if len(names) else np.empty(0, np.uint64)
    counts = np.bincount(owner[full], minlength=len(column))
    return items[full], np.concatenate([[0], np.cumsum(counts)])


PLAN = repeats.Plan(SPAN, ANCHOR, flatten)


def anchors_within(rows: DataFrame) -> DataFrame:
    """``h1, keys``: the anchors that stand in one text more than once."""

    def find(batches):
        for batch in batches:
            texts = repeats.distinct_texts(batch)
            for part in repeats.sub_batches(texts):
                flat = flatten(part["text"])
                at, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
                for low, h, first, end, least in repeats.minima(flat, PLAN):
                    for start, key in _seed_places(h, first, end, least):
                        at.append(start + low)
                        hashes.append(key >> (np.uint64(64) - repeats.KEY_BITS))
                place, key = np.concatenate(at), np.concatenate(hashes)
                row = repeats.row_of(flat[1], place)
                order = np.lexsort((place, key, row))
                keep = runs(row[order], place[order], key[order])
                row, key = row[order][keep], key[order][keep]
                firsts = runs(row, key)
                several = firsts[np.diff(np.append(firsts, len(row))) > 1]
                row, key = row[several], key[several]
                starts = runs(row)
                if len(starts):
                    h1 = part["h1"].to_numpy()[row[starts]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h1), repeats.binary(key, starts)], names=["h1", "keys"]
                    )

    return rows.select("h1", "text").mapInArrow(find, "h1 long, keys binary")


def _seed_places(h, first, end, least):
    """All places at which the minima of the runs stand."""
    while len(first):
        near = h[np.minimum(first[:, None] + np.arange(PLAN.w), len(h) - 1)] == least[:, None]
        at = first + near.argmax(axis=1)
        yield at, least
        more = at + 1 < end
        first, end, least = at[more] + 1, end[more], least[more]


def marks(texts: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, h32, marks``: blobs of the window starts that have an earlier equal."""

    def make(batches):
        for batch in batches:
            blobs = []
            for part in repeats.sub_batches(batch):
                blobs += _window_blobs(part, buckets)
            yield blob_batch(blobs)

    def compare(kinds):
        if 0 in kinds:
            seeds = [_unpack_windows(d) for d in kinds[0]]
            columns = [np.concatenate([s[i] for s in seeds]) for i in range(5)]
            yield blob_batch(repeats.by_text(buckets, *_later(*columns)[0]))
        if 1 in kinds:
            yield blob_batch(repeats.by_text(buckets, *_marked(kinds[1])))

    def gather(kinds):
        doc, h32, start = _marked(kinds[1])
        order = np.lexsort((start, h32, doc))
        doc, h32, start = doc[order], h32[order], start[order]
        firsts = runs(doc, h32)
        if len(firsts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[firsts]), pa.array(h32[firsts].astype(np.int64)), repeats.binary(start, firsts)],
                names=["doc_id", "h32", "marks"],
            )

    return repeats.shuffled(
        texts.select("doc_id", "h1", "text", "keys"), buckets, make, compare, gather,
        "doc_id long, h32 long, marks binary",
    )


def _marked(blobs: list[bytes]) -> list[np.ndarray]:
    found = [unpack(d, np.int64, np.uint32, np.uint32) for d in blobs]
    return [np.concatenate([f[i] for f in found]) for i in range(3)]


def _later(name, check, start, doc, h32):
    """Windows that have an earlier equal, as (doc, h32, start); and the places of the others."""
    order = np.lexsort((start, doc, check, name))
    name, check, start, doc, h32 = (x[order] for x in (name, check, start, doc, h32))
    firsts = runs(name, check)
    sizes = np.diff(np.append(firsts, len(name)))
    # Rows with the id and start of the first are as early as it is.
    later = (doc != np.repeat(doc[firsts], sizes)) | (start != np.repeat(start[firsts], sizes))
    return (doc[later], h32[later], start[later]), order[~later]


def _window_blobs(batch: pa.RecordBatch, buckets: int) -> list:
    flat = flatten(batch["text"])
    items, offsets = flat
    rows, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low, _, row, first, end, _ in repeats.wanted_runs(batch, flat, PLAN):
        sizes = end - first
        rows.append(np.repeat(row, sizes))
        step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts.append(np.repeat(first + low, sizes) + step)
    row, at = np.concatenate(rows), np.concatenate(starts)
    if not len(row):
        return []
    name = gram_hashes(items, SPAN)[at]
    check = (gram_hashes(items, SPAN, OTHER)[at] >> np.uint64(32)).astype(np.uint32)
    doc = batch["doc_id"].to_numpy()[row]
    h32 = (batch["h1"].to_numpy()[row] & 0xFFFFFFFF).astype(np.uint32)
    start = (at - offsets[row]).astype(np.uint32)
    known, stay = _later(name, check, start, doc, h32)
    blobs = repeats.by_text(buckets, *known)
    name, check, start, doc, h32 = (x[stay] for x in (name, check, start, doc, h32))
    to = ((name >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    for k, a, b in slices(to):
        gaps = np.diff(name[a:b], prepend=np.uint64(0))
        blobs.append((k, 0, pack(gaps, check[a:b], start[a:b], doc[a:b], h32[a:b])))
    return blobs


def _unpack_windows(data: bytes) -> list[np.ndarray]:
    gaps, *rest = unpack(data, *_KINDS)
    return [np.cumsum(gaps, dtype=np.uint64), *rest]


def covered(size: int, starts: np.ndarray) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + SPAN, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup_passages(
    docs: DataFrame, stage: Scratch, doc_id: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, kept`` (the words that stay, joined by one blank),
    ``n_words, n_removed``, ``removed`` (maximal runs, as first word and number) and ``carried``, a
    struct of the columns named in ``carry``."""
    rows = repeats.text_rows(docs, doc_id, text, carry)
    buckets = repeats.bucket_count(rows)
    usable = rows.where("doc_id IS NOT NULL")
    first = repeats.first_holders(rows)
    seeds = repeats.repeated_anchors(usable, PLAN, buckets).union(anchors_within(usable))
    texts = repeats.texts_with(usable, stage.put(seeds, "seeds"), first)
    found = stage.put(marks(texts, buckets), "marks")
    known = repeats.judged(rows, found, first)

    def cut(batches):
        for batch in batches:
            for part in repeats.sub_batches(batch):
                kept, sizes, spans = [], [], []
                for body, lists, copy in zip(part["text"], part["marks"], part["copy"], strict=True):
                    words = body.as_py().encode().split()
                    n = len(words)
                    if copy.as_py() and n >= SPAN:
                        gone = np.ones(n, bool)
                    elif lists.is_valid:
                        starts = np.frombuffer(b"".join(lists.as_py()), "<u4").astype(np.int64)
                        gone = covered(n, starts)
                        words = [words[i] for i in np.flatnonzero(~gone)]
                    else:
                        gone = None
                    if gone is not None and gone.all():
                        words = []
                    sizes.append(n)
                    kept.append(b" ".join(words).decode())
                    spans.append(_NO_SPANS if gone is None else repeats.stretches(gone))
                lost = [int(s[:, 1].sum()) for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(kept, pa.string()), pa.array(sizes, pa.int64()),
                     pa.array(lost, pa.int64()), repeats.span_lists(spans), part["carried"]],
                    names=["doc_id", "kept", "n_words", "n_removed", "removed", "carried"],
                )

    along = known.schema["carried"].dataType.simpleString()
    return known.mapInArrow(
        cut, "doc_id long, kept string, n_words long, n_removed long,"
        f" removed array<struct<first:long,length:long>>, carried {along}",
    )
