"""What the two exact substring operators share: from texts to the few places worth comparing.

1. Winnowed anchors. Any match of ``k + w - 1`` items holds a k-gram that is the least of its window
   in both places, so a text is only of interest where such an anchor also occurs in another
   text. Anchors travel as sorted 48-bit hashes in blobs; a false agreement costs time, not truth.
2. The texts that hold repeated anchors meet the list of them again, one text per distinct content.
3. The operator compares what surrounds the anchors and returns marks per text (its own step).
4. The marks meet the texts, and every document is cut.

Before any shuffle a task reduces what it has, some megabytes of text at a time: an anchor that occurs
in several of those texts leaves once, as does one that occurs in all of them. Equal texts are compared once, by the smallest id
that has them. Nothing is collected but the splitters of a bounded sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rolling import gram_hashes, mix, window_min

#: Items that are hashed at once.
BLOCK = 1 << 18
#: Bytes of text whose anchors one task brings together.
BUCKET_BYTES = 16 << 20
KEY_BITS = np.uint64(48)
BLOBS = "bucket int, kind int, data binary"

Flat = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Plan:
    """``span`` items must agree; anchors are ``k`` items long. ``flatten`` turns a text column into
    the items of all its rows, end to end, and the offsets of the rows."""

    span: int
    k: int
    flatten: Callable[[pa.Array], Flat]

    @property
    def w(self) -> int:
        return self.span - self.k + 1


def text_rows(docs: DataFrame, doc_id: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, h1, h2, carried``: h1 and h2 are a 128-bit name of the text, carried is a
    struct of the columns that go along."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    along = F.struct(F.lit(0).alias("_none"), *[F.col(f"`{c}`") for c in carry])
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("text"),
        F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(7), body).alias("h2"), along.alias("carried"),
    )


def bucket_count(rows: DataFrame) -> int:
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))


def minima(flat: Flat, plan: Plan) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Block by block: its offset, the k-gram hashes, and the runs of windows with one minimum, as
    first window, end and minimum. No run holds a window that crosses the border of a row."""
    items, offsets = flat
    span = plan.span
    for low in range(0, len(items) - span + 1, BLOCK):
        part = items[low : low + BLOCK + span - 1].astype(np.uint64)
        h = gram_hashes(part, plan.k)
        m = window_min(h, plan.w)
        n = len(m)
        borders = offsets[np.searchsorted(offsets, low, "right") : np.searchsorted(offsets, low + len(part))]
        crossing = np.zeros(n + 1, np.int32)
        np.add.at(crossing, np.clip(borders - span + 1 - low, 0, n), 1)
        np.add.at(crossing, np.clip(borders - low, 0, n), -1)
        inside = np.cumsum(crossing[:-1]) == 0
        new = np.ones(n, bool)
        new[1:] = (m[1:] != m[:-1]) | (inside[1:] != inside[:-1])
        edges = np.flatnonzero(new)
        ends = np.append(edges[1:], n)
        fine = inside[edges]
        yield low, h, edges[fine], ends[fine], m[edges[fine]]


def row_of(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, "right") - 1


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte plane by byte plane, so that leading zeros compress away."""
    return b"".join(
        np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns
    )


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    n = len(data) // sum(sizes)
    out, at = [], 0
    for kind, size in zip(kinds, sizes, strict=True):
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return out


def runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """First places of the runs of equal rows."""
    n = len(sorted_columns[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def slices(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Bucket, first place and end of each run."""
    firsts = [*runs(sorted_buckets).tolist(), len(sorted_buckets)]
    for a, b in zip(firsts, firsts[1:], strict=False):
        yield int(sorted_buckets[a]), a, b


def binary(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """A binary array whose entries are the stretches of ``values`` that begin at ``firsts``."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1)
    size = raw.size // max(1, len(values))
    ends = np.append(firsts, len(values)).astype(np.int64) * size
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(firsts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())]
    ).cast(pa.binary())


def dealt(blobs: DataFrame, buckets: int, gather, schema: str) -> DataFrame:
    """Blobs (``bucket, kind, data``) meet by bucket; ``gather`` gets all of a bucket, by kind, and
    gives batches of ``schema``. Few large rows travel, whatever the number of their entries."""

    def collect(batches):
        kinds: dict[int, list[bytes]] = {}
        for batch in batches:
            for kind, data in zip(batch["kind"].to_pylist(), batch["data"], strict=True):
                kinds.setdefault(kind, []).append(data.as_py())
        if kinds:
            yield from gather(kinds)

    met = blobs.repartitionById(buckets, F.col("bucket")).select("kind", "data")
    return met.mapInArrow(collect, schema)


def shuffled(rows: DataFrame, buckets: int, make, compare, gather, schema: str) -> DataFrame:
    """Two rounds of ``dealt``: ``make`` deals entries by what they are compared on, ``compare`` deals
    what it finds by text, and ``gather`` gives one row per text."""
    entries = rows.mapInArrow(make, BLOBS)
    return dealt(dealt(entries, buckets, compare, BLOBS), buckets, gather, schema)


def blob_batch(blobs: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, k, d = zip(*blobs, strict=True) if blobs else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(d, pa.binary())],
        names=["bucket", "kind", "data"],
    )


def distinct_texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, first = np.unique(batch["h1"].to_numpy(), return_index=True)
    return batch if len(first) == batch.num_rows else batch.take(pa.array(np.sort(first)))


def sub_batches(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20):
    """The batch in stretches of about ``most`` bytes of text."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(sizes // most)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def repeated_anchors(rows: DataFrame, plan: Plan, buckets: int) -> DataFrame:
    """``h1, keys``: for each text the anchors that another text has too (64-bit blobs)."""

    def make(batches):
        for batch in batches:
            for part in sub_batches(distinct_texts(batch)):  # leaves before the next is read
                yield blob_batch(seed_blobs(part))

    def seed_blobs(texts):
        flat = plan.flatten(texts["text"])
        keys, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for low, _, first, _, least in minima(flat, plan):
            keys.append(least >> (np.uint64(64) - KEY_BITS))
            owner.append(row_of(flat[1], first + low))
        key, row = np.concatenate(keys), np.concatenate(owner)
        order = np.lexsort((row, key))
        key, row = key[order], row[order]
        keep = runs(key, row)
        key, row = key[keep], row[keep]
        h1 = texts["h1"].to_numpy()[row]
        firsts = runs(key)
        sizes = np.diff(np.append(firsts, len(key)))
        seed, name = key[firsts], h1[firsts]
        # Minima are small numbers: ranges of them would give the first buckets nearly all.
        with np.errstate(over="ignore"):
            to = (mix(seed) % np.uint64(buckets)).astype(np.int64)
        turn = np.argsort(to, kind="stable")
        seed, name = seed[turn], name[turn]
        blobs = []
        for bucket, a, b in slices(to[turn]):
            blobs.append((bucket, 0, _pack_seeds(seed[a:b], name[a:b])))
        hit = np.repeat(sizes > 1, sizes)
        return blobs + by_text(buckets, h1[hit], key[hit])

    def compare(kinds):
        seeds = [_unpack_seeds(d) for d in kinds.get(0, [])]
        key = np.concatenate([np.empty(0, np.uint64), *(s[0] for s in seeds)])
        h1 = np.concatenate([np.empty(0, np.int64), *(s[1] for s in seeds)])
        order = np.argsort(key, kind="stable")
        key, h1 = key[order], h1[order]
        firsts = runs(key)
        if len(firsts):
            sizes = np.diff(np.append(firsts, len(key)))
            several = np.minimum.reduceat(h1, firsts) != np.maximum.reduceat(h1, firsts)
            hit = np.repeat(several, sizes)
            yield blob_batch(by_text(buckets, h1[hit], key[hit]))
        if 1 in kinds:
            known = [unpack(d, np.int64, np.uint64) for d in kinds[1]]
            h1, key = (np.concatenate([k[i] for k in known]) for i in range(2))
            yield blob_batch(by_text(buckets, h1, key))

    def gather(kinds):
        found = [unpack(d, np.int64, np.uint64) for d in kinds[1]]
        h1, key = (np.concatenate([f[i] for f in found]) for i in range(2))
        order = np.lexsort((key, h1))
        h1, key = h1[order], key[order]
        keep = runs(h1, key)
        h1, key = h1[keep], key[keep]
        firsts = runs(h1)
        if len(firsts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[firsts]), binary(key, firsts)], names=["h1", "keys"]
            )

    return shuffled(rows.select("h1", "text"), buckets, make, compare, gather, "h1 long, keys binary")


def by_text(buckets: int, name: np.ndarray, *columns: np.ndarray) -> list:
    """Blobs (kind 1) of entries, dealt by the name of their text, the first column."""
    to = (name.astype(np.int64).view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    parts = [c[order] for c in (name, *columns)]
    return [(k, 1, pack(*(c[a:b] for c in parts))) for k, a, b in slices(to[order])]


def _pack_seeds(key: np.ndarray, h1: np.ndarray) -> bytes:
    names, place = np.unique(h1, return_inverse=True)
    head = np.array([len(key), len(names)], "<u4").tobytes()
    gaps = np.diff(key, prepend=np.uint64(0))
    return head + pack(gaps, place.astype("<u4")) + names.tobytes()


def _unpack_seeds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(data, "<u4", 2)
    gaps, place = unpack(data[8 : len(data) - 8 * int(m)], np.uint64, "<u4")
    names = np.frombuffer(data, np.int64, int(m), len(data) - 8 * int(m))
    return np.cumsum(gaps, dtype=np.uint64)[: int(n)], names[place]


def first_holders(rows: DataFrame) -> DataFrame:
    """``h1, h2, first``: the smallest id that has each text."""
    return rows.where("doc_id IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))


def texts_with(rows: DataFrame, anchors: DataFrame, first: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, text, keys``: the texts that hold repeated anchors, each once (rows that
    are equal in id and text stay as they are)."""
    wanted = (
        anchors.groupBy("h1").agg(F.collect_list("keys").alias("keys"))
        .join(first.withColumnRenamed("first", "doc_id"), "h1")
    )
    return rows.drop("carried").join(wanted, ["h1", "h2", "doc_id"])


def wanted_runs(batch: pa.RecordBatch, flat: Flat, plan: Plan):
    """Per block the runs of windows whose minimum is among the row's anchors: the block's offset,
    its hashes, then row, first window, end and minimum of each run."""
    lists = batch["keys"]
    counts = [sum(len(k) // 8 for k in x) for x in lists.to_pylist()]
    raw = b"".join(k for x in lists.to_pylist() for k in x)
    names = _name(np.repeat(np.arange(batch.num_rows), counts), np.frombuffer(raw, np.uint64))
    names.sort()
    for low, h, first, end, least in minima(flat, plan):
        row = row_of(flat[1], first + low)
        name = _name(row, least >> (np.uint64(64) - KEY_BITS))
        at = np.minimum(np.searchsorted(names, name), max(0, len(names) - 1))
        hit = names[at] == name if len(names) else np.zeros(len(name), bool)
        if hit.any():
            yield low, h, row[hit], first[hit], end[hit], least[hit]


def _name(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return key ^ (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def judged(rows: DataFrame, marks: DataFrame, first: DataFrame) -> DataFrame:
    """All rows with what is known of them: ``marks``, a list of blobs or null, and ``copy``, true
    where a document with a smaller id has the same text. A mark carries the id and the low half of
    the text's name. The texts are shuffled once, the lists are narrow."""
    low = F.expr("CAST(h1 & 4294967295L AS bigint)").alias("h32")
    lists = marks.groupBy("doc_id", "h32").agg(F.collect_list("marks").alias("marks"))
    copies = (
        rows.select("doc_id", "h1", "h2").join(first, ["h1", "h2"]).where("doc_id > first")
        .select("doc_id", low, F.lit(True).alias("copy")).distinct()
    )
    known = lists.join(copies, ["doc_id", "h32"], "full_outer")
    keyed = rows.select("doc_id", "text", "carried", low)
    return keyed.join(known, ["doc_id", "h32"], "left").select(
        "doc_id", "text", "carried", "marks", F.coalesce("copy", F.lit(False)).alias("copy")
    )


def stretches(gone: np.ndarray) -> np.ndarray:
    """Maximal runs of true values, as rows of first place and length."""
    edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
    first = np.flatnonzero(edge == 1)
    return np.stack([first, np.flatnonzero(edge == -1) - first], axis=1)


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int64())]))


def span_lists(spans: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, spans)]).astype(np.int32)
    flat = np.concatenate([np.empty((0, 2), np.int64), *spans]).astype(np.int64)
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["first", "length"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)
