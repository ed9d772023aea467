"""Token files: one concatenated id array with Elias-Fano document boundaries.

A written folder is a table of segments in document order, committed by Spark's own writer, so a
lost executor leaves no half file. A segment holds whole documents: their ids as 16- or 32-bit
little-endian values, their ends as an Elias-Fano code, and how many ids of its part come before.
Parts are ranges of ``doc_id``; the ids before a part are the running sum of one number per part.

Defined cases: a null text is an empty one and gives the end id alone; null ids come first; rows
with the same id are ordered by a hash of their text, equal rows next to each other; an empty table
gives no rows; columns other than the two named ones are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import elias_fano
from tidemark.llm.encode import STRETCH_BYTES, encoder
from tidemark.llm.repeats import sub_batches

#: Ids after which a segment is closed.
SEGMENT_IDS = 1 << 20
#: Bytes of text that a part is meant to hold.
PART_BYTES = 64 << 20
_SEGMENTS = (
    "part int, segment int, first long, n_ids long, id_bytes int, doc_ids array<bigint>,"
    " ends binary, ids binary"
)


def part_count(spark: SparkSession, docs: DataFrame, text: str, size: int = PART_BYTES) -> int:
    """Parts of about ``size`` bytes of text, and at least the session's number."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // size))


def write_tokens(
    docs: DataFrame, folder: str, path: str, white_space: str,
    end_id: int = 1, doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    parts = part_count(spark, rows, "text")
    order = ("doc_id", F.xxhash64("text"))

    def segments(batches):
        encode = encoder(path, white_space)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        state = {"segment": 0, "first": 0}

        def close(doc_ids, pieces):
            ids = np.frombuffer(b"".join(pieces), "<u4")
            ends = np.cumsum([len(p) // 4 for p in pieces])
            wide = len(ids) and int(ids.max()) > 0xFFFF
            row = [part, state["segment"], state["first"], len(ids), 4 if wide else 2, doc_ids,
                   elias_fano.encode(ends), (ids if wide else ids.astype("<u2")).tobytes()]
            state["segment"] += 1
            state["first"] += len(ids)
            return _one_row(row)

        doc_ids, pieces, held = [], [], 0
        for batch in (b for whole in batches for b in sub_batches(whole, most=STRETCH_BYTES)):
            for key, found in zip(batch["doc_id"].to_pylist(), encode.batch(batch["text"]), strict=True):
                ids = found.tobytes() + end
                doc_ids.append(key)
                pieces.append(ids)
                held += len(ids) // 4
                if held >= SEGMENT_IDS:
                    yield close(doc_ids, pieces)
                    doc_ids, pieces, held = [], [], 0
        if doc_ids:
            yield close(doc_ids, pieces)

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(segments, _SEGMENTS).write.parquet(folder)


def _one_row(row: list) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()),
             pa.binary(), pa.binary()]
    names = [x.split()[0] for x in _SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``
    (of its ids as little-endian 32-bit values)."""
    segments = spark.read.schema(_SEGMENTS).parquet(folder)
    # One row per part, as many as there are write tasks.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))

    def documents(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch[name][row].as_py()  # noqa: B023, E731
                ends = elias_fano.EliasFano(get("ends")).values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(get("ids"), f"<u{get('id_bytes')}").astype("<u4")
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, get("part")), pa.int32()), pa.array(get("doc_ids"), pa.int64()),
                     pa.array(starts + get("first")), pa.array(ends - starts),
                     pa.array(sums, pa.int64())],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    rows = segments.mapInArrow(
        documents, "part int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def document_ids(segment, i: int) -> np.ndarray:
    """Ids of the ``i``-th document of a segment row, found by select alone."""
    ends = elias_fano.EliasFano(segment["ends"])
    first = ends.select(i - 1) if i else 0
    ids = np.frombuffer(segment["ids"], f"<u{segment['id_bytes']}")
    return ids[first : ends.select(i)].astype(np.uint32)
