"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors become whole numbers (``floor(SCALE x)``, in double precision), are ordered by length, label
and place on a Hilbert curve, and written as blocks of ``Limits.block`` rows, one Parquet row each, with the
least and greatest value of every dimension and of the label: the zone map. An anchor's score with any row of a block lies between
the sums of the least and of the greatest products of its components with the block's intervals.
A search keeps the best rows of each window of scores; a block is read for an anchor only if the
bounds reach one of its windows, and inside a task only while they reach what the window still lacks.

``positives``: the first rows of the anchor's own label. Its window is bounded below by what the
anchor's own block already offers. ``negatives``: a window of scores below each positive, rows of
other labels.

Scale: anchors are dealt into tiles along the curve (``Limits.tile``), blocks into ``Limits.groups``
groups by hash. First only zone maps meet the tiles; the pairs (tile, block) that can matter then fetch the
blocks. One task takes a tile and a group, holds the tile and one block at a time, and returns the
best rows of each window, so what is merged is bounded by that number times the result. No label,
group of equal vectors or tile gathers in one task. On vectors without any structure the bounds leave
out few blocks, and the work is that of the anchors against all rows, block by block.

Defined cases: rows with a null id, a null label, a null vector, a null or non-finite component take
no part, nor do those whose whole-number vector is longer than ``LONGEST`` (scores would not fit a
long); vectors of different length are never compared; empty vectors have score zero; a repeated id
is a row of its own and may be a positive or negative of its twin; ties in score go to the smaller id;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Staging

SCALE = 256
#: Bits of the curve in each dimension.
BITS = 8
#: Sums of products below this are exact in a double.
EXACT = 2.0**53
LONGEST = 2.0**30
TOP = 5
LOWEST = np.iinfo(np.int64).min
HIGHEST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Limits:
    """Sizes of the work; none of them changes the result."""

    block: int = 256  # rows of a block, at most 2^ROW_BITS
    tile: int = 16_384  # anchors of a tile, about
    groups: int = 64  # groups of blocks, each of which meets a tile in a task of its own
    strip: int = 1024  # anchors that one product of matrices takes
    range: int = 1 << 20  # rows of a range of the curve, about
    held: int = 1 << 20  # found rows that are kept before the best are taken


LIMITS = Limits()
#: A row is named by its block's number and its place there.
ROW_BITS = 16

BLOCKS = (
    "block long, part int, dim int, n int, before long, anchors int, label_lo long, label_hi long,"
    " norm double, lo array<int>, hi array<int>, ids binary, labels binary, flags binary, v binary"
)
_SCHEMA = pa.schema([
    ("block", pa.int64()), ("part", pa.int32()), ("dim", pa.int32()), ("n", pa.int32()), ("before", pa.int64()),
    ("anchors", pa.int32()), ("label_lo", pa.int64()), ("label_hi", pa.int64()), ("norm", pa.float64()),
    ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())), ("ids", pa.binary()), ("labels", pa.binary()),
    ("flags", pa.binary()), ("v", pa.binary()),
])
ZONES = ("block", "dim", "label_lo", "label_hi", "lo", "hi")
KEPT = "anchor long, slot int, score long, vec_id long"


def hilbert_keys(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``values`` (n x d, below 2^bits), as n x bytes.

    Skilling's transform: from the highest bit down, the lower bits of the first axis are inverted or
    exchanged with those of each axis; then the axes are Gray-coded and their bits interleaved."""
    x = np.ascontiguousarray(values.T.astype(np.int64))
    d, n = x.shape
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(d):
            swap = (x[0] ^ x[i]) & np.where(x[i] >> bit & 1, 0, low)
            x[0] ^= np.where(x[i] >> bit & 1, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    planes = [(x >> bit & 1).astype(np.uint8) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def quantised(table: DataFrame, vec_id: str, embedding: str, label: Column, anchor: Column) -> DataFrame:
    """``vec_id, label, anchor, dim, q, norm, top`` of the rows that take part; ``q`` holds int32
    values, ``top`` is the greatest without sign."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    rows = table.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), vector.alias("v"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(batches):
        for batch in batches:
            lists = batch["v"]
            sizes = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(sizes)
            # Beyond 1e150 a square leaves the doubles; such a vector is too long anyway.
            flat = np.clip(lists.flatten().to_numpy(zero_copy_only=False), -1e150, 1e150)
            flat = np.floor(SCALE * flat)
            each = [flat[e - s : e] for s, e in zip(sizes, ends, strict=True)]
            norms = np.array([np.sqrt(x @ x) for x in each])
            fits = norms < LONGEST
            some = [x for x, f in zip(each, fits, strict=True) if f]
            left = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays(
                [left["vec_id"], left["label"], left["anchor"], pa.array(sizes[fits].astype(np.int32)),
                 pa.array([x.astype("<i4").tobytes() for x in some], pa.binary()), pa.array(norms[fits]),
                 pa.array([int(np.abs(x).max(initial=0)) for x in some], pa.int64())],
                names=["vec_id", "label", "anchor", "dim", "q", "norm", "top"],
            )

    return rows.where(finite).mapInArrow(
        whole, "vec_id long, label long, anchor boolean, dim int, q binary, norm double, top long"
    )


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), dim)


def write_blocks(rows: DataFrame, stage: Staging, limits: Limits = LIMITS) -> DataFrame:
    """Staged blocks of the staged ``rows``, in the order of the curve, with their zone maps."""
    n, top = rows.agg(F.count("*"), F.max("top")).first()
    width = 2 * (top or 0) + 1

    def place(batches):
        for batch in batches:
            dims, packed = batch["dim"].to_numpy(), batch["q"].to_pylist()
            keys: list[bytes] = [b""] * len(packed)
            for dim in np.unique(dims[dims > 0]):
                at = np.flatnonzero(dims == dim)
                cells = (_matrix([packed[i] for i in at], dim).astype(np.int64) + top) * (1 << BITS) // width
                for i, key in zip(at, hilbert_keys(cells), strict=True):
                    keys[i] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, "key"])

    order = ["dim", "label", "key", "vec_id"]  # the id parts equal vectors of a label
    placed = rows.drop("top").mapInArrow(
        place, "vec_id long, label long, anchor boolean, dim int, q binary, norm double, key binary"
    )
    parts = max(1, -(-n // limits.range), min(16, n // 2048))
    return stage.put(
        placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("key").mapInArrow(partial(_pack, limits.block), BLOCKS),
        "blocks",
    )


def _pack(size: int, batches):
    from pyspark import TaskContext

    part, seq, before, held = TaskContext.get().partitionId(), 0, 0, []

    def block():
        nonlocal seq, before, held
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        dim, labels = rows["dim"][0].as_py(), rows["label"].to_numpy()
        v = _matrix(rows["q"].to_pylist(), dim)
        flags = rows["anchor"].to_numpy(zero_copy_only=False)
        made = {
            "block": part << 32 | seq, "part": part, "dim": dim, "n": len(labels), "before": before,
            "anchors": int(flags.sum()), "label_lo": int(labels.min()), "label_hi": int(labels.max()),
            "norm": float(rows["norm"].to_numpy().max()), "lo": v.min(axis=0).tolist(), "hi": v.max(axis=0).tolist(),
            "ids": rows["vec_id"].to_numpy().astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(),
            "flags": flags.astype(np.uint8).tobytes(), "v": v.tobytes(),
        }
        seq, before, held = seq + 1, before + made["anchors"], []
        return made

    for batch in batches:
        done, at = [], 0
        dims = batch["dim"].to_numpy()
        while at < batch.num_rows:
            count = sum(b.num_rows for b in held)
            if held and (count == size or held[0]["dim"][0].as_py() != dims[at]):
                done.append(block())
                count = 0
            run = dims[at : at + size - count]
            take = int(np.argmax(run != run[0])) or len(run)
            held.append(batch.slice(at, take))
            at += take
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_SCHEMA)
    if held:
        yield pa.RecordBatch.from_pylist([block()], schema=_SCHEMA)


def _product(a: np.ndarray, b: np.ndarray, norms: float) -> np.ndarray:
    """Exact inner products of whole numbers as long."""
    if norms < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def anchors_of(blocks: DataFrame, stage: Staging, top: int = TOP, limits: Limits = LIMITS) -> DataFrame:
    """Staged anchors, one row each, with a tile and the least score their positives can have: what
    the rows of the anchor's own block offer."""
    total, parts = blocks.agg(F.coalesce(F.sum("anchors"), F.lit(0)), F.coalesce(F.max("part"), F.lit(0)) + 1).first()
    tiles = max(1, -(-total // limits.tile))
    cap = max(1, limits.tile * tiles // parts)
    subs = (blocks.agg(F.max("before")).first()[0] or 0) // cap + 1
    tile = F.floor(F.col("part") * tiles / parts) * subs + F.floor(F.col("before") / cap)

    def unpack(batches):
        for batch in batches:
            for r in batch.to_pylist():
                dim, v = r["dim"], np.frombuffer(r["v"], "<i4").reshape(r["n"], r["dim"])
                ids, labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8")
                at = np.flatnonzero(np.frombuffer(r["flags"], np.uint8))
                scores = _product(v[at], v, r["norm"] ** 2)
                scores[labels[at][:, None] != labels] = LOWEST
                scores[np.arange(len(at)), at] = LOWEST
                floor = np.sort(scores, axis=1)[:, -top] if r["n"] >= top else np.full(len(at), LOWEST)
                norms = np.sqrt(np.square(v[at].astype(np.float64)).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((r["block"] << ROW_BITS) + at), pa.array(ids[at]), pa.array(labels[at]),
                     pa.array(np.full(len(at), dim, np.int32)), pa.array(np.full(len(at), r["tile"])),
                     pa.array([x.tobytes() for x in v[at]], pa.binary()), pa.array(norms), pa.array(floor)],
                    names=["anchor", "vec_id", "label", "dim", "tile", "v", "norm", "floor"],
                )

    found = blocks.where("anchors > 0").withColumn("tile", tile.cast("long")).select(
        "block", "n", "dim", "tile", "norm", "ids", "labels", "flags", "v"
    )
    return stage.put(
        found.mapInArrow(
            unpack, "anchor long, vec_id long, label long, dim int, tile long, v binary, norm double, floor long"
        ),
        "anchors",
    )


class _Tile:
    """Anchors of one length with their windows, and the best rows of each so far."""

    def __init__(self, rows: list[dict], same: bool, top: int, limits: Limits = LIMITS):
        self.rows = np.array([r["id"] for r in rows])
        self.label = np.array([r["label_lo"] for r in rows])
        self.norm = np.array([r["norm"] for r in rows])
        dim = len(rows[0]["v"]) // 4
        self.v = _matrix([r["v"] for r in rows], dim)
        self.plus, self.minus = (f(self.v, 0).astype(np.float64) for f in (np.maximum, np.minimum))
        slots = max(len(r["low"]) for r in rows)
        # A window that is not there has its ends crossed.
        self.kth = np.full((len(rows), slots), HIGHEST)
        self.high = np.full((len(rows), slots), LOWEST)
        for i, r in enumerate(rows):
            self.kth[i, : len(r["low"])] = r["low"]
            self.high[i, : len(r["high"])] = r["high"]
        self.kth = np.maximum(self.kth, LOWEST + 1) - 1  # only what is greater, or as great with a smaller id, enters
        self.kth_id = np.full(self.kth.shape, LOWEST)
        self.same, self.top, self.limits = same, top, limits
        self.held: list[np.ndarray] = []
        self.count = 0

    def wants(self, zone: dict) -> np.ndarray:
        """Anchors one of whose windows the block can reach."""
        lo, hi = (np.array(zone[c], np.float64) for c in ("lo", "hi"))
        if self.same:
            fits = (zone["label_lo"] <= self.label) & (self.label <= zone["label_hi"])
        else:
            fits = (self.label != zone["label_lo"]) | (self.label != zone["label_hi"])
        slack = self.norm * np.sqrt(np.square(np.maximum(np.abs(lo), np.abs(hi))).sum()) * max(1, len(lo)) * 2.0**-50
        up = self.plus @ hi + self.minus @ lo + slack
        down = self.plus @ lo + self.minus @ hi - slack
        return np.flatnonzero(fits & ((up[:, None] >= self.kth) & (down[:, None] <= self.high)).any(axis=1))

    def read(self, block: dict) -> None:
        ids, labels = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["labels"], "<i8")
        v = np.frombuffer(block["v"], "<i4").reshape(len(ids), -1) if len(block["v"]) else np.zeros((len(ids), 0), np.int32)
        chosen = self.wants(block)
        for at in range(0, len(chosen), self.limits.strip):
            some = chosen[at : at + self.limits.strip]
            scores = _product(self.v[some], v, self.norm[some].max() * block["norm"])
            fits = (self.label[some][:, None] == labels) == self.same
            own = self.rows[some] - (block["id"] << ROW_BITS)
            twins = np.flatnonzero((own >= 0) & (own < len(ids)))
            fits[twins, own[twins]] = False
            for k in range(self.kth.shape[1]):
                least = self.kth[some, k][:, None]
                enter = fits & (scores <= self.high[some, k][:, None])
                enter &= (scores > least) | ((scores == least) & (ids < self.kth_id[some, k][:, None]))
                a, b = np.nonzero(enter)
                if len(a):
                    self.held.append(np.stack([some[a], np.full(len(a), k), scores[a, b], ids[b]]))
                    self.count += len(a)
        if self.count > min(self.limits.held, 8 * self.top * self.kth.size):
            self.cut()

    def cut(self) -> np.ndarray:
        """The best ``top`` of each window among the held rows, which they then are."""
        if not self.held:
            return np.zeros((4, 0), np.int64)
        rows = np.concatenate(self.held, axis=1)
        rows = rows[:, np.lexsort((rows[3], -rows[2], rows[1], rows[0]))]
        window = rows[0] * self.kth.shape[1] + rows[1]
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        rank = np.arange(len(window)) - np.repeat(first, np.diff([*first, len(window)]))
        last = rows[:, rank == self.top - 1]
        self.kth[last[0], last[1]] = last[2]
        self.kth_id[last[0], last[1]] = last[3]
        rows = rows[:, rank < self.top]
        self.held, self.count = [rows], rows.shape[1]
        return rows


def _meet(anchors: DataFrame, blocks: DataFrame, groups: int, tiles: int, work, schema: str) -> DataFrame:
    """Deals anchors to every group and blocks to theirs; ``work(key, rows)`` gets, for each tile,
    group and length, its anchors and then its blocks as dictionaries and yields record batches."""
    names = ["tile", "grp", "dim", "kind", "id", "label_lo", "label_hi", "norm", "low", "high", "lo", "hi", "ids", "labels", "v"]
    kinds = dict(zip(names, "long int int int long long long double array<long> array<long> array<int> array<int> binary binary binary".split(), strict=True))
    fill = lambda df: df.select(*[
        (F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in names
    ])
    left = anchors.withColumns({
        "grp": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "kind": F.lit(0), "id": F.col("anchor"), "label_lo": F.col("label"),
    })
    right = blocks.withColumns({"grp": F.pmod(F.xxhash64("block"), F.lit(groups)), "kind": F.lit(1), "id": F.col("block")})
    keys = ["tile", "grp", "dim"]

    def run(batches):
        def stream():
            for batch in batches:
                for at in range(0, batch.num_rows, 64):  # a few blocks at a time as Python objects
                    yield from batch.slice(at, 64).to_pylist()

        for _, group in groupby(stream(), key=lambda r: tuple(r[k] for k in keys)):
            yield from work(group)

    return (
        fill(left).unionByName(fill(right)).repartition(min(tiles * groups, 4096), *keys)
        .sortWithinPartitions(*keys, "kind", "id").mapInArrow(run, schema)
    )


def search(
    anchors: DataFrame, blocks: DataFrame, stage: Staging, same: bool, name: str, top: int = TOP, limits: Limits = LIMITS
) -> DataFrame:
    """Staged ``anchor, slot, rank, score, vec_id``: the first ``top`` rows of each window of the
    anchors (``low`` and ``high``, arrays of the same length), of the anchor's label or of others."""
    count = blocks.count()
    tiles = (anchors.agg(F.max("tile")).first()[0] or 0) + 1

    def choose(group):
        held, tile, found = [], None, []
        for r in group:
            if r["kind"] == 0:
                held.append(r)
            elif held:
                tile = tile or _Tile(held, same, top, limits)
                if len(tile.wants(r)):
                    found.append((r["tile"], r["id"]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["tile", "block"])

    def score(group):
        held, tile = [], None
        for r in group:
            if r["kind"] == 0:
                held.append(r)
            elif held:
                tile = tile or _Tile(held, same, top, limits)
                tile.read(r)
        if tile:
            rows = tile.cut()
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile.rows[rows[0]]), pa.array(rows[1].astype(np.int32)), pa.array(rows[2]), pa.array(rows[3])],
                names=["anchor", "slot", "score", "vec_id"],
            )

    groups = max(1, min(limits.groups, count // 64))
    zones = blocks.select(*ZONES).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    pairs = stage.put(_meet(anchors, zones, groups, tiles, choose, "tile long, block long"), f"{name}-pairs")
    groups = max(1, min(limits.groups, count // 8))
    read = pairs.join(blocks.select(*ZONES, "norm", "ids", "labels", "v"), "block")
    kept = _meet(anchors, read, groups, tiles, score, KEPT)
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return stage.put(
        kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        .select("anchor", "slot", "rank", "score", "vec_id"), name,
    )


def hard_negatives(
    table: DataFrame, stage: Staging, anchor: Column, label: Column, vec_id: str = "vec_id",
    embedding: str = "embedding", share: tuple[int, int] = (4, 5), top: int = TOP,
    limits: Limits = LIMITS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor
    and each of its first ``top`` positives, the first ``top`` rows of other labels whose score lies
    between ``share`` (a fraction) of the positive's and the positive's."""
    part, of = share
    rows = stage.put(quantised(table, vec_id, embedding, label, anchor), "rows")
    blocks = write_blocks(rows, stage, limits)
    anchors = anchors_of(blocks, stage, top, limits)
    bound = lambda x: F.array(x.cast("long"))
    windows = anchors.withColumns({"low": bound(F.col("floor")), "high": bound(F.lit(HIGHEST))})
    positives = search(windows, blocks, stage, True, "positives", top, limits)
    # At most ``top`` rows an anchor.
    listed = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))
    windows = anchors.join(listed, "anchor").withColumns({
        # The least whole number that is at least the share of the score.
        "low": F.transform("found", lambda x: F.call_function("div", part * x["score"] + F.pmod(-part * x["score"], F.lit(of)), F.lit(of))),
        "high": F.transform("found", lambda x: x["score"]),
    })
    negatives = search(windows, blocks, stage, False, "negatives", top, limits)
    chosen = positives.select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        negatives.join(chosen, ["anchor", "slot"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
    )
