"""SimHash near-duplicates: exact comparison of 64-bit fingerprints in tiles.

Equal fingerprints are one class. Two fingerprints that differ in at most ``radius`` bits agree in
all bits of at least ``bands - radius`` of ``bands`` bit bands; for every such choice of bands the
classes are grouped by those bits, and each group is compared in tiles, sorted by population count,
with numpy exclusive-or and bit counts. Tile pairs whose population counts differ by more than the
radius are skipped. No pair within the radius is lost, whatever the data, and a group holds about
``n / 2^bits`` classes; more bands are taken as the table grows. A group above ``GROUP`` classes is
dealt out as pairs of blocks to as many tasks. A task gives a spanning forest of the links it
finds, at most one edge per class, never all pairs.

Defined cases: a null or empty text has fingerprint zero and links like any other; a null id gets
its fingerprint and no component; rows with the same id are one node; repeated rows are kept; an
empty table gives no rows; columns other than the two named ones are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import Forest, components
from tidemark.session import Staging

RADIUS = 4
SHINGLE = 4
SEED = 42
TILE = 256
#: Classes of a group that one task compares; larger groups are dealt out in blocks.
GROUP = 4096
#: Groups are meant to hold so many classes at most; beyond it more bands are used.
MEAN_GROUP = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased text over its word shingles, as an unsigned value."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: A-Z only, and blanks \x20 \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts, seed, join = np.zeros(64, np.int64), SEED, b" ".join
    for at in range(0, n, 1 << 14):
        last = min(n, at + (1 << 14))
        h = [xxh64_intdigest(join(words[i : i + shingle]), seed) for i in range(at, last)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", text_hash: bool = False) -> DataFrame:
    """``doc_id, fp``: the fingerprint of each row as a signed long; with ``text_hash`` also
    ``text_hash``."""
    held = ["text_hash"] if text_hash else []
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
        *[hash_of(text).alias(c) for c in held],
    )

    def add(batches):
        for batch in batches:
            values = np.array([fingerprint(x.as_py()) for x in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(values.view(np.int64)), *[batch[c] for c in held]],
                names=["doc_id", "fp", *held],
            )

    return rows.mapInArrow(add, ", ".join(f"{c} long" for c in ["doc_id", "fp", *held]))


def hash_of(text: str = "text"):
    """Tells the texts of one id apart; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def band_choices(classes: int, radius: int = RADIUS) -> list[int]:
    """Masks of the bits that must agree, one per choice of bands."""
    for bands in range(radius + 1, radius + 6):
        edges = np.linspace(0, 64, bands + 1).astype(int)
        masks = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges, edges[1:], strict=False)]
        choices = [sum(c) for c in combinations(masks, bands - radius)]
        if classes >> min(c.bit_count() for c in choices) <= MEAN_GROUP:
            break
    return choices


def near_links(classes: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """Edges ``a, b`` between ids of classes (``fp``, ``rep``) within ``radius`` bits: enough of
    them to connect what is connected."""
    choices = band_choices(count, radius)
    signed = [c - (1 << 64) if c >> 63 else c for c in choices]
    keyed = classes.select(
        "fp", "rep",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(c)) for c in signed])).alias("band", "bits"),
    )
    sizes = keyed.groupBy("band", "bits").agg(F.count("*").alias("n")).where(f"n > {GROUP}")
    # Few groups are that large: their members are dealt to pairs of blocks, each once per partner.
    blocks = F.ceil(F.col("n") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = (
        keyed.join(sizes, ["band", "bits"], "left")
        .withColumn("other", F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(0), F.coalesce(blocks, F.lit(1)) - 1)))
        .withColumn("own", F.when(F.col("n").isNull(), F.lit(0)).otherwise(own))
        .select("band", "bits", "fp", "rep", "own", F.explode("other").alias("other"))
        .select("band", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "fp", "rep")
    )
    keys = ["band", "bits", "i", "j"]
    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys, F.bit_count("fp"))
        .mapInArrow(lambda batches: _compare(batches, radius), "a long, b long")
    )


def _compare(batches, radius: int):
    """Rows come group by group; a group is compared once all of it is there."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("band", "bits", "i", "j")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        found = []
        for k, (first, last) in enumerate(zip(edges, edges[1:], strict=False)):
            piece = batch.slice(first, last - first)
            if k == 0 and held and _same(held[-1], piece):
                held.append(piece)
                continue
            if held:
                found.append(_links(held, radius))
            held = [piece]
        if found:
            yield _edges(found)
    if held:
        yield _edges([_links(held, radius)])


def _same(x: pa.RecordBatch, y: pa.RecordBatch) -> bool:
    return all(x[c][0].as_py() == y[c][0].as_py() for c in ("band", "bits", "i", "j"))


def _edges(found: list) -> pa.RecordBatch:
    a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _links(pieces: list[pa.RecordBatch], radius: int) -> tuple[np.ndarray, np.ndarray]:
    fp = np.concatenate([p["fp"].to_numpy() for p in pieces]).view(np.uint64)
    rep = np.concatenate([p["rep"].to_numpy() for p in pieces])
    if len(fp) < 2:
        return rep[:0], rep[:0]
    ones = np.bitwise_count(fp).astype(np.int64)
    forest = Forest(len(fp))
    starts = range(0, len(fp), TILE)
    for x in starts:
        for y in range(x, len(fp), TILE):
            if ones[y] - ones[min(x + TILE, len(fp)) - 1] > radius:
                break  # sorted: all later tiles are further still
            near = np.bitwise_count(fp[x : x + TILE, None] ^ fp[None, y : y + TILE]) <= radius
            a, b = np.nonzero(near)
            a, b = a + x, b + y
            forest.unite(a[a < b], b[a < b])
    member, root = forest.links()
    return rep[member], rep[root]


def simhash_groups(
    docs: DataFrame, stage: Staging, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the group of a document is named by its smallest id."""
    rows = stage.put(fingerprints(docs, doc_id, text), "fingerprints")
    classes = stage.put(
        rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes"
    )
    links = near_links(classes, classes.count(), radius)
    # An id that stands in rows of several texts links their classes.
    several = rows.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y")
    shared = rows.join(several, "doc_id").join(classes, "fp").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")
    )
    links = links.union(shared)
    groups = components(stage.put(links, "links"), stage)
    named = classes.join(groups, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    out = rows.join(named, "fp", "left")
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_per_group(docs: DataFrame, stage: Staging, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (with ``doc_id`` and ``text``), one of each group of near texts: that of
    the smallest id, one without an id only if none has one; of several texts of that id in the
    group, or of equal rows, one. Texts that are not near stay, also under one id."""
    rows = stage.put(
        fingerprints(docs, text_hash=True).groupBy("doc_id", "fp", "text_hash").agg(F.count("*").alias("n")),
        "fingerprints",
    )
    classes = stage.put(rows.select("fp").distinct().select("fp", F.col("fp").alias("rep")), "classes")
    groups = components(stage.put(near_links(classes, classes.count(), radius), "links"), stage)
    named = classes.join(groups, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "n"))
    chosen = stage.put(
        rows.join(named, "fp").groupBy("component").agg(best.alias("best"))
        .select(F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_hash"), F.col("best.n").alias("_n")),
        "chosen",
    )

    # The columns travel as one, so that they may have any names.
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def pick(which: DataFrame) -> DataFrame:
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (hash_of() == F.col("_hash"))
        return packed.join(which, same, "left_semi")

    equal = pick(chosen.where("_n > 1")).groupBy("doc_id", hash_of().alias("_hash")).agg(F.min("row").alias("row"))
    return pick(chosen.where("_n = 1")).select("row").unionByName(equal.select("row")).select("row.*")
