"""Embedding near-duplicates: random-hyperplane signs in several tables, exact cosine, components.

Only vectors of one label are compared. Equal vectors of a label are one class. Each table hashes a
class to the signs of its products with random hyperplanes; classes of one bucket are compared by
cosine in double precision. Bits per table grow with the largest label's logarithm, so that buckets
stay small, and tables are added until a pair at the threshold is missed with probability
``MISS`` at most. A pair is counted in the first table it meets in, so counts are exact without
listing pairs. A bucket above ``GROUP`` classes is dealt out as pairs of blocks to as many tasks,
with none left out; a task gives counts and a spanning forest of its links, one edge per class at
most.

Defined cases: a vector that is null, empty, zero or holds null or non-finite values links with
nothing, nor does one without a label; vectors of different lengths do not link; equal rows are
linked as different vectors are; rows with one id are one node; a null id has links and no
component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import Forest, components
from tidemark.session import Staging

THRESHOLD = 0.93
#: Chance of missing a pair right at the threshold.
MISS = 2e-4
#: Classes meant to share a bucket, and classes of a bucket that one task compares.
MEAN_BUCKET = 16
GROUP = 4096
TILE = 512
SEED = 20


def plan_tables(largest: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits and number of the hash tables for ``largest`` classes of one label."""
    bits = min(24, max(4, math.ceil(math.log2(max(1, largest) / MEAN_BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-agree))


def signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Bucket numbers (n x tables); the same everywhere for one dimension."""
    planes = np.random.default_rng([SEED, vectors.shape[1]]).standard_normal(
        (vectors.shape[1], bits * tables)
    )
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _keyed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def hash_all(batches):
        for batch in batches:
            lists = batch["v"]
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                for at in range(0, len(rows), 1024):
                    some = rows[at : at + 1024]
                    values = flat[starts[some][:, None] + np.arange(dim)].astype(np.float64)
                    sig = signatures(values / np.abs(values).max(axis=1, keepdims=True), bits, tables)
                    part = batch.take(pa.array(np.repeat(some, tables)))
                    each = np.tile(np.arange(tables, dtype=np.int32), len(some))
                    whole = pa.array([s.astype("<i4").tobytes() for s in sig], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [part["label"], pa.array(np.full(len(part), dim, np.int32)), pa.array(each),
                         pa.array(sig.reshape(-1)), part["cls"], part["n"], part["v"],
                         whole.take(pa.array(np.repeat(np.arange(len(some)), tables)))],
                        names=["label", "dim", "tab", "bucket", "cls", "n", "v", "sig"],
                    )

    schema = (
        "label int, dim int, tab int, bucket long, cls long, n long, v array<float>, sig binary"
    )
    return classes.mapInArrow(hash_all, schema)


def near_links(classes: DataFrame, largest: int, threshold: float = THRESHOLD) -> DataFrame:
    """``cls, n_links, root``: what each class has found in each bucket. ``n_links`` counts the
    vectors of the classes linked with it; ``root`` is a class of the same component."""
    bits, tables = plan_tables(largest, threshold)
    keyed = _keyed(classes, bits, tables)
    keys = ["label", "dim", "tab", "bucket"]
    sizes = keyed.groupBy(*keys).agg(F.count("*").alias("size")).where(f"size > {GROUP}")
    blocks = F.coalesce(F.ceil(F.col("size") / GROUP).cast("int"), F.lit(1))
    dealt = (
        keyed.join(sizes, keys, "left")
        .withColumn("own", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .drop("size", "other")
    )
    group = [*keys, "i", "j"]

    def compare(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            codes = np.stack([batch[c].to_numpy().astype(np.int64) for c in group])
            cuts = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            done = []
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                piece = batch.slice(a, b - a)
                if k == 0 and held and all(held[-1][c][0] == piece[c][0] for c in group):
                    held.append(piece)
                    continue
                if held:
                    done.append(_links(held, threshold))
                held = [piece]
            if done:
                yield _rows(done)
        if held:
            yield _rows([_links(held, threshold)])

    return (
        dealt.repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(compare, "cls long, n_links long, root long")
    )


def _rows(done: list) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate([d[k] for d in done])) for k in range(3)]
    return pa.RecordBatch.from_arrays(columns, names=["cls", "n_links", "root"])


def _links(pieces: list[pa.RecordBatch], threshold: float):
    tab, i, j = (pieces[0][c][0].as_py() for c in ("tab", "i", "j"))
    cls, n, own = (np.concatenate([p[c].to_numpy() for p in pieces]) for c in ("cls", "n", "own"))
    if len(cls) < 2:
        return cls[:0], n[:0], cls[:0]
    v = np.concatenate([p["v"].flatten().to_numpy(zero_copy_only=False) for p in pieces])
    v = v.reshape(len(cls), -1).astype(np.float64)
    sig = np.frombuffer(b"".join(s.as_py() for p in pieces for s in p["sig"]), "<i4").reshape(len(cls), -1)
    squares = np.einsum("ij,ij->i", v, v)
    norms = np.sqrt(squares)
    links = np.zeros(len(cls), np.int64)
    forest = Forest(len(cls))
    for x in range(0, len(cls), TILE):
        for y in range(x, len(cls), TILE):
            b = slice(y, y + TILE)
            cosine = v[x : x + TILE] @ v[b].T / (norms[x : x + TILE, None] * norms[b])
            a_at, b_at = np.nonzero(cosine >= threshold)
            a_at, b_at = a_at + x, b_at + y
            fresh = a_at < b_at
            if i != j:  # blocks meet here; what is within one has a task of its own
                fresh &= own[a_at] != own[b_at]
            a_at, b_at = a_at[fresh], b_at[fresh]
            forest.unite(a_at, b_at)
            if tab and len(a_at):
                seen = np.zeros(len(a_at), bool)
                for at in range(0, len(a_at), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    seen[part] = (sig[a_at[part], :tab] == sig[b_at[part], :tab]).any(axis=1)
                a_at, b_at = a_at[~seen], b_at[~seen]
            np.add.at(links, a_at, n[b_at])
            np.add.at(links, b_at, n[a_at])
    root = forest.label
    told = (links > 0) | (root != np.arange(len(cls)))
    return cls[told], links[told], cls[root[told]]


def near_vectors(
    table: DataFrame, stage: Staging, threshold: float = THRESHOLD,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = table.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("int").alias("label"),
        F.col(f"`{embedding}`").cast("array<float>").alias("v"),
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = (
        F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite)
        & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable")
    # A class is named by a number of its own: ids may be null or stand in several rows.
    classes = stage.put(
        good.groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("rep"))
        .withColumn("cls", F.monotonically_increasing_id()), "classes",  # fixed once written
    )
    largest = classes.groupBy("label").agg(F.count("*").alias("k")).agg(F.max("k")).first()[0] or 0
    found = stage.put(near_links(classes, largest, threshold), "found")
    counts = found.groupBy("cls").agg(F.sum("n_links").alias("linked"))
    ids = classes.where("rep IS NOT NULL").select("cls", "rep")
    forest = (
        found.where("cls <> root").select("cls", "root").distinct()
        .join(ids.withColumnRenamed("rep", "a"), "cls")
        .join(ids.select(F.col("cls").alias("root"), F.col("rep").alias("b")), "root")
        .select("a", "b")
    )
    several = good.groupBy("vec_id").agg(F.count("*").alias("m")).where("m > 1").select("vec_id")
    shared = good.join(several, "vec_id").join(classes.select("label", "v", "rep"), ["label", "v"]).select(
        F.col("rep").alias("a"), F.col("vec_id").alias("b")
    )
    groups = components(forest.union(shared), stage)
    named = (
        classes.join(counts, "cls", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select("label", "v", F.lit(True).alias("usable"),
                (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return rows.join(named, ["label", "v", "usable"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
