import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import zones

SCHEMA = "vec_id long, embedding array<double>, label long, lo int, dim string, block int"


def brute(rows, every=10, top=5):
    """Whole numbers in Python throughout."""
    rows = [
        (k, lab, [math.floor(256 * x) for x in v])
        for k, v, lab, *_ in rows
        if k is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
        and math.hypot(*(256 * x for x in v)) < zones.LONGEST
    ]
    out = []
    for i, (a, lab, v) in enumerate(rows):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), k, m == lab) for j, (k, m, w) in enumerate(rows) if j != i and len(v) == len(w)]
        for p, pid, _ in sorted(s for s in scored if s[2])[:top]:
            hits = sorted(s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p)[:top]
            out += [(a, pid, r, k, -p, -s) for r, (s, k, _) in enumerate(hits, 1)]
    return sorted(out)


SMALL = zones.Limits(block=8, tile=7, groups=3, strip=2, range=60, held=10)


def mined(spark, rows, scratch, limits=zones.LIMITS):
    df = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], SCHEMA)
    got = zones.hard_negatives(df, scratch, F.col("vec_id") % 10 == 0, F.col("label"), limits=limits)
    return sorted(tuple(r) for r in got.collect())


def cloud(n, dim, labels, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    v = middle[rng.integers(0, centres, n)] + 0.3 * rng.normal(size=(n, dim))
    return [(i, x.tolist(), int(k)) for i, (x, k) in enumerate(zip(v, rng.integers(0, labels, n)))]


def test_clustered_vectors_in_many_blocks_and_tiles(spark, scratch):
    """Small limits: several blocks, tiles, groups and strips, and windows that are cut often."""
    rows = cloud(300, 6, 3, 1)
    want = brute(rows)
    assert len(want) > 300 and mined(spark, rows, scratch, SMALL) == want


def test_odd_rows(spark, scratch):
    rows = cloud(60, 3, 2, 2)
    rows += [(0, [1.0, 2.0, 3.0], 1), (70, None, 1), (80, [1.0, None, 2.0], 1), (90, [float("nan"), 1.0, 1.0], 0),
             (None, [1.0, 1.0, 1.0], 0), (100, [1.0, 1.0, 1.0], None), (110, [], 0), (111, [], 1), (112, [], 0),
             (120, [1e300, 1e300, 0.0], 0), (130, [2e6, 1e6, 1e6], 0), (131, [2e6, 1e6, 1e6], 0), (132, [2e6, 1e6, 1e6], 1),
             (140, [1.0, 0.5], 0), (141, [1.0, 0.5], 0), (142, [0.9, 0.5], 1), (150, [-1.0, -1.0, -1.0], 9), (160, [0.0, 0.0, 0.0], 1)]
    assert mined(spark, rows, scratch) == brute(rows)


def test_copies_of_one_vector(spark, scratch):
    """A group of equal vectors of a third of all rows: ties go to the smallest ids."""
    rows = cloud(200, 4, 3, 3) + [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(100)]
    assert mined(spark, rows, scratch, SMALL) == brute(rows)


def test_no_rows(spark, scratch):
    assert mined(spark, [], scratch) == []


@pytest.mark.parametrize("dim,bits", [(2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dim, bits):
    cells = np.indices([1 << bits] * dim).reshape(dim, -1).T
    keys = zones.hilbert_keys(cells, bits)
    order = np.lexsort(keys.T[::-1])
    assert len(np.unique(keys, axis=0)) == len(cells)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_leave_blocks_unread(spark, scratch):
    """Far clusters: each anchor reads the few blocks that its windows can reach."""
    limits = zones.Limits(block=16)
    rng = np.random.default_rng(5)
    middle = np.eye(8) * 4
    rows = [(i, (middle[i % 8] + 0.05 * rng.normal(size=8)).tolist(), int(rng.integers(0, 2))) for i in range(640)]
    read = []
    wants = zones._Tile.wants
    blocks = zones.write_blocks(
        scratch.put(zones.quantised(spark.createDataFrame([(*r, 1, "d", 2) for r in rows], SCHEMA), "vec_id", "embedding",
                                    F.col("label"), F.col("vec_id") % 10 == 0), "some"), scratch, limits)
    anchors = zones.anchors_of(blocks, scratch).collect()
    for a in anchors[:20]:
        tile = zones._Tile([{"id": a.anchor, "label_lo": a.label, "norm": a.norm, "v": a.v, "low": [a.floor], "high": [zones.HIGHEST]}], True, 5)
        read.append(sum(len(wants(tile, b.asDict())) for b in blocks.collect()))
    assert max(read) <= 0.6 * blocks.count() and sum(read) <= 0.5 * len(read) * blocks.count()
    assert mined(spark, rows, type(scratch)(spark), limits) == brute(rows)
