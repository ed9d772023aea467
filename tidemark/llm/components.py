"""Connected components of a distributed edge list, by alternating large and small stars.

Each round rewires edges towards the smallest neighbour until every node points at the smallest id
of its component. Rounds grow with the logarithm of the longest chain. A node's neighbours are only
ever reduced with ``min``, which combines before the shuffle, so a node with very many edges costs
no task more than its share; the join with that minimum is one AQE can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import Staging


def components(edges: DataFrame, stage: Staging, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b`` long); nodes that are their
    own smallest id are left out. Nulls and loops link nothing; repeated edges count once."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    stars = (
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(low.alias("lo"), high.alias("hi"))
        .distinct()
    )
    stars = stage.put(stars, f"{name}-0")
    seen, turn = _state(stars), 0
    while seen[0]:
        turn += 1
        stars = stage.put(_small_star(_large_star(stars)), f"{name}-{turn}")
        now = _state(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _state(stars: DataFrame) -> tuple:
    row = stars.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(stars: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest one."""
    both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))


def _small_star(stars: DataFrame) -> DataFrame:
    """Smaller neighbours of a node move to the smallest of them, and so does the node."""
    least = stars.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = stars.join(least, "hi").where("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.union(least.select(F.col("m").alias("lo"), "hi")).distinct()


class Forest:
    """Union of small sets held in arrays: ``label`` leads to the smallest member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            la, lb = label[a], label[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            if not len(a):
                return
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                upper = label[label]
                if (upper == label).all():
                    break
                label[:] = upper

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Every member with its set's smallest, where they differ."""
        members = np.flatnonzero(self.label != np.arange(len(self.label)))
        return members, self.label[members]
