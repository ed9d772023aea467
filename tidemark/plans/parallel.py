"""Independent per-table jobs submitted from several driver threads.

Each call only submits Spark jobs; the work itself runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def for_each(
    spark: SparkSession, fn: Callable[[Item], Result], items: Sequence[Item], workers: int = 8
) -> list[Result]:
    """``fn`` of every item, in the order of the items; the first error is raised."""
    if not items:
        return []
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fn), items))
