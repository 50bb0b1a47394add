"""Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side[A, B](spark: SparkSession, job: Callable[[A], B], items: Iterable[A], parallelism: int) -> list[B]:
    """Results of `job` over `items`, in order, from `parallelism` threads.

    Each task is wrapped by itself: a wrapper clones the caller's local properties once, and tasks that shared one
    would read and clear each other's.
    """
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        tasks = [pool.submit(inheritable_thread_target(spark)(job), item) for item in items]
        return [t.result() for t in tasks]
