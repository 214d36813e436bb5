"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(spark: SparkSession, *steps: Callable[[], T]) -> list[T]:
    """Run steps that start jobs at the same time, so that small jobs fill each other's gaps."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        jobs = [pool.submit(inherit(partial(copy_context().run, step))) for step in steps]
        return [job.result() for job in jobs]
