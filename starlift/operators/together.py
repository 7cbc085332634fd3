"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def together(spark: SparkSession, *tasks: Callable[[], Result]) -> list[Result]:
    """Run jobs that do not depend on each other at the same time, so small tables do
    not queue behind large ones. All end before the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(tasks) or 1) as pool:
        ended = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    return [task.result() for task in ended]
