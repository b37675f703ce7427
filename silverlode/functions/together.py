"""Several independent jobs at once, so that the last tasks and the commit of one do not leave the cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_together(spark: SparkSession, steps: Sequence[Callable[[], T]]) -> list[T]:
    """What each step returns, in order. The steps run in threads with the scratch scope and the job properties of the caller.

    All steps come to an end before the first error, in the order of the steps, is raised.
    """
    if not steps:
        return []
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inherit(copy_context().run), step) for step in steps]
    return [one.result() for one in started]
