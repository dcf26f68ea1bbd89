"""Running independent Spark jobs side by side from a few driver threads."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def inheriting(fn: Callable) -> Callable:
    """``fn`` wrapped to run in a worker thread with the caller's local
    properties, tags (job group, description, scheduler pool) and scratch scope."""
    session, context = SparkSession.getActiveSession(), copy_context()

    def inside(*args):
        return context.run(fn, *args)

    return inheritable_thread_target(session)(inside) if session is not None else inheritable_thread_target(inside)


def concurrently(*builders: Callable[[], object]) -> list:
    """Run independent builders (each ending in its own Spark jobs) from a
    few driver threads, so their small jobs share the task slots instead of
    queueing one after another. Results come back in argument order; the
    threads inherit the caller's job group, description and scheduler pool."""
    with ThreadPoolExecutor(max_workers=max(1, len(builders))) as pool:
        futures = [pool.submit(inheriting(b)) for b in builders]
        return [f.result() for f in futures]
