"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target


def run_parallel(tasks: Sequence[Callable[[], object]], parallelism: int = 4) -> list:
    """Runs jobs from a bounded thread pool; results keep the order of the tasks."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks) or 1))) as pool:
        futures = [pool.submit(inheritable_thread_target(t)) for t in tasks]
        return [f.result() for f in futures]
