"""Independent Spark actions started at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(steps: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """Results of independent steps, run at once so that small jobs fill the gaps of
    large ones. Job groups, pools and other properties of the caller hold in them as
    well. The first failure is raised after the others have ended."""
    inherited = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max_workers=max(len(steps), 1)) as pool:
        running = {name: pool.submit(inherited(step)) for name, step in steps.items()}
    return {name: step.result() for name, step in running.items()}
