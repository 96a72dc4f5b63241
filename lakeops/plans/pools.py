"""Jobs side by side, each with its own outcome."""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

Outcome = TypeVar("Outcome")
POOL = "spark.scheduler.pool"
#: Jobs of a driver that wait for nothing but each other; more wait in line.
AT_ONCE = 8


def run_each(spark: SparkSession, jobs: Mapping[str, Callable[[], Outcome]], at_once: int = AT_ONCE) -> dict[str, Outcome | Exception]:
    """What every job returns, or the error that it ends with, which is its own.

    Each runs in a thread and a scheduler pool of its name, so with ``spark.scheduler.mode`` FAIR a large
    one doesn't hold up the others. Scratch tables belong to the scope of the caller.
    """

    def run(name: str, job: Callable[[], Outcome]) -> Outcome | Exception:
        context = spark.sparkContext
        context.setLocalProperty(POOL, name)
        try:
            return job()
        except Exception as error:
            return error
        finally:
            context.setLocalProperty(POOL, None)

    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as threads:
        running = {name: threads.submit(contextvars.copy_context().run, run, name, job) for name, job in jobs.items()}
    return {name: future.result() for name, future in running.items()}


def message_of(error: Exception) -> str:
    """The first line of an error that says something; of Spark's, the line with the condition's name."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    named = [line for line in lines if line.startswith("[") or "Exception: [" in line]
    line = (named or lines or [type(error).__name__])[0]
    return line[line.index("[") :] if "Exception: [" in line else line
