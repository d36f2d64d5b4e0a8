"""A run of steps on one session: each takes tables by name and gives tables by name; outcomes are rows."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from lodestar.operators.writes import write_version
from lodestar.schemas import RUNS

Step = tuple[str, Callable[[dict[str, DataFrame]], dict[str, DataFrame]], bool]


def run_steps(spark: SparkSession, steps: list[Step], inputs: dict[str, DataFrame], folder: str, version: str, start: str | None = None, dry_run: bool = False, stop_on_warning: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables after all steps, and a row for each step that ran.

    A step is (name, function, critical). What it gives is written as a new version and read again, so lineage ends there; a
    dry run writes nothing. A critical failure ends the run; another one is only noted, or ends it too if ``stop_on_warning``. ``start`` skips the steps before it.
    """
    tables, outcomes = dict(inputs), []
    names = [name for name, _, _ in steps]
    for name, function, critical in steps[names.index(start) if start else 0 :]:
        began, clock, message = datetime.now(UTC), time.monotonic(), None
        try:
            for key, table in function(tables).items():
                tables[key] = table if dry_run else spark.read.parquet(write_version(table, f"{folder}/{key}", version))
        except Exception as error:
            message = str(error)[:500]
        outcomes.append((name, message is None, critical, message, began, time.monotonic() - clock))
        if message is not None and (critical or stop_on_warning):
            break
    return tables, spark.createDataFrame(outcomes, RUNS)
