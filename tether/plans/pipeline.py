"""Orchestration: named steps in a fixed order, run in one session, stopped at the first failure."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

# The steps in their order.
STEPS = ["ingest", "eda", "blocking", "features", "model", "stat_validation"]


class UnknownStep(ValueError):
    """A step that does not exist; the command line ends with code 2."""


def resolve(steps: Iterable[str] | None = None, skip_eda: bool = False, skip_model: bool = False) -> list[str]:
    """The steps to run, in their order; skip_model leaves out what needs the model."""
    wanted = list(steps) if steps else STEPS
    if unknown := [s for s in wanted if s not in STEPS]:
        raise UnknownStep(", ".join(unknown))
    left_out = ({"eda"} if skip_eda else set()) | ({"model", "stat_validation"} if skip_model else set())
    return [s for s in STEPS if s in wanted and s not in left_out]


def run(spark: SparkSession, todo: list[str], functions: dict[str, Callable[[SparkSession], object]]) -> DataFrame:
    """step, status ('ok', 'failed', 'not run'), error of every step."""
    rows, failed = [], False
    for s in todo:
        if failed:
            rows.append((s, "not run", None, 0.0))
            continue
        began = time.time()
        try:
            functions[s](spark)
            rows.append((s, "ok", None, time.time() - began))
        except Exception as e:
            failed = True
            rows.append((s, "failed", f"{type(e).__name__}: {e}"[:500], time.time() - began))
    return spark.createDataFrame(rows, "step string, status string, error string, seconds double")
