"""Follow a milestone log while it is being appended to.

The log is a folder of JSON-lines files that only grows. The batch operators in
``operators.timeline`` apply unchanged: their minima and maxima are kept as streaming
state, one small row per run and stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.timeline import run_summary, stage_seconds
from ..schema import MILESTONE


def read_milestones(spark: SparkSession, path: str) -> DataFrame:
    """Streaming scan of the log folder."""
    return spark.readStream.schema(MILESTONE).json(path)


def follow_stage_seconds(events: DataFrame) -> DataFrame:
    """Running stage durations; the clock of a run orders its events, so a stage may last no time."""
    return stage_seconds(events, "t_seconds", strict=False)


def follow_run_summary(events: DataFrame) -> DataFrame:
    return run_summary(events, "t_seconds")
