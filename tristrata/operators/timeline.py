"""Stage durations and run summaries of a milestone log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_seconds(events: DataFrame, position: str, run: str = "run_id", strict: bool = True) -> DataFrame:
    """Seconds from the first ``<stage>.start`` to the last ``<stage>.done`` after it.

    Event order is the ``position`` column. The last ``done`` of a stage counts when it
    follows the first ``start``; other events are ignored. Plain minima and maxima, so
    events combine map-side and a stage of any size stays cheap. ``strict=False`` also
    takes a ``done`` at the position of its ``start``, as when a clock is the position.
    """
    name, pos = F.col("name"), F.col(position)
    t = F.coalesce("t_seconds", F.lit(0.0))
    start, done = name.endswith(".start"), name.endswith(".done") & ~name.endswith(".start")
    stage = F.when(start, F.expr("left(name, length(name) - 6)")).when(
        done, F.expr("left(name, length(name) - 5)")
    )
    marks = events.withColumn("stage", stage).filter(F.col("stage").isNotNull())
    return (
        marks.groupBy(run, "stage")
        .agg(
            F.min(F.when(start, pos)).alias("first"),
            F.max(F.when(done, pos)).alias("last"),
            F.min_by(t, F.when(start, pos)).alias("t0"),
            F.max_by(t, F.when(done, pos)).alias("t1"),
        )
        .filter(F.col("last") > F.col("first") if strict else F.col("last") >= F.col("first"))
        .select(run, "stage", (F.col("t1") - F.col("t0")).alias("seconds"))
    )


def run_summary(events: DataFrame, position: str, run: str = "run_id") -> DataFrame:
    """Per run: number of events and time of the last one."""
    return events.groupBy(run).agg(
        F.count("*").alias("n_events"),
        F.max_by(F.coalesce("t_seconds", F.lit(0.0)), position).alias("total_wall_seconds"),
    )
