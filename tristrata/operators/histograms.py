"""Histograms of series values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import auto_bin_count, histogram, point_values
from .lookup import finite_points


def _rows(records: DataFrame, values: Column, bins: Column) -> DataFrame:
    return (
        records.select(F.col("identity.series_key").alias("series_key"), values.alias("v"))
        .select("series_key", histogram(F.col("v"), bins).alias("h"))
        .select(
            "series_key",
            F.posexplode(
                F.transform(
                    "h.counts",
                    lambda c, i: F.struct(
                        F.col("h.edges")[i].alias("lower"), F.col("h.edges")[i + 1].alias("upper"), c.alias("count")
                    ),
                )
            ).alias("bin", "b"),
        )
        .select("series_key", "bin", "b.lower", "b.upper", "b.count")
    )


def value_histogram(records: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins of each given series' non-null values, empty bins included."""
    return _rows(records, point_values(F.col("data")), F.lit(int(bins)))


def value_histogram_auto(records: DataFrame) -> DataFrame:
    """Bins by the automatic width rule over each series' finite points."""
    values = F.transform(finite_points(F.col("data")), lambda p: p["Value"])
    return _rows(records, values, auto_bin_count(F.col("v")))
