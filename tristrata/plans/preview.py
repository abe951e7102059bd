"""Tables behind the preview of one series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import plot_title
from ..operators.histograms import value_histogram
from ..operators.lookup import coerce_year_value, explode_points, lookup_records, lookup_series
from ..operators.sampling import series_by_rank
from .build import Catalogue


@dataclass
class Preview:
    """Title row, points in year order, and value histogram of one series."""

    title: DataFrame
    points: DataFrame
    histogram: DataFrame


def series_preview(
    catalogue: Catalogue,
    series_key: str | None = None,
    rank: int | None = None,
    descending: bool = True,
    dataset: str = "Statistics",
    bins: int = 20,
) -> Preview:
    """Preview by key, or by rank in number of points; an unknown series raises."""
    if (series_key is None) == (rank is None):
        raise ValueError("give either series_key or rank")
    if rank is not None:
        found = series_by_rank(catalogue.l2, rank, descending).select("identity.series_key").first()
        if found is None:
            raise ValueError(f"rank {rank} is beyond the last series")
        series_key = found[0]
    card = lookup_series(catalogue.l2, catalogue.l3, series_key, strict=True)
    records = lookup_records(catalogue.l1, series_key, strict=True)
    clean = records.select("identity", coerce_year_value(F.col("data"), numeric=True).alias("data"))
    return Preview(
        title=card.select(
            F.col("identity.series_key").alias("series_key"),
            plot_title(dataset, F.col("l3"), F.col("dims")).alias("title"),
        ),
        points=explode_points(clean),
        histogram=value_histogram(clean, bins),
    )
