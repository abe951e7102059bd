"""Characterise a catalogue: property tables, statistics, boxes and the embedding map."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import (
    box_stats,
    box_stats_by_table,
    embedding_coverage,
    long_table,
    numeric_properties,
    properties_table,
    property_stats,
    quartiles,
    usable_embeddings,
)
from ..operators.projection import embedding_map, scatter_tables
from ..schema import L2_DIMS
from ..shared import materialize
from .build import Catalogue


@dataclass
class Diagnostics:
    properties: DataFrame
    numeric: DataFrame
    stats: DataFrame
    boxes: DataFrame
    boxes_by_table: DataFrame
    coverage: DataFrame
    scatter: DataFrame | None = None
    map_facts: dict | None = None


def labelled_embeddings(catalogue: Catalogue) -> DataFrame:
    """Usable embeddings with the seven dimensions of their series as columns."""
    usable = usable_embeddings(catalogue.l2)
    labels = properties_table(usable, catalogue.l3).select(
        "series_key", "Domain", "Sub_domain", "Domain_table", *L2_DIMS
    )
    vectors = usable.select(
        F.col("identity.series_key").alias("series_key"),
        F.col("description.embedding").alias("embedding"),
    )
    return vectors.join(labels, "series_key")


def diagnostics(
    catalogue: Catalogue, with_map: bool = True, sample_n: int | None = None, k: int = 10, seed: int = 42
) -> Diagnostics:
    """All tables of the characterisation; the flat property table is written once."""
    props = materialize(properties_table(catalogue.l2, catalogue.l3), "properties")
    long = long_table(props)
    quarters = quartiles(props, long=long)
    result = Diagnostics(
        properties=props,
        numeric=numeric_properties(props),
        stats=property_stats(props, quarters=quarters),
        boxes=box_stats(props, quarters=quarters, long=long),
        boxes_by_table=box_stats_by_table(props, long=long),
        coverage=embedding_coverage(catalogue.l2),
    )
    if with_map:
        found = embedding_map(
            labelled_embeddings(catalogue), F.col("series_key"), sample_n=sample_n, seed=seed
        )
        if found is not None:
            points, result.map_facts = found
            result.scatter = scatter_tables(materialize(points, "map"), k)
    return result
