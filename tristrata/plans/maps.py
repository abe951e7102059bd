"""Joint map of sampled series and their domains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import is_usable
from ..operators.lookup import label_series
from ..operators.projection import pca_2d_joint, scatter_table
from ..operators.sampling import sample_rows, subsample
from ..schema import CODE_DIMS, L3_DIMS
from ..shared import materialize
from .build import Catalogue


@dataclass
class JointMap:
    """Series points with collapsed label and label count; domain points with symbol."""

    series: DataFrame
    domains: DataFrame


def map_l2_l3(
    catalogue: Catalogue,
    color_dim: str,
    symbol_dim: str = "Domain_table",
    sample_n: int | None = None,
    target_points: int | None = None,
    topk_colors: int = 12,
    seed: int = 42,
    eps: float = 1e-4,
) -> JointMap:
    """Project all series, or ``sample_n`` of them, and all domains into one space.

    ``color_dim`` is any dimension of the domains or series, codes included where the
    catalogue has them.
    """
    usable = catalogue.l2.filter(is_usable(F.col("description.embedding"), finite=False))
    key = F.col("identity.series_key")
    chosen = usable if sample_n is None else sample_rows(usable, key, sample_n, seed)
    sample = subsample(chosen, key, target_points, seed)
    extra = [color_dim] if color_dim in CODE_DIMS else []
    series = materialize(label_series(sample, catalogue.l3, extra), "map-series")
    if extra and series.where(F.col(color_dim) != "").isEmpty():
        raise ValueError(f"no series has the colour dimension '{color_dim}'")
    domains = catalogue.l3.filter(is_usable(F.col("description.embedding"), finite=False)).select(
        F.col("identity.domain_key").alias("domain_key"),
        *[F.coalesce(F.try_element_at("dims", F.lit(d)), F.lit("")).alias(d) for d in L3_DIMS],
        F.col("description.embedding").alias("embedding"),
    )
    if color_dim not in series.columns:
        raise ValueError(f"unknown colour dimension '{color_dim}', have {sorted(series.columns)}")
    if symbol_dim not in domains.columns:
        raise ValueError(f"unknown symbol dimension '{symbol_dim}', have {sorted(domains.columns)}")
    for level, df in (("series", series), ("domain", domains)):
        if df.isEmpty():
            raise RuntimeError(f"no embeddings in the {level} level")
    a, b = pca_2d_joint(series, domains, "series_key", "domain_key", seed=seed, eps=eps)
    # Labels are counted on the written points; they are not projected again for that.
    a = materialize(a.drop("embedding"), "map-points")
    symbol = F.when(F.col(symbol_dim) == "", "(empty)").otherwise(F.col(symbol_dim))
    return JointMap(
        series=scatter_table(a, color_dim, topk_colors, "Other", "(empty)"),
        domains=b.withColumn("symbol", symbol),
    )
