"""Two-dimensional principal-component maps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import is_usable
from ..schema import SERIES_DIMS
from ..shared import materialize
from .profile import collapse_dims
from .sampling import sample_rows

AXES = ["Dim 1", "Dim 2"]
MIN_EMBEDDINGS = 10


@dataclass
class Axes:
    """Fitted projection: apply it to any frame with vectors of the same size."""

    n_used: int
    explained_variance_ratio: list[float]
    stages: PipelineModel | None = None
    signs: tuple[float, float] = (1.0, 1.0)

    def project(self, df: DataFrame, vec_col: str = "embedding", finite: bool = True) -> DataFrame:
        """Usable rows with both coordinates; the origin when a single row was fitted."""
        used = df.filter(is_usable(F.col(vec_col), finite))
        if self.stages is None:
            return _with_axes(used, F.lit(0.0), F.lit(0.0))
        axes = vector_to_array("__p")
        placed = self.stages.transform(_vectors(used, vec_col))
        return _with_axes(
            placed, axes[0] * F.lit(self.signs[0]), axes[1] * F.lit(self.signs[1])
        ).drop("__v", "__c", "__p")


@dataclass
class Projection:
    """Projected rows and the share of variance each axis explains."""

    rows: DataFrame
    n_used: int
    explained_variance_ratio: list[float]


def _with_axes(df: DataFrame, first: Column, second: Column) -> DataFrame:
    return df.withColumns({AXES[0]: first.cast("float"), AXES[1]: second.cast("float")})


def _vectors(df: DataFrame, vec_col: str) -> DataFrame:
    return df.withColumn("__v", array_to_vector(F.transform(vec_col, lambda x: x.cast("double"))))


def fit_axes(df: DataFrame, vec_col: str = "embedding", finite: bool = True) -> Axes:
    """Centre the usable vectors and find their first two components.

    The sign of each axis is fixed so that its loading of largest magnitude is positive.
    The fit reduces to a d×d covariance summed in a tree; only means and the two loading
    vectors reach the driver.
    """
    used = df.filter(is_usable(F.col(vec_col), finite)).select(vec_col)
    n = used.count()
    if n < 2:
        return Axes(n, [])
    centre = StandardScaler(inputCol="__v", outputCol="__c", withMean=True, withStd=False)
    stages = Pipeline(stages=[centre, PCA(k=2, inputCol="__c", outputCol="__p")]).fit(_vectors(used, vec_col))
    model = stages.stages[-1]
    signs = tuple(
        1.0 if axis[np.argmax(np.abs(axis))] >= 0 else -1.0 for axis in model.pc.toArray().T
    )
    return Axes(n, [float(x) for x in model.explainedVariance.toArray()], stages, signs)


def pca_2d(df: DataFrame, vec_col: str = "embedding", finite: bool = True) -> Projection:
    """Fit on the usable rows of ``df`` and project them.

    No usable row gives an empty result and one row gives the origin.
    """
    axes = fit_axes(df, vec_col, finite)
    return Projection(axes.project(df, vec_col, finite), axes.n_used, axes.explained_variance_ratio)


def is_collapsed(df: DataFrame) -> Column:
    """True when both variances are below 1e-18, or at most two distinct points remain
    after rounding to 12 digits. Counting distinct points stops at three.
    """
    x, y = (F.col(f"`{a}`") for a in AXES)
    flat = df.agg(
        F.coalesce((F.var_pop(x) < 1e-18) & (F.var_pop(y) < 1e-18), F.lit(False))
    ).scalar()
    few = (
        df.select(F.round(x.cast("double"), 12), F.round(y.cast("double"), 12))
        .distinct().limit(3).agg(F.count("*") <= 2).scalar()
    )
    return flat | few


def jitter(df: DataFrame, collapsed: Column, key: Column, seed: int = 42, eps: float = 1e-4) -> DataFrame:
    """Gaussian noise on both axes where ``collapsed``; it depends on key and seed only."""
    x, y = (F.col(f"`{a}`") for a in AXES)

    def uniform(salt: str) -> Column:
        h = F.xxhash64(F.lit(f"{seed}|{salt}"), key)
        return (F.pmod(h, F.lit(1 << 40)) + 0.5) / float(1 << 40)

    radius = F.sqrt(-2.0 * F.log(uniform("r"))) * float(eps)
    angle = uniform("a") * float(2 * np.pi)
    return _with_axes(
        df,
        F.when(collapsed, x + radius * F.cos(angle)).otherwise(x),
        F.when(collapsed, y + radius * F.sin(angle)).otherwise(y),
    )


def jitter_if_degenerate(df: DataFrame, key: Column, seed: int = 42, eps: float = 1e-4) -> DataFrame:
    """Add small noise when the points of ``df`` have collapsed."""
    return jitter(df, is_collapsed(df), key, seed, eps)


def pca_2d_joint(
    a: DataFrame,
    b: DataFrame,
    key_a: str,
    key_b: str,
    vec_col: str = "embedding",
    seed: int = 42,
    eps: float = 1e-4,
) -> tuple[DataFrame, DataFrame]:
    """Project two frames into one space fitted on both together.

    Unusable rows are dropped; either frame may be empty. The fitted axes are applied to
    each frame in place, so no rows have to be matched up again.
    """
    for df in (a, b):
        if vec_col not in df.columns:
            raise KeyError(f"both frames need the column '{vec_col}'")
    axes = fit_axes(a.select(vec_col).unionByName(b.select(vec_col)), vec_col, finite=False)
    placed = [axes.project(df, vec_col, finite=False) for df in (a, b)]
    collapsed = is_collapsed(placed[0].select(*AXES).unionByName(placed[1].select(*AXES)))
    return tuple(
        jitter(df, collapsed, F.concat(F.lit(side), F.col(key).cast("string")), seed, eps)
        for df, side, key in zip(placed, "ab", (key_a, key_b))
    )


def pca_meta(total: int, projection: Projection, seed: int, sample_n: int | None) -> dict:
    ratio = projection.explained_variance_ratio
    return {
        "method": "pca",
        "n_total_embeddings": total,
        "n_used": projection.n_used,
        "explained_variance_ratio": ratio,
        "seed": seed,
        "sample_n": sample_n,
    }


def embedding_map(
    df: DataFrame, key: Column, vec_col: str = "embedding", sample_n: int | None = None, seed: int = 42
) -> tuple[DataFrame, dict] | None:
    """Map of all usable vectors, or ``sample_n`` of them, with its facts; None with fewer than ten."""
    usable = df.filter(is_usable(F.col(vec_col)))
    total = usable.count()
    if total < MIN_EMBEDDINGS:
        return None
    sample = usable if sample_n is None else sample_rows(usable, key, sample_n, seed)
    # Fitting reads the vectors several times; they are gathered once.
    sample = materialize(sample, "sample")
    projection = pca_2d(sample, vec_col)
    return projection.rows, pca_meta(total, projection, seed, sample_n)


def scatter_table(points: DataFrame, color_dim: str, k: int = 10, other: str = "(other)", empty: str | None = None) -> DataFrame:
    """Points with the collapsed label of one dimension and that label's count."""
    if color_dim not in points.columns:
        raise ValueError(f"unknown dimension '{color_dim}', have {sorted(points.columns)}")
    return collapse_dims(points, [color_dim], k, other, empty)


def scatter_tables(points: DataFrame, k: int = 10) -> DataFrame:
    """One table per series dimension, stacked: the points are counted once for all of them."""
    return collapse_dims(points, SERIES_DIMS, k, "(other)", None)
