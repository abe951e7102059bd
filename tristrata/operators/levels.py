"""Shape grouped series into the three document levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import domain_description, domain_key, series_description, series_key
from ..schema import CODE_DIMS, KIND, L2_DIMS, L3_DIMS, LEVEL_SCHEMAS, SCHEMA_VERSION, SERIES_PROPERTIES
from .series import FIRST


def _description(text: Column) -> Column:
    return F.struct(
        text.alias("string"), F.lit(None).cast("array<float>").alias("embedding")
    )


def _embedding_meta(model: str | None) -> Column:
    return F.struct(
        F.lit(model).cast("string").alias("embedding_model"),
        F.lit(0).alias("embedding_dim"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def _head(level: str) -> list[Column]:
    return [F.lit(KIND[level]).alias("kind"), F.lit(SCHEMA_VERSION).alias("schema_version")]


def _map(names: list[str], values: dict[str, Column] | None = None) -> Column:
    values = values or {}
    return F.create_map(*[x for n in names for x in (F.lit(n), values.get(n, F.col(n)))])


def _finish(df: DataFrame, level: str, ordered: bool) -> DataFrame:
    if ordered and FIRST in df.columns:
        df = df.orderBy(FIRST)
    return df.select(*LEVEL_SCHEMAS[level].names)


def domain_level(
    cards: DataFrame, dataset: str, model: str | None = None, ordered: bool = False
) -> DataFrame:
    """L3 documents from distinct domain dimensions."""
    return _finish(
        cards.select(
            *_head("l3"),
            F.struct(domain_key().alias("domain_key")).alias("identity"),
            _map(L3_DIMS).alias("dims"),
            _description(domain_description(dataset)).alias("description"),
            _embedding_meta(model).alias("embedding_meta"),
            *([FIRST] if FIRST in cards.columns else []),
        ),
        "l3",
        ordered,
    )


def with_keys(series: DataFrame) -> DataFrame:
    """Add both keys once per series, after grouping, for every level to use."""
    return series.withColumns({"domain_key": domain_key(), "series_key": series_key()})


def series_level(
    series: DataFrame, dataset: str, model: str | None = None, ordered: bool = False
) -> DataFrame:
    """L2 documents from keyed series with properties; codes become extra dimensions."""
    dims = _map(L2_DIMS)
    if "codes" in series.columns:
        names = [c for c in CODE_DIMS if c in series.schema["codes"].dataType.names]
        dims = F.map_concat(
            dims,
            _map(names, {c: F.coalesce(F.col(f"codes.{c}"), F.lit("")) for c in names}),
        )
    return _finish(
        series.select(
            *_head("l2"),
            F.struct("domain_key", "series_key").alias("identity"),
            dims.alias("dims"),
            _description(series_description(dataset)).alias("description"),
            F.col("properties").cast(SERIES_PROPERTIES).alias("properties"),
            _embedding_meta(model).alias("embedding_meta"),
            *([FIRST] if FIRST in series.columns else []),
        ),
        "l2",
        ordered,
    )


def records_level(series: DataFrame, ordered: bool = False) -> DataFrame:
    """L1 documents from keyed series: one (Year, Value) bundle per series."""
    return _finish(
        series.select(
            *_head("l1"),
            F.struct("domain_key", "series_key").alias("identity"),
            F.col("data").cast(LEVEL_SCHEMAS["l1"]["data"].dataType).alias("data"),
            *([FIRST] if FIRST in series.columns else []),
        ),
        "l1",
        ordered,
    )
