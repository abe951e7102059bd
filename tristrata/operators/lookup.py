"""Navigate the levels: labels, point lookups, points of a series, expansion, cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_value, parse_year
from ..functions.text import extra_dims, plot_header
from ..schema import L2_DIMS, L3_DIMS

# Properties shown on a card.
CARD_PROPERTIES = ["n_members", "year_min", "year_max", "zeros", "nulls", "trainable"]


def _dim(dims: Column, name: str) -> Column:
    return F.try_element_at(dims, F.lit(name))


def domain_labels(domains: DataFrame) -> DataFrame:
    """One row per domain key with its dimension map; of equal keys the last card counts."""
    placed = domains.select(
        F.col("identity.domain_key").alias("domain_key"), "dims", F.monotonically_increasing_id().alias("at")
    )
    return placed.groupBy("domain_key").agg(F.max_by("dims", "at").alias("l3"))


def with_domain_dims(df: DataFrame, domains: DataFrame) -> DataFrame:
    """Left join of the domain dimension map (``l3``) on ``identity.domain_key``.

    No broadcast hint: the planner broadcasts the domains when their measured size is
    below the session's limit and otherwise sort-merges, splitting a hot domain key.
    """
    return (
        df.withColumn("domain_key", F.col("identity.domain_key"))
        .join(domain_labels(domains), "domain_key", "left")
    )


def label_series(series: DataFrame, domains: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Series with their domain labels; an unknown domain yields empty labels.

    ``extra`` names further series dimensions (codes, say), empty where a series has none.
    """
    return with_domain_dims(series, domains).select(
        "domain_key",
        F.col("identity.series_key").alias("series_key"),
        *[F.coalesce(_dim(F.col("l3"), d), F.lit("")).alias(d) for d in L3_DIMS],
        *[F.coalesce(_dim(F.col("dims"), d), F.lit("")).alias(d) for d in [*L2_DIMS, *extra]],
        F.coalesce("properties.n_members", F.lit(0)).alias("n_members"),
        F.col("description.embedding").alias("embedding"),
    )


def fallback_labels(l3: Column, domain_key: Column) -> dict[str, Column]:
    """Labels that accept lower-case names; the table falls back to the key itself."""
    def pick(name: str, default: Column) -> Column:
        parts = [F.nullif(_dim(l3, n), F.lit("")) for n in (name, name.lower())]
        return F.coalesce(*parts, default)

    empty = F.lit("")
    return {
        "Domain": pick("Domain", empty),
        "Sub_domain": pick("Sub_domain", empty),
        "Domain_table": pick("Domain_table", domain_key),
    }


def label_series_with_fallback(series: DataFrame, domains: DataFrame) -> DataFrame:
    joined = with_domain_dims(series, domains)
    labels = fallback_labels(F.col("l3"), F.col("domain_key"))
    return joined.select(
        "domain_key",
        F.col("identity.series_key").alias("series_key"),
        *[c.alias(n) for n, c in labels.items()],
    )


def _found(df: DataFrame, key: str, strict: bool) -> DataFrame:
    if strict and df.isEmpty():
        raise KeyError(f"series_key not found: {key}")
    return df


def lookup_records(records: DataFrame, series_key: str, strict: bool = False) -> DataFrame:
    """Record bundle of one series; ``strict`` checks at once and raises when absent."""
    return _found(records.filter(F.col("identity.series_key") == series_key), series_key, strict)


def lookup_series(
    series: DataFrame, domains: DataFrame, series_key: str, strict: bool = False
) -> DataFrame:
    """Card of one series with its domain dimensions as ``l3``."""
    card = series.filter(F.col("identity.series_key") == series_key)
    return with_domain_dims(_found(card, series_key, strict), domains).withColumn(
        "l3", F.coalesce("l3", F.create_map().cast("map<string,string>"))
    )


def records_for_keys(records: DataFrame, keys: DataFrame | Sequence[str]) -> DataFrame:
    """Records whose series key is in the given set, each record once."""
    key = F.col("identity.series_key")
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(keys.columns[0]).alias("__key"))
        return records.join(wanted, key == wanted["__key"], "left_semi")
    wanted = records.sparkSession.createDataFrame([(k,) for k in keys], "__key string")
    return records_for_keys(records, wanted)


def coerce_year_value(data: Column, numeric: bool = False) -> Column:
    """Points with a readable year, numbers coerced, in year order.

    Texts are read as in the build, so ``1d`` is no number; ``numeric`` says that both
    fields are numbers already.
    """
    points = F.transform(
        data,
        lambda p: F.struct(
            parse_year(p["Year"] if numeric else p["Year"].cast("string"), numeric).alias("Year"),
            parse_value(p["Value"] if numeric else p["Value"].cast("string"), numeric).alias("Value"),
        ),
    )
    return F.array_sort(F.filter(points, lambda p: p["Year"].isNotNull()))


def finite_points(data: Column) -> Column:
    """Points with a year and a finite value in year order; fewer than two become none."""
    kept = F.filter(
        data,
        lambda p: p["Year"].isNotNull()
        & p["Value"].isNotNull()
        & ~F.isnan(p["Value"])
        & (F.abs(p["Value"]) != float("inf")),
    )
    return F.when(F.size(kept) >= 2, F.array_sort(kept)).otherwise(F.slice(kept, 1, 0))


def explode_points(records: DataFrame, data: Column | None = None) -> DataFrame:
    """Long form: one row per point."""
    data = F.col("data") if data is None else data
    return records.select(
        F.col("identity.series_key").alias("series_key"), F.inline(data)
    )


def expand_hierarchy(domains: DataFrame, series: DataFrame, records: DataFrame) -> DataFrame:
    """Flat view domain → series → point; a series without points keeps one row."""
    l3 = domain_labels(domains).select("domain_key", *[_dim(F.col("l3"), d).alias(d) for d in L3_DIMS])
    l2 = series.select(
        F.col("identity.domain_key").alias("domain_key"),
        F.col("identity.series_key").alias("series_key"),
        *[_dim(F.col("dims"), d).alias(d) for d in L2_DIMS],
    )
    l1 = records.select(F.col("identity.series_key").alias("series_key"), "data")
    return (
        l2.join(l3, "domain_key")
        .join(l1, "series_key")
        .select("domain_key", "series_key", *L3_DIMS, *L2_DIMS, F.inline_outer("data"))
    )


def series_cards(
    series: DataFrame, domains: DataFrame, records: DataFrame, dataset: str
) -> DataFrame:
    """Nested cards of the given (usually sampled) series with domain context and points."""
    bundles = records.select(
        F.col("identity.series_key").alias("series_key"),
        finite_points(F.col("data")).alias("points"),
    )
    empty = F.create_map().cast("map<string,string>")
    available = series.schema["properties"].dataType.names
    joined = (
        with_domain_dims(series, domains)
        .withColumn("series_key", F.col("identity.series_key"))
        .join(bundles, "series_key", "left")
        .withColumns({"l3": F.coalesce("l3", empty), "l2": F.coalesce("dims", empty)})
    )
    return joined.select(
        "series_key",
        "domain_key",
        plot_header(dataset, F.col("l3"), F.col("l2")).alias("header"),
        F.col("l3").alias("dims_l3"),
        F.col("l2").alias("dims_l2"),
        extra_dims(F.col("l2")).alias("extra_dims"),
        F.struct(*[
            (F.col(f"properties.{p}") if p in available else F.lit(None).cast("string")).alias(p)
            for p in CARD_PROPERTIES
        ]).alias("properties"),
        F.coalesce(F.array_size("points"), F.lit(0)).alias("n_points"),
        F.array_min(F.transform("points", lambda p: p["Year"])).alias("year_min"),
        F.array_max(F.transform("points", lambda p: p["Year"])).alias("year_max"),
        "points",
    )
