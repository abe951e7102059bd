"""From facts to series: dedup, bundles, statistics, filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Filters
from ..functions.arrays import let, not_nan, point_values, series_properties, variance_of
from ..schema import CODE_DIMS, L3_DIMS, ORDER, SERIES_DIMS
from ..shared import materialize
from .quantiles import exact_quantiles

FIRST = "__first__"


def domain_cards(facts: DataFrame) -> DataFrame:
    """Distinct domain dimensions; never filtered, so empty domains keep their card."""
    return facts.select(*L3_DIMS).distinct()


def drop_null_years(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("Year").isNotNull())


def series_groups(facts: DataFrame) -> DataFrame:
    """One row per series with its raw row count; null dimensions form a group."""
    return facts.groupBy(*SERIES_DIMS).agg(F.count("*").alias("n_rows"))


# Two hashes that together name the codes of a row: numbers, so aggregates stay in hash maps.
CODE_NAMES = ["__code_a", "__code_b"]


def _codes_in(df: DataFrame) -> list[str]:
    return [c for c in CODE_DIMS if c in df.columns]


def _code_names(codes: list[str]) -> list[Column]:
    text = F.to_json(F.struct(*codes), {"ignoreNullFields": "false"})
    return [F.xxhash64(F.lit(salt), text).alias(name) for salt, name in zip("ab", CODE_NAMES)]


def code_sets(facts: DataFrame) -> DataFrame | None:
    """Distinct code tuples of the facts by their names, or None without codes: few, as codes follow dimensions."""
    codes = _codes_in(facts)
    if not codes:
        return None
    return facts.select(*codes).distinct().select(*_code_names(codes), F.struct(*codes).alias("codes"))


def first_codes(facts: DataFrame) -> DataFrame:
    """Codes of the first row of each series, rows without a year included.

    The names of the codes are aggregated and the codes joined back once per series.
    """
    codes = _codes_in(facts)
    named = facts.select(*SERIES_DIMS, ORDER, *_code_names(codes))
    first = named.groupBy(*SERIES_DIMS).agg(*[F.min_by(c, ORDER).alias(c) for c in CODE_NAMES])
    return first.join(code_sets(facts), CODE_NAMES).select(*SERIES_DIMS, *[F.col(f"codes.{c}").alias(c) for c in codes])


def dedup_keep_last(facts: DataFrame, shuffle: str = "spread") -> DataFrame:
    """One row per (series, Year): the value of the last row, null values included.

    The order key is a plain decimal, so the aggregation runs in a hash map and
    combines duplicates before the shuffle: a hot series sends at most one row per
    year and task. Rows without a year stay as one row per series (they count for
    cards and first codes). Codes are carried by their names (``code_sets``).
    """
    codes = _codes_in(facts)
    if shuffle == "colocate":
        facts = facts.repartition(*SERIES_DIMS)
    elif shuffle != "spread":
        raise ValueError(f"shuffle must be 'spread' or 'colocate', got {shuffle!r}")
    named = facts.withColumns({c: name for c, name in zip(CODE_NAMES, _code_names(codes))}) if codes else facts
    return named.groupBy(*SERIES_DIMS, "Year").agg(
        F.max_by("Value", ORDER).alias("Value"),
        F.min(ORDER).alias(FIRST),
        *([F.min_by(c, ORDER).alias(c) for c in CODE_NAMES] if codes else []),
    )


def record_bundles(points: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """One row per series with its (Year, Value) array in year order.

    The array holds one entry per distinct year. Series whose rows all lack a year
    come out with an empty array and are dropped later, after cards were taken.
    ``codes`` (see :func:`code_sets`) puts the codes of the first row back in.
    """
    bundles = points.groupBy(*SERIES_DIMS).agg(
        F.array_sort(
            F.collect_list(
                F.when(F.col("Year").isNotNull(), F.struct("Year", "Value"))
            )
        ).alias("data"),
        F.min(FIRST).alias(FIRST),
        *([F.min_by(c, FIRST).alias(c) for c in CODE_NAMES] if codes is not None else []),
    )
    return bundles if codes is None else bundles.join(codes, CODE_NAMES, "left").drop(*CODE_NAMES)


def series_stats(bundles: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Bundles that have at least one point, with their property struct, whole or ``only`` some fields."""
    filled = bundles.filter(F.size("data") > 0).withColumn("__values", point_values(F.col("data")))
    return filled.withColumn("properties", series_properties(F.col("data"), F.col("__values"), only)).drop("__values")


def point_stats(points: DataFrame) -> DataFrame:
    """Series with their property struct, from deduplicated rows (series dimensions, Year, Value).

    For series too long for an array in one row: two scalar aggregates (range, counts and
    mean; then squared deviations and histogram bins) and exact medians by counting. Each
    combines before it moves, so a single series may hold all rows. Results equal
    :func:`series_stats` up to the order of sums. ``points`` is read four times: write it
    first if it is costly.
    """
    value = F.when(~F.isnan("Value"), F.col("Value"))
    rows = points.where("Year is not null").select(*SERIES_DIMS, "Year", "Value", value.alias("v"))
    seen = F.col("Value").isNotNull()
    first = rows.groupBy(*SERIES_DIMS).agg(
        F.min("Year").alias("year_min"), F.max("Year").alias("year_max"), F.count("*").alias("n_members"),
        F.count_if(F.col("Value") == 0).alias("zeros"), F.count_if(~seen).alias("nulls"), F.min("Value").alias("min"), F.max("Value").alias("max"),
        F.count("Value").alias("__n"), F.try_divide(F.sum("Value"), F.count("Value")).alias("__mean"),
    )
    flat = F.col("min") == F.col("max")
    low, high = F.when(flat, F.col("min") - 0.5).otherwise(F.col("min")), F.when(flat, F.col("max") + 0.5).otherwise(F.col("max"))
    bins = F.least(F.lit(20), F.greatest(F.lit(2), F.floor(F.sqrt("__n")).cast("int")))
    first = materialize(first.select("*", low.alias("__low"), high.alias("__high"), bins.alias("__bins")), "series-ranges")
    edge = lambda i: i * ((F.col("__high") - F.col("__low")) / F.col("__bins")) + F.col("__low")
    inner = F.transform(F.sequence(F.lit(1), F.col("__bins") - 1), edge)
    passed = F.aggregate(inner, F.lit(0), lambda a, e: a + F.when(F.col("Value") >= e, 1).otherwise(0))
    met = rows.where(seen).join(first.select(*SERIES_DIMS, "__mean", "__low", "__high", "__bins"), SERIES_DIMS)
    apart = F.col("Value") - F.col("__mean")
    second = met.groupBy(*SERIES_DIMS, passed.alias("bin")).agg(F.count("*").alias("c"), F.sum(apart * apart).alias("squares"))
    # At most twenty bins a series.
    total = F.sum("c") + F.lit(1e-12)
    binned = second.groupBy(*SERIES_DIMS).agg(
        F.sum("squares").alias("__squares"), F.collect_list(F.col("c")).alias("__counts"), total.alias("__total")
    )
    share = lambda c: c / F.col("__total")
    entropy = F.aggregate("__counts", F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    medians = exact_quantiles(rows.select(*SERIES_DIMS, "v"), "v", [0.5], SERIES_DIMS).select(*SERIES_DIMS, F.col("q0").alias("median"))
    divided = (F.abs("min") != float("inf")) & (F.abs("max") != float("inf")) & (F.size(F.array_distinct(F.concat(F.array("__low"), inner, F.array("__high")))) == F.col("__bins") + 1)
    joined = first.join(binned, SERIES_DIMS, "left").join(medians, SERIES_DIMS, "left")
    return joined.select(
        *SERIES_DIMS,
        F.struct(
            "year_min", "year_max", "n_members", "zeros", "nulls", "min", "max", not_nan(F.col("__mean")).alias("mean"), "median",
            not_nan(F.col("__squares") / F.col("__n")).alias("variance"), F.when(divided, entropy).alias("entropy"),
        ).alias("properties"),
    )


def enough_points(n_members: Column, k: int) -> Column:
    return n_members >= int(k)


def zero_share(n_members: Column, zeros: Column, nulls: Column) -> Column:
    """Zeros over non-null points (at least one)."""
    return zeros / F.greatest(F.lit(1), n_members - nulls)


def has_spread(variance: Column, eps: float = 1e-12) -> Column:
    """True unless the variance is known and negligible."""
    return variance.isNull() | (variance > eps)


def filter_min_points(series: DataFrame, k: int) -> DataFrame:
    return series.filter(enough_points(F.col("properties.n_members"), k))


def filter_zero_share(series: DataFrame, x: float | None) -> DataFrame:
    """Drop series whose share of zeros reaches ``x``; None switches the filter off."""
    if x is None:
        return series
    props = [F.col(f"properties.{p}") for p in ("n_members", "zeros", "nulls")]
    return series.filter(zero_share(*props) < float(x))


def filter_constant(series: DataFrame, eps: float = 1e-12) -> DataFrame:
    """Drop series without spread; series without variance stay."""
    return series.filter(has_spread(F.col("properties.variance"), eps))


def select_bundles(bundles: DataFrame, filters: Filters) -> DataFrame:
    """The same three filters on bundles, before any property is computed.

    Each test reads the point array directly: a test on the property struct would be
    pushed below its projection and compute all properties twice.
    """
    data = F.col("data")
    tests = [F.size(data) > 0, enough_points(F.size(data), filters.min_points)]
    if filters.drop_if_zeros_pct_gte is not None:
        zeros = F.size(F.filter(data, lambda p: p["Value"] == 0))
        nulls = F.size(F.filter(data, lambda p: p["Value"].isNull()))
        tests.append(zero_share(F.size(data), zeros, nulls) < float(filters.drop_if_zeros_pct_gte))
    if filters.drop_constant:
        tests.append(has_spread(let(point_values(data), variance_of)))
    return bundles.filter(reduce(lambda a, b: a & b, tests))


def catalogue_counts(l3: DataFrame, l2: DataFrame) -> DataFrame:
    """One row: number of domains, of series, and of points over all series."""
    domains = l3.agg(F.count("*").alias("domains")).withColumns(
        {"series": F.lit(0).cast("bigint"), "records": F.lit(0).cast("bigint")}
    )
    series = l2.agg(
        F.lit(0).cast("bigint").alias("domains"),
        F.count("*").alias("series"),
        F.coalesce(F.sum("properties.n_members"), F.lit(0).cast("bigint")).alias("records"),
    )
    return domains.unionByName(series).agg(
        *[F.sum(c).alias(c) for c in ("domains", "series", "records")]
    )
