"""Profile the series level: property tables, statistics, boxes, category counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import is_usable
from ..schema import L2_DIMS, PROPERTIES
from ..shared import materialize
from .lookup import fallback_labels, with_domain_dims
from .quantiles import exact_quantiles

PREFIX = "prop__"


def properties_table(series: DataFrame, domains: DataFrame) -> DataFrame:
    """Flat table: keys, seven dimensions and every property as ``prop__<name>``."""
    usable = series.filter(
        (F.coalesce("identity.series_key", F.lit("")) != "")
        & (F.coalesce("identity.domain_key", F.lit("")) != "")
    )
    joined = with_domain_dims(usable, domains)
    return joined.select(
        F.col("identity.series_key").alias("series_key"),
        "domain_key",
        *[c.alias(n) for n, c in fallback_labels(F.col("l3"), F.col("domain_key")).items()],
        *[F.try_element_at("dims", F.lit(d)).alias(d) for d in L2_DIMS],
        *[F.col(f"properties.{p}").alias(f"{PREFIX}{p}") for p in PROPERTIES],
    )


def usable_embeddings(series: DataFrame, finite: bool = True) -> DataFrame:
    """Series with a usable embedding."""
    return series.filter(is_usable(F.col("description.embedding"), finite))


def embedding_coverage(series: DataFrame) -> DataFrame:
    """One row: series, usable embeddings, missing embeddings."""
    vec = F.col("description.embedding")
    return series.agg(
        F.count("*").alias("n_series"),
        F.count_if(is_usable(vec)).alias("n_usable"),
        F.count_if(vec.isNull()).alias("n_missing"),
    )


def _property_names(props: DataFrame) -> list[str]:
    return [c[len(PREFIX):] for c in props.columns if c.startswith(PREFIX)]


def _number(name: str) -> str:
    """SQL for a property as a double with NaN as null."""
    return f"nullif(cast(`{PREFIX}{name}` as double), double('NaN'))"


def property_summary(props: DataFrame) -> DataFrame:
    """Per property: rows, non-null count, min, max, mean, sample deviation.

    One aggregate over the wide table; only its single result row is turned long.
    """
    names = _property_names(props)
    wide = props.selectExpr(*[f"{_number(n)} as `{n}`" for n in names]).agg(
        F.count("*").alias("rows"),
        *[
            F.expr(
                f"struct('{n}' as property, count(`{n}`) as n, min(`{n}`) as min, max(`{n}`) as max, "
                f"avg(`{n}`) as mean, coalesce(stddev_samp(`{n}`), 0.0D) as std) as `{n}`"
            )
            for n in names
        ],
    )
    return wide.selectExpr("rows", f"inline(array({', '.join(f'`{n}`' for n in names)}))")


def numeric_properties(props: DataFrame, min_n: int = 50, min_coverage: float = 0.60) -> DataFrame:
    """Properties with enough non-null values, most complete first."""
    return (
        property_summary(props)
        .withColumn("coverage", F.col("n") / F.greatest(F.col("rows"), F.lit(1)))
        .filter((F.col("n") >= min_n) & (F.col("coverage") > min_coverage))
        .select("property", "n", "coverage")
        .orderBy(F.desc("n"), "property")
    )


def long_properties(props: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(property, value) rows of non-null values, with the ``keep`` columns."""
    pairs = ", ".join(
        f"struct('{n}' as property, {_number(n)} as value)" for n in _property_names(props)
    )
    return props.selectExpr(*keep, f"inline(array({pairs}))").filter("value is not null")


def long_table(props: DataFrame) -> DataFrame:
    """(property, value), with Domain_table if there is one, written once for every quartile and whisker."""
    return materialize(long_properties(props, [c for c in ("Domain_table",) if c in props.columns]), "properties-long")


def quartiles(props: DataFrame, groups: Sequence[str] = ("property",), long: DataFrame | None = None) -> DataFrame:
    """Exact quartiles per property (and table), written once for several consumers.

    ``long`` takes the result of :func:`long_table` when it is already at hand.
    """
    long = long_table(props) if long is None else long
    return materialize(exact_quantiles(long, "value", [0.25, 0.5, 0.75], groups), "quartiles")


def property_stats(
    props: DataFrame, min_n: int = 50, min_coverage: float = 0.60, quarters: DataFrame | None = None
) -> DataFrame:
    """n, min, p25, median, mean, p75, max, std of each numeric property.

    ``quarters`` takes the result of :func:`quartiles` when it is already at hand.
    """
    summary = property_summary(props).filter(
        (F.col("n") >= min_n)
        & (F.col("n") / F.greatest(F.col("rows"), F.lit(1)) > min_coverage)
    )
    quarters = quartiles(props) if quarters is None else quarters
    return (
        summary.join(quarters.drop("n"), "property")
        .select(
            "property", "n", "min", F.col("q0").alias("p25"), F.col("q1").alias("median"),
            "mean", F.col("q2").alias("p75"), "max", "std",
        )
        .orderBy(F.desc("n"), "property")
    )


def _boxes(long: DataFrame, groups: list[str], quarters: DataFrame) -> DataFrame:
    reach = (F.col("q2") - F.col("q0")) * 1.5
    inside = long.join(quarters.drop("n"), groups).groupBy(*groups).agg(
        F.min(F.when(F.col("value") >= F.col("q0") - reach, F.col("value"))).alias("low"),
        F.max(F.when(F.col("value") <= F.col("q2") + reach, F.col("value"))).alias("high"),
    )
    return quarters.join(inside, groups).select(
        *groups,
        "n",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        F.least("low", "q0").alias("whisker_low"),
        F.greatest("high", "q2").alias("whisker_high"),
    )


def box_stats(
    props: DataFrame, min_n: int = 50, min_coverage: float = 0.60, quarters: DataFrame | None = None, long: DataFrame | None = None
) -> DataFrame:
    """Quartiles and 1.5·IQR whiskers of each numeric property; outliers are left out."""
    numeric = numeric_properties(props, min_n, min_coverage).select("property")
    long = long_table(props) if long is None else long
    quarters = quartiles(props, long=long) if quarters is None else quarters
    return _boxes(long, ["property"], quarters).join(numeric, "property", "left_semi")


def box_stats_by_table(props: DataFrame, min_n: int = 50, min_coverage: float = 0.60, long: DataFrame | None = None) -> DataFrame:
    """As :func:`box_stats` per domain table, for properties with data there."""
    numeric = numeric_properties(props, min_n, min_coverage).select("property")
    groups = ["Domain_table", "property"]
    long = long_table(props) if long is None else long
    return _boxes(long, groups, quartiles(props, groups, long)).join(numeric, "property", "left_semi")


def collapse_dims(
    df: DataFrame, dims: Sequence[str], k: int = 12, other: str = "Other", empty: str | None = "(empty)"
) -> DataFrame:
    """One row per row of ``df`` and dimension: its columns, ``dim``, the collapsed ``label`` and that label's count.

    All dimensions are counted in one pass over (dimension, label) pairs, combined before
    they move; each dimension's ``k`` most frequent labels (ties by label) come from
    group-limited ranks, and one join brings them back. Labels as in :func:`collapse_topk`.
    """

    def text(dim: str) -> Column:
        value = F.coalesce(F.col(dim).cast("string"), F.lit(""))
        return value if empty is None else F.when(value == "", empty).otherwise(value)

    pairs = F.inline(F.array(*[F.struct(F.lit(d).alias("dim"), text(d).alias("__label")) for d in dims]))
    counts = df.select(pairs).groupBy("dim", "__label").agg(F.count("*").alias("__n"))
    order = Window.partitionBy("dim").orderBy(F.desc("__n"), "__label")
    # At most k rows per dimension; written, so that the planner sees how small they are.
    kept = materialize(counts.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= int(k)).drop("__r"), "top-labels")
    held = kept.groupBy("dim").agg(F.sum("__n").alias("__held"), F.sum(F.when(F.col("__label") == other, F.col("__n"))).alias("__same"))
    rest = df.agg(F.count("*").alias("__all")).join(held).select(
        "dim", (F.col("__all") - F.col("__held") + F.coalesce("__same", F.lit(0))).alias("__rest")
    )
    # A label that reads like the collapsed one is counted with it.
    told = kept.join(rest, "dim").select(
        "dim", "__label", F.when(F.col("__label") == other, F.col("__rest")).otherwise(F.col("__n")).alias("__n")
    )
    placed = df.select("*", pairs).join(told, ["dim", "__label"], "left").join(rest, "dim")
    return placed.select(
        *df.columns, "dim", F.when(F.col("__n").isNotNull(), F.col("__label")).otherwise(F.lit(other)).alias("label"),
        F.coalesce("__n", "__rest").alias("label_count"),
    )


def collapse_topk(
    df: DataFrame,
    col: str,
    k: int = 12,
    other: str = "Other",
    empty: str | None = "(empty)",
    out: str = "label",
) -> DataFrame:
    """Keep the ``k`` most frequent labels (ties by label) and rename the rest.

    Null counts as ""; ``empty`` renames that label, ``None`` leaves it. With at most
    ``k`` labels nothing is renamed. Labels are counted map-side first, and only the
    ``k`` kept ones are joined back, without a hint: labels may be long.
    """
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    label = text if empty is None else F.when(text == "", empty).otherwise(text)
    labelled = df.withColumn("__label", label)
    top = (
        labelled.groupBy("__label")
        .agg(F.count("*").alias("__n"))
        .orderBy(F.desc("__n"), "__label")
        .limit(int(k))
        .select("__label", F.lit(True).alias("__kept"))
    )
    return (
        labelled.join(top, "__label", "left")
        .withColumn(out, F.when(F.col("__kept"), F.col("__label")).otherwise(F.lit(other)))
        .drop("__label", "__kept")
    )


def category_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count")).orderBy(F.desc("count"), label)
