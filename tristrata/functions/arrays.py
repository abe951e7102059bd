"""Statistics over the value array of one series.

A series holds one value per distinct year, so these arrays stay short. Working on
the year-sorted array makes every statistic bit-stable: sums always run in year
order, whatever the partitioning or retries did before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def point_values(data: Column) -> Column:
    """Non-null values of an array of (Year, Value), in array order."""
    return F.filter(F.transform(data, lambda p: p["Value"]), lambda v: v.isNotNull())


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def not_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def mean_of(values: Column) -> Column:
    return F.when(F.size(values) > 0, not_nan(sum_of(values) / F.size(values)))


def variance_of(values: Column) -> Column:
    """Population variance, two passes."""
    return F.when(
        F.size(values) > 0,
        let(
            sum_of(values) / F.size(values),
            lambda m: not_nan(
                F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m))
                / F.size(values)
            ),
        ),
    )


def quantile_sorted(ordered: Column, p: float) -> Column:
    """Linear-interpolated quantile of an ascending, non-empty array."""
    position = (F.size(ordered) - 1) * F.lit(float(p))
    low = F.floor(position).cast("int")
    high = F.ceil(position).cast("int")
    return ordered[low] + (ordered[high] - ordered[low]) * (position - low)


def median_of(values: Column) -> Column:
    return F.when(
        F.size(values) > 0,
        let(
            F.array_sort(values),
            lambda s: not_nan(
                (
                    s[F.floor((F.size(s) - 1) / 2).cast("int")]
                    + s[F.floor(F.size(s) / 2).cast("int")]
                )
                / 2
            ),
        ),
    )


def _outer_range(values: Column) -> Column:
    """(lo, hi) of the histogram; a constant array gets half a unit on each side."""
    return let(
        F.struct(F.array_min(values).alias("lo"), F.array_max(values).alias("hi")),
        lambda r: F.struct(
            F.when(r["lo"] == r["hi"], r["lo"] - 0.5).otherwise(r["lo"]).alias("lo"),
            F.when(r["lo"] == r["hi"], r["hi"] + 0.5).otherwise(r["hi"]).alias("hi"),
        ),
    )


def bin_edges(values: Column, n_bins: Column) -> Column:
    """``n_bins + 1`` equal-width edges; null when they cannot all differ."""
    finite = (F.abs(F.array_min(values)) != float("inf")) & (F.abs(F.array_max(values)) != float("inf"))

    def edges(r: Column) -> Column:
        step = (r["hi"] - r["lo"]) / n_bins
        inner = F.transform(
            F.sequence(F.lit(0), n_bins.cast("int")),
            lambda i: F.when(i == n_bins, r["hi"]).otherwise(i * step + r["lo"]),
        )
        return let(
            inner,
            lambda e: F.when(
                F.forall(
                    F.sequence(F.lit(1), n_bins.cast("int")), lambda i: e[i - 1] < e[i]
                ),
                e,
            ),
        )

    return F.when(
        (F.size(values) > 0) & finite, let(_outer_range(values), edges)
    )


def bin_counts(values: Column, edges: Column) -> Column:
    """Values per bin, lower edge included, last bin closed on both sides."""
    n_bins = F.size(edges) - 1

    def below(i: Column) -> Column:
        return (
            F.when(i == 0, F.lit(0))
            .when(i == n_bins, F.size(values))
            .otherwise(F.size(F.filter(values, lambda v: v < edges[i])))
        )

    return F.when(
        edges.isNotNull(),
        let(
            F.transform(F.sequence(F.lit(0), n_bins), below),
            lambda c: F.transform(F.sequence(F.lit(1), n_bins), lambda i: c[i] - c[i - 1]),
        ),
    )


def histogram(values: Column, n_bins: Column) -> Column:
    """Struct of edges and counts; null when the range cannot be divided."""
    return let(
        values,
        lambda v: let(
            bin_edges(v, n_bins),
            lambda e: F.when(
                e.isNotNull(),
                F.struct(e.alias("edges"), bin_counts(v, e).alias("counts")),
            ),
        ),
    )


def entropy_bin_count(values: Column) -> Column:
    return F.least(
        F.lit(20), F.greatest(F.lit(2), F.floor(F.sqrt(F.size(values))).cast("int"))
    )


def entropy_of(values: Column) -> Column:
    """Shannon entropy in bits of the equal-width histogram.

    Shares are taken over (count + 1e-12), so a constant series has a tiny positive
    entropy rather than exactly zero. Null without values or with infinities.
    """

    def bits(v: Column) -> Column:
        total = F.size(v) + F.lit(1e-12)
        return F.aggregate(
            histogram(v, entropy_bin_count(v))["counts"],
            F.lit(0.0),
            lambda a, c: a - F.when(c > 0, (c / total) * F.log2(c / total)).otherwise(0.0),
        )

    return let(values, lambda v: F.when(F.size(v) > 0, bits(v)))


def auto_bin_count(values: Column) -> Column:
    """Number of bins by the smaller of the relaxed Freedman-Diaconis and Sturges widths."""

    def count(s: Column) -> Column:
        n = F.size(s)
        spread = s[n - 1] - s[0]
        iqr = quantile_sorted(s, 0.75) - quantile_sorted(s, 0.25)
        fd = F.lit(2.0) * iqr * F.pow(n, F.lit(-1.0 / 3.0))
        width = F.least(
            F.greatest(fd, spread / F.sqrt(n) / 2),
            spread / (F.log2(n) + 1.0),
        )
        return F.when(width > 0, F.ceil(spread / width).cast("int")).otherwise(F.lit(1))

    return let(F.array_sort(values), count)


def series_properties(data: Column, values: Column, only: Sequence[str] | None = None) -> Column:
    """Properties of a series from its year-sorted (Year, Value) array: eleven, or ``only`` some.

    ``values`` is a column of ``point_values(data)``, so that it is computed once.
    """
    v = values
    every = {
        "year_min": lambda: F.get(data, F.lit(0))["Year"],
        "year_max": lambda: F.get(data, F.size(data) - 1)["Year"],
        "n_members": lambda: F.size(data).cast("bigint"),
        "zeros": lambda: F.size(F.filter(v, lambda x: x == 0)).cast("bigint"),
        "nulls": lambda: (F.size(data) - F.size(v)).cast("bigint"),
        "min": lambda: F.array_min(v),
        "max": lambda: F.array_max(v),
        "mean": lambda: mean_of(v),
        "median": lambda: median_of(v),
        "variance": lambda: variance_of(v),
        "entropy": lambda: entropy_of(v),
    }
    return F.struct(*[every[name]().alias(name) for name in (only or every)])
