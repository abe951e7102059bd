"""Reproducible sampling and selection by rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hexadecimal digits of the hash prefix that rows are counted by.
PREFIX = 4


def sample_rows(df: DataFrame, key: Column, k: int, seed: int | str = 42) -> DataFrame:
    """``k`` rows in the order of a seeded hash of their key.

    The choice depends on the keys and the seed only, not on partitioning. The hash
    prefix that holds the k-th row is found first (at most 65 536 counts), so the sort
    sees little more than ``k`` rows in total.
    """
    hashed = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}|"), key)))
    prefix = F.substring("__h", 1, PREFIX)
    counts = hashed.groupBy(prefix.alias("p")).agg(F.count("*").alias("n"))
    running = counts.select(
        "p", F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)).alias("upto")
    )
    cut = running.filter(F.col("upto") >= k).agg(F.min("p")).scalar()
    hashed = hashed.filter(prefix <= F.coalesce(cut, F.lit("g")))
    return hashed.orderBy("__h", key).limit(int(k)).drop("__h")


def sample_series(series: DataFrame, k: int, seed: int | str = 42) -> DataFrame:
    """``k`` series without replacement; all of them when there are fewer."""
    return sample_rows(series, F.col("identity.series_key"), k, seed)


def subsample(sample: DataFrame, key: Column, target: int | None, seed: int | str = 42) -> DataFrame:
    """Second-stage sample with its own salt; ``None`` keeps every row."""
    if target is None:
        return sample
    return sample_rows(sample, key, target, f"{seed}|sub")


def series_by_rank(series: DataFrame, rank: int, descending: bool = True) -> DataFrame:
    """The series at 1-based ``rank`` by number of points, ties in key order.

    No global sort: one aggregate counts series per number of points and key prefix (at
    most 65 536 prefixes each); running totals over it locate the row's neighbourhood, and
    one filtered read orders only that. Keys are hashes, so neighbourhoods are even. A rank
    beyond the last series gives no row.
    """
    if rank < 1:
        raise ValueError(f"rank must be at least 1, got {rank}")
    keyed = series.withColumns({
        "__n": F.coalesce("properties.n_members", F.lit(0)),
        "__key": F.col("identity.series_key"),
    }).withColumn("__p", F.coalesce(F.substring("__key", 8, PREFIX), F.lit("")))
    cells = keyed.groupBy("__n", "__p").agg(F.count("*").alias("c"))
    sizes = cells.groupBy("__n").agg(F.sum("c").alias("all"), F.array_sort(F.collect_list(F.struct("__p", "c"))).alias("cells"))
    order = F.col("__n").desc() if descending else F.col("__n").asc()
    upto = F.sum("all").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    left = F.lit(int(rank)) - (F.col("upto") - F.col("all"))
    hit = sizes.withColumn("upto", upto).where((left >= 1) & (left <= F.col("all")))
    none = F.struct(left.alias("left"), F.lit(None).cast("string").alias("at"))

    def step(a: Column, cell: Column) -> Column:
        here = F.struct(a.left.alias("left"), cell["__p"].alias("at"))
        on = F.struct((a.left - cell.c).alias("left"), F.lit(None).cast("string").alias("at"))
        return F.when(a.at.isNotNull(), a).when(a.left <= cell.c, here).otherwise(on)

    place = hit.select("__n", F.aggregate("cells", none, step).alias("near")).first()
    if place is None:
        return series.limit(0)
    near = keyed.where((F.col("__n") == place["__n"]) & (F.col("__p") == place.near.at))
    position = F.row_number().over(Window.partitionBy("__p").orderBy("__key"))
    return near.withColumn("__i", position).where(F.col("__i") == place.near.left).drop("__n", "__key", "__p", "__i")
