"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialize

#: Rows of an interval that may be gathered and ordered in one row.
ROW_BOUND = 10_000
CUTS = 64
#: Cuts at even distances besides those of the sketch, so that a poor one still makes progress.
EVEN_CUTS = 15
SKETCH_ACCURACY = 1000


def _inside(lo: Column, hi: Column) -> Column:
    v = F.col("v")
    return (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))


def _narrowed(v: DataFrame, targets: DataFrame, groups: list[str]) -> DataFrame:
    """Targets of intervals over the bound, each in a smaller interval or settled.

    A sketch of the interval proposes cuts, a counting pass says how many rows lie at and
    between them. Rows equal to a cut are a slot of their own, so a value that fills an
    interval settles at once. A poor sketch only costs another pass.
    """
    key = [*groups, "lo", "hi"]
    spans = targets.select(*key).distinct()
    sketched = v.join(spans, groups).where(_inside(F.col("lo"), F.col("hi"))).groupBy(*key).agg(
        F.percentile_approx("v", [i / CUTS for i in range(CUTS + 1)], SKETCH_ACCURACY).alias("cuts"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    even = F.transform(F.sequence(F.lit(1), F.lit(EVEN_CUTS)), lambda i: F.col("low") + (F.col("high") - F.col("low")) * i / (EVEN_CUTS + 1))
    every = F.filter(F.concat("cuts", even), lambda c: ~F.isnan(c) & (c >= F.col("low")) & (c <= F.col("high")))
    cuts = materialize(sketched.select(*key, F.array_sort(F.array_distinct(every)).alias("cuts")), "cuts")
    below = F.aggregate("cuts", F.lit(0), lambda a, c: a + F.when(c < F.col("v"), 1).otherwise(0))
    slots = (
        v.join(cuts, groups).where(_inside(F.col("lo"), F.col("hi")))
        .groupBy(*key, "cuts", (below * 2 + F.when(F.array_contains("cuts", F.col("v")), 1).otherwise(0)).alias("slot"))
        .agg(F.count("*").alias("c"))
        # At most 2 * (CUTS + EVEN_CUTS) + 3 entries.
        .groupBy(*key, "cuts").agg(F.array_sort(F.collect_list(F.struct("slot", "c"))).alias("slots"))
    )
    none = F.struct(F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("int").alias("slot"), F.lit(0).cast("bigint").alias("c"))

    def step(a: Column, s: Column) -> Column:
        here = F.struct(a.before.alias("before"), s.slot.alias("slot"), s.c.alias("c"))
        on = F.struct((a.before + s.c).alias("before"), F.lit(None).cast("int").alias("slot"), F.lit(0).cast("bigint").alias("c"))
        return F.when(a.slot.isNotNull(), a).when(F.col("offset") < a.before + s.c, here).otherwise(on)

    same = [targets[g] == slots[g] for g in groups] + [targets[b].eqNullSafe(slots[b]) for b in ("lo", "hi")]
    met = targets.join(slots, same).select(*[targets[c] for c in targets.columns], slots["cuts"], F.aggregate("slots", none, step).alias("at"))
    number = F.floor(F.col("at.slot") / 2).cast("int")
    return met.select(
        *groups, "n", "i", "side", "part",
        (F.col("offset") - F.col("at.before")).alias("offset"),
        F.when(number > 0, F.get("cuts", number - 1)).otherwise(F.col("lo")).alias("lo"),
        F.coalesce(F.get("cuts", number), F.col("hi")).alias("hi"),
        F.col("at.c").alias("c"),
        F.when(F.col("at.slot") % 2 == 1, F.get("cuts", number)).alias("exact"),
    )


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str]) -> DataFrame:
    """Linear-interpolated quantiles ``q0, q1, …`` and ``n`` per group.

    Every wanted rank starts with all of its group as its interval. Counting passes narrow
    the intervals until each holds at most ROW_BOUND rows or a single value; only then are
    the rows of an interval gathered. ``df`` is read once per pass: write it first if it
    is costly.
    """
    groups = list(groups)
    v = df.select(*groups, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ranks = ", ".join(
        f"struct({i} as i, {side} as side, (n - 1) * {float(p)!r}D - floor((n - 1) * {float(p)!r}D) as part, "
        f"cast({rounding}((n - 1) * {float(p)!r}D) as bigint) as offset)"
        for i, p in enumerate(probs)
        for side, rounding in ((0, "floor"), (1, "ceil"))
    )
    targets = v.groupBy(*groups).agg(F.count("*").alias("n")).selectExpr(
        *groups, "n", f"inline(array({ranks}))", "cast(null as double) as lo", "cast(null as double) as hi", "n as c", "cast(null as double) as exact"
    )
    wide = (F.col("c") > ROW_BOUND) & F.col("exact").isNull()
    targets = materialize(targets, "targets")
    while not targets.where(wide).isEmpty():
        settled = targets.where(~wide)
        targets = materialize(settled.unionByName(_narrowed(v, targets.where(wide), groups)), "targets")
    spans = targets.where("exact is null").select(*groups, "lo", "hi").distinct()
    values = (
        v.join(spans, groups).where(_inside(F.col("lo"), F.col("hi")))
        .groupBy(*groups, "lo", "hi").agg(F.array_sort(F.collect_list("v")).alias("values"))
    )
    same = [targets[g] == values[g] for g in groups] + [targets[b].eqNullSafe(values[b]) for b in ("lo", "hi")]
    picked = targets.join(values, same, "left").select(
        *[targets[c] for c in (*groups, "n", "i", "side", "part")],
        F.coalesce(targets["exact"], F.get("values", targets["offset"].cast("int"))).alias("v"),
    )

    def quantile(i: int) -> str:
        low, high = (f"max(case when i = {i} and side = {side} then v end)" for side in (0, 1))
        return f"{low} + ({high} - {low}) * max(case when i = {i} then part end) as q{i}"

    return picked.groupBy(*groups).agg(F.max("n").alias("n"), *[F.expr(quantile(i)) for i in range(len(probs))])
