"""Property tables, statistics, boxes, category counts and event timelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tristrata.operators import profile as P
from tristrata.operators import timeline as T

from . import fixtures as X
from .registry import query, sig, sql_sig

PROPS = (
    'CAST(year_min AS DOUBLE) AS prop__year_min, CAST(year_max AS DOUBLE) AS prop__year_max, n_members AS prop__n_members, '
    'zeros AS prop__zeros, nulls AS prop__nulls, lo AS prop__min, hi AS prop__max, mean AS prop__mean, '
    'median AS prop__median, variance AS prop__variance, round(entropy, 6) AS prop__entropy'
)
NUMERIC = """
numeric AS (SELECT property FROM props GROUP BY 1 HAVING count(value) >= 50 AND count(value) / count(*) > 0.6)
"""


def table_of(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    return P.properties_table(c.l2, c.l3)


@query(f"SELECT series_key, domain_key, Domain, Sub_domain, Domain_table, Area, Item, Element, Unit, {PROPS} FROM series")
def properties_table(spark, sf_dir):
    return table_of(spark, sf_dir).withColumns({
        "prop__entropy": F.round("prop__entropy", 6),
        "prop__year_min": F.col("prop__year_min").cast("double"),
        "prop__year_max": F.col("prop__year_max").cast("double"),
    })


@query("""
SELECT property, count(value) AS n, count(value) / count(*) AS coverage FROM props GROUP BY 1
HAVING count(value) >= 50 AND count(value) / count(*) > 0.6
""")
def numeric_properties(spark, sf_dir):
    return P.numeric_properties(table_of(spark, sf_dir))


@query(f"""
, {NUMERIC}
SELECT property, count(value) AS n, {sql_sig('min(value)', 12)} AS "min", {sql_sig('quantile_cont(value, 0.25)', 12)} AS p25,
       {sql_sig('quantile_cont(value, 0.5)', 12)} AS median, {sql_sig('avg(value)')} AS mean,
       {sql_sig('quantile_cont(value, 0.75)', 12)} AS p75, {sql_sig('max(value)', 12)} AS "max",
       {sql_sig('coalesce(stddev_samp(value), 0.0)')} AS std
FROM props JOIN numeric USING (property) GROUP BY property
""")
def property_stats(spark, sf_dir):
    stats = P.property_stats(table_of(spark, sf_dir))
    return stats.select(
        "property", "n", *[sig(F.col(c), 12).alias(c) for c in ("min", "p25", "median", "p75", "max")],
        *[sig(F.col(c)).alias(c) for c in ("mean", "std")],
    )


def box_sql(groups: str) -> str:
    return f"""
, {NUMERIC},
q AS (SELECT {groups}, count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3
      FROM props JOIN numeric USING (property) WHERE value IS NOT NULL GROUP BY ALL),
w AS (SELECT {groups}, min(value) FILTER (WHERE value >= q1 - (q3 - q1) * 1.5) AS low,
             max(value) FILTER (WHERE value <= q3 + (q3 - q1) * 1.5) AS high
      FROM props JOIN q USING ({groups}) GROUP BY ALL)
SELECT {groups}, n, {sql_sig('q1', 12)} AS q1, {sql_sig('median', 12)} AS median, {sql_sig('q3', 12)} AS q3,
       {sql_sig('least(low, q1)', 12)} AS whisker_low, {sql_sig('greatest(high, q3)', 12)} AS whisker_high
FROM q JOIN w USING ({groups})
"""


def _rounded(boxes, *groups):
    return boxes.select(
        *groups, "n", *[sig(F.col(c), 12).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]
    )


@query(box_sql("property"))
def box_stats(spark, sf_dir):
    return _rounded(P.box_stats(table_of(spark, sf_dir)), "property")


@query(box_sql("Domain_table, property"))
def box_stats_by_table(spark, sf_dir):
    return _rounded(P.box_stats_by_table(table_of(spark, sf_dir)), "Domain_table", "property")


@query("""
, top AS (SELECT Area, row_number() OVER (ORDER BY count(*) DESC, Area) AS r FROM facts GROUP BY Area)
SELECT CASE WHEN r <= 12 THEN Area ELSE 'Other' END AS label, count(*) AS "count"
FROM facts JOIN top USING (Area) GROUP BY 1
""")
def collapse_topk(spark, sf_dir):
    return P.category_counts(P.collapse_topk(X.facts(spark, sf_dir), "Area"))


@query("""
, top AS (SELECT coalesce(Unit, '') AS u, row_number() OVER (ORDER BY count(*) DESC, coalesce(Unit, '')) AS r FROM facts GROUP BY 1)
SELECT CASE WHEN r > 3 THEN 'Other' WHEN u = '' THEN '(empty)' ELSE u END AS label, count(*) AS "count"
FROM facts JOIN top ON coalesce(Unit, '') = u GROUP BY 1
""")
def collapse_topk_empty(spark, sf_dir):
    """Null units become "(empty)" before counting."""
    return P.category_counts(P.collapse_topk(X.facts(spark, sf_dir), "Unit", 3))


@query("""
, top AS (SELECT Area, row_number() OVER (ORDER BY count(*) DESC, Area) AS r FROM facts GROUP BY Area)
SELECT Area, CASE WHEN r <= 10 THEN Area ELSE '(other)' END AS label, count(*) AS n FROM facts JOIN top USING (Area) GROUP BY ALL
""")
def collapse_topk_plain(spark, sf_dir):
    collapsed = P.collapse_topk(X.facts(spark, sf_dir), "Area", 10, "(other)", None)
    return collapsed.groupBy("Area", "label").agg(F.count("*").alias("n"))


@query("""SELECT source AS label, count(*) AS "count" FROM documents GROUP BY 1""", base=False)
def category_counts(spark, sf_dir):
    return P.category_counts(X.table(spark, sf_dir, "documents"), "source").withColumnRenamed("source", "label")


def milestones(spark, sf_dir):
    """Events as a milestone log: per user, alternating start and done marks."""
    events = X.table(spark, sf_dir, "events")
    # Wall-clock difference, the same in every session time zone.
    elapsed = "cast(ts as timestamp_ntz) - timestamp_ntz'2024-01-01 00:00:00'"
    millis = F.expr(f"cast(floor(cast(cast({elapsed} as interval second) as decimal(20, 6)) * 1000) as bigint)")
    return events.select(
        F.concat("event_type", F.when(F.col("event_id") % 2 == 0, ".start").otherwise(".done")).alias("name"),
        (millis / F.lit(1000.0)).alias("t_seconds"),
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("position"),
    )


MILESTONES = """
WITH m AS (
  SELECT event_type AS stage, event_id % 2 = 0 AS is_start, event_id AS pos, user_id AS run_id,
         ((epoch_us(ts) - 1704067200000000) // 1000) / 1000.0 AS t FROM events)
"""


@query(MILESTONES + """
SELECT run_id, stage, round(t1 - t0, 3) AS seconds FROM (
  SELECT run_id, stage, min(pos) FILTER (WHERE is_start) AS a, max(pos) FILTER (WHERE NOT is_start) AS b,
         min_by(t, pos) FILTER (WHERE is_start) AS t0, max_by(t, pos) FILTER (WHERE NOT is_start) AS t1
  FROM m GROUP BY ALL) WHERE b > a
""", base=False)
def stage_seconds(spark, sf_dir):
    return T.stage_seconds(milestones(spark, sf_dir), "position").withColumn("seconds", F.round("seconds", 3))


@query(MILESTONES + """
SELECT run_id, count(*) AS n_events, max_by(t, pos) AS total_wall_seconds FROM m GROUP BY run_id
""", base=False)
def run_summary(spark, sf_dir):
    return T.run_summary(milestones(spark, sf_dir), "position")
