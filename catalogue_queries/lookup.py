"""Joins between levels, point lookups, ranking and sampling."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from tristrata.functions.text import extra_dims as extras_of
from tristrata.functions.text import plot_header as header_of
from tristrata.functions.text import plot_title as title_of
from tristrata.operators import histograms as H
from tristrata.operators import lookup as L
from tristrata.operators import sampling as A
from tristrata.schema import L2_DIMS, L3_DIMS

from . import fixtures as X
from .registry import big, query, sig, sql_sig

# A series present at every scale.
KNOWN = {
    "dims_l2": {"Area": "u1", "Element": "value", "Item": "click", "Unit": "USD"},
    "dims_l3": {"Domain": "Web", "Domain_table": "Event values", "Sub_domain": "Events"},
}
KNOWN_KEY = "sha256:" + hashlib.sha256(
    json.dumps(KNOWN, sort_keys=True, separators=(",", ":")).encode()
).hexdigest()
L3 = ", ".join(L3_DIMS)
L2 = ", ".join(L2_DIMS)


def points_text(points):
    return F.array_join(
        F.transform(points, lambda p: F.concat(p["Year"].cast("string"), F.lit(":"), F.coalesce(F.round(p["Value"] * 100).cast("bigint").cast("string"), F.lit("-")))), ","
    )


POINTS_TEXT = (
    "array_to_string(list_transform({0}, lambda p: CAST(p.Year AS VARCHAR) || ':' || "
    "coalesce(CAST(CAST(round(p.Value * 100) AS BIGINT) AS VARCHAR), '-')), ',')"
)
FINITE = "list_filter(data, lambda p: p.Value IS NOT NULL)"


@query(f"SELECT domain_key, series_key, {L3}, {L2}, n_members FROM series")
def label_series(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    return L.label_series(c.l2, c.l3).select("domain_key", "series_key", *L3_DIMS, *L2_DIMS, "n_members")


@query("""
SELECT domain_key, series_key, CASE WHEN Domain = 'Web' THEN '' ELSE Domain END AS Domain,
       CASE WHEN Domain = 'Web' THEN '' ELSE Sub_domain END AS Sub_domain,
       CASE WHEN Domain = 'Web' THEN domain_key ELSE Domain_table END AS Domain_table
FROM series
""")
def label_series_with_fallback(spark, sf_dir):
    """One domain has lower-case names, the other no card at all."""
    c = X.stored_catalogue(spark, sf_dir)
    lower = c.l3.withColumn("dims", F.transform_keys("dims", lambda k, v: F.lower(k)))
    return L.label_series_with_fallback(c.l2, lower.filter(F.col("dims")["domain"] == "Sales"))


@query(f"SELECT series_key, {POINTS_TEXT.format('data')} AS points FROM series WHERE Area = 'u1' AND Item = 'click'")
def lookup_records(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    return L.lookup_records(c.l1, KNOWN_KEY).select(
        F.col("identity.series_key").alias("series_key"), points_text("data").alias("points")
    )


@query("SELECT series_key, Domain_table, Area, n_members FROM series WHERE Area = 'u1' AND Item = 'click'")
def lookup_series(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    return L.lookup_series(c.l2, c.l3, KNOWN_KEY).select(
        F.col("identity.series_key").alias("series_key"),
        F.col("l3")["Domain_table"].alias("Domain_table"),
        F.col("dims")["Area"].alias("Area"),
        "properties.n_members",
    )


@query("SELECT series_key, len(data) AS n FROM series WHERE Domain = 'Web' AND Element = 'value'")
def records_for_keys(spark, sf_dir):
    """Records of every series of one domain."""
    c = X.stored_catalogue(spark, sf_dir)
    web = L.label_series(c.l2, c.l3).filter("Domain = 'Web'").select("series_key")
    return L.records_for_keys(c.l1, web).select(
        F.col("identity.series_key").alias("series_key"), big(F.size("data")).alias("n")
    )


@query(f"""
SELECT domain_key, series_key, {L3}, {L2}, CAST(p.Year AS BIGINT) AS Year, p.Value AS Value
FROM (SELECT *, unnest(data) AS p FROM series)
""")
def expand_hierarchy(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    return L.expand_hierarchy(c.l3, c.l2, c.l1)


@query("""
SELECT series_key, CAST(p.Year AS BIGINT) AS Year, CASE WHEN p.Year % 5 = 0 OR p.Year % 11 = 0 THEN NULL ELSE p.Value END AS Value
FROM (SELECT series_key, unnest(data) AS p FROM series) WHERE p.Year % 7 <> 0 AND p.Year % 13 <> 0
""")
def coerce_year_value(spark, sf_dir):
    """Bundles turned to text with unreadable years and values; order is restored."""
    c = X.stored_catalogue(spark, sf_dir)
    texts = F.transform(
        F.reverse("data"),
        lambda p: F.struct(
            F.when(p["Year"] % 7 == 0, "n.d.").when(p["Year"] % 13 == 0, F.concat(p["Year"].cast("string"), F.lit("f")))
            .otherwise(p["Year"].cast("string")).alias("Year"),
            F.when(p["Year"] % 5 == 0, "missing").when(p["Year"] % 11 == 0, "1d").otherwise(p["Value"].cast("string")).alias("Value"),
        ),
    )
    points = L.coerce_year_value(texts)
    ordered = F.forall(F.sequence(F.lit(1), F.size("data") - 1), lambda i: F.col("data")[i - 1]["Year"] < F.col("data")[i]["Year"])
    coerced = c.l1.select("identity", points.alias("data"))
    return L.explode_points(coerced.filter((F.size("data") < 2) | ordered))


@query("""
SELECT series_key, row_number() OVER (PARTITION BY series_key ORDER BY p.Year) AS position, CAST(p.Year AS BIGINT) AS Year
FROM (SELECT series_key, unnest(data) AS p FROM series)
""")
def sort_points(spark, sf_dir):
    """Points of a reversed bundle are put back in year order."""
    c = X.stored_catalogue(spark, sf_dir)
    ordered = L.coerce_year_value(F.reverse("data"), numeric=True)
    rows = c.l1.select(F.col("identity.series_key").alias("series_key"), F.posexplode(ordered).alias("i", "p"))
    return rows.select("series_key", big(F.col("i") + 1).alias("position"), "p.Year")


@query(f"""
SELECT series_key, len({FINITE}) AS n, {POINTS_TEXT.format(FINITE)} AS points FROM series WHERE len({FINITE}) >= 2
""")
def finite_points(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    rows = c.l1.select(
        F.col("identity.series_key").alias("series_key"), L.finite_points(F.col("data")).alias("p")
    )
    return rows.filter(F.size("p") > 0).select(
        "series_key", big(F.size("p")).alias("n"), points_text("p").alias("points")
    )


HEADER = (
    "'Statistics series | Domain: ' || Domain || ' | Sub-domain: ' || Sub_domain || ' | Domain-table: ' || Domain_table"
    " || ' | Area: ' || Area || ' | Item: ' || Item || ' | Element: ' || Element || ' | Unit: ' || Unit"
)


@query(f"""
SELECT series_key, {HEADER} AS header,
       CASE WHEN length(description) > 90 THEN substr(description, 1, 90) || '…' ELSE description END AS title
FROM series
""")
def plot_header(spark, sf_dir):
    """Header with empty slots kept; title with empty slots skipped, cut at 90 characters."""
    c = X.stored_catalogue(spark, sf_dir)
    return L.with_domain_dims(c.l2, c.l3).select(
        F.col("identity.series_key").alias("series_key"),
        header_of("Statistics", F.col("l3"), F.col("dims")).alias("header"),
        title_of("Statistics", F.col("l3"), F.col("dims"), 90).alias("title"),
    )


@query("""
SELECT s.series_key, coalesce('Area_code=' || c.code, '') AS extras
FROM series s JOIN (SELECT Domain, Area, Item, Element, coalesce(Unit, '') AS Unit, min_by(struct_pack(c := Area_code), ord).c AS code
                    FROM facts GROUP BY ALL) c USING (Domain, Area, Item, Element, Unit)
""")
def extra_dims(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir)
    text = F.array_join(
        F.transform(extras_of(F.col("dims")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    )
    return c.l2.select(F.col("identity.series_key").alias("series_key"), text.alias("extras"))


def _rank_sql(rank: int, order: str) -> str:
    return f"""
SELECT series_key, n_members FROM (
  SELECT series_key, n_members, row_number() OVER (ORDER BY n_members {order}, series_key) AS r FROM series) WHERE r = {rank}
"""


def _ranked(spark, sf_dir, rank, descending):
    found = A.series_by_rank(X.stored_catalogue(spark, sf_dir).l2, rank, descending)
    return found.select(F.col("identity.series_key").alias("series_key"), "properties.n_members")


@query(_rank_sql(10, "DESC"))
def series_by_rank(spark, sf_dir):
    return _ranked(spark, sf_dir, 10, True)


@query(_rank_sql(500, "ASC"))
def series_by_rank_ascending(spark, sf_dir):
    return _ranked(spark, sf_dir, 500, False)


@query("SELECT series_key, n_members FROM series ORDER BY md5('42|' || series_key), series_key LIMIT 10")
def sample_series(spark, sf_dir):
    sample = A.sample_series(X.stored_catalogue(spark, sf_dir).l2, 10)
    return sample.select(F.col("identity.series_key").alias("series_key"), "properties.n_members")


@query("SELECT series_key, n_members FROM series ORDER BY md5('7|' || series_key), series_key LIMIT 1500")
def sample_series_large(spark, sf_dir):
    """Large enough that the counting pass narrows the sort."""
    sample = A.sample_series(X.stored_catalogue(spark, sf_dir).l2, 1500, seed=7)
    return sample.select(F.col("identity.series_key").alias("series_key"), "properties.n_members")


@query("""
SELECT series_key FROM (SELECT series_key FROM series ORDER BY md5('42|' || series_key), series_key LIMIT 300)
ORDER BY md5('42|sub|' || series_key), series_key LIMIT 50
""")
def subsample(spark, sf_dir):
    key = F.col("identity.series_key")
    sample = A.sample_series(X.stored_catalogue(spark, sf_dir).l2, 300)
    return A.subsample(sample, key, 50).select(key.alias("series_key"))


CARDS = f"""
SELECT s.series_key, domain_key, {HEADER} AS header, n_members,
       CASE WHEN len({FINITE}) >= 2 THEN len({FINITE}) ELSE 0 END AS n_points,
       CASE WHEN len({FINITE}) >= 2 THEN list_min(list_transform({FINITE}, lambda p: p.Year)) END AS year_min,
       CASE WHEN len({FINITE}) >= 2 THEN list_max(list_transform({FINITE}, lambda p: p.Year)) END AS year_max,
       CASE WHEN len({FINITE}) >= 2 THEN {POINTS_TEXT.format(FINITE)} ELSE '' END AS points, CAST(NULL AS VARCHAR) AS trainable
FROM series s JOIN (SELECT series_key FROM series ORDER BY md5('42|' || series_key), series_key LIMIT 10) USING (series_key)
"""


@query(CARDS)
def series_cards(spark, sf_dir):
    """Ten sampled series as nested cards."""
    c = X.stored_catalogue(spark, sf_dir)
    cards = L.series_cards(A.sample_series(c.l2, 10), c.l3, c.l1, "Statistics")
    return cards.select(
        "series_key", "domain_key", "header", "properties.n_members", big("n_points").alias("n_points"),
        "year_min", "year_max", points_text("points").alias("points"), "properties.trainable",
    )


def edges_sql(n: str) -> str:
    """Both edges of bin j, as ten significant digits."""
    step = f"((e_hi - e_lo) / {n})"
    return (
        sql_sig(f"CASE WHEN j = 0 THEN e_lo ELSE e_lo + j * {step} END", 10) + " AS lower, "
        + sql_sig(f"CASE WHEN j + 1 = {n} THEN e_hi ELSE e_lo + (j + 1) * {step} END", 10) + " AS upper"
    )


def _bins(rows):
    return rows.select("series_key", big("bin").alias("bin"), big("count").alias("count"), sig(F.col("lower"), 10).alias("lower"), sig(F.col("upper"), 10).alias("upper"))


@query(f"""
SELECT series_key, CAST(j AS BIGINT) AS bin, CAST(len(list_filter(vals, lambda v:
   len(list_filter(range(1, 20), lambda i: v >= e_lo + i * ((e_hi - e_lo) / 20))) = j)) AS BIGINT) AS "count",
   {edges_sql("20")}
FROM (SELECT *, unnest(range(0, 20)) AS j FROM series WHERE nv > 0)
""")
def value_histogram(spark, sf_dir):
    """Twenty bins of every series with their edges, empty ones included."""
    return _bins(H.value_histogram(X.stored_catalogue(spark, sf_dir).l1))


AUTO = f"""
, finite AS (SELECT series_key, list_sort(vals) AS v, nv AS n, hi - lo AS spread, e_lo, e_hi FROM series WHERE nv >= 2),
iqr AS (SELECT *, (n - 1) * 0.75 AS p3, (n - 1) * 0.25 AS p1 FROM finite),
widths AS (SELECT *,
   (v[CAST(floor(p3) AS INT) + 1] + (v[CAST(ceil(p3) AS INT) + 1] - v[CAST(floor(p3) AS INT) + 1]) * (p3 - floor(p3)))
 - (v[CAST(floor(p1) AS INT) + 1] + (v[CAST(ceil(p1) AS INT) + 1] - v[CAST(floor(p1) AS INT) + 1]) * (p1 - floor(p1))) AS r FROM iqr),
bw AS (SELECT *, least(greatest(2.0 * r * pow(n, -1.0 / 3.0), spread / sqrt(n) / 2), spread / (log2(n) + 1.0)) AS w FROM widths),
nbins AS (SELECT *, CASE WHEN w > 0 THEN CAST(ceil(spread / w) AS BIGINT) ELSE 1 END AS nb FROM bw)
SELECT series_key, CAST(j AS BIGINT) AS bin, CAST(len(list_filter(v, lambda x:
   len(list_filter(range(1, nb), lambda i: x >= e_lo + i * ((e_hi - e_lo) / nb))) = j)) AS BIGINT) AS "count",
   {edges_sql("nb")}
FROM (SELECT *, unnest(range(0, nb)) AS j FROM nbins)
"""


@query(AUTO)
def value_histogram_auto(spark, sf_dir):
    return _bins(H.value_histogram_auto(X.stored_catalogue(spark, sf_dir).l1))
