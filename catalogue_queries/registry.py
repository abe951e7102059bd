"""Query registry: each query stands next to its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fact view and catalogue levels in DuckDB SQL; every oracle starts from these.
BASE = r"""
WITH facts AS (
  SELECT 'Sales' AS Domain, 'Orders' AS Sub_domain, 'Order totals' AS Domain_table,
         n_name AS Area, c_mktsegment AS Item, o_orderstatus AS Element, o_orderpriority AS Unit,
         CAST(n_nationkey AS VARCHAR) AS Area_code, CAST(year(o_orderdate) AS BIGINT) AS Year,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE o_totalprice END AS Value,
         1 AS src, o_orderkey AS seq, 1000000000000 + o_orderkey AS ord
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'Web', 'Events', 'Event values', concat('u', CAST(user_id % 40 AS VARCHAR)),
         event_type, 'value', CASE WHEN event_type = 'error' THEN NULL ELSE 'USD' END,
         NULL, CAST(day(ts) AS BIGINT),
         CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_type = 'error' THEN 7.5
              WHEN event_id % 11 = 0 THEN 0.0 ELSE value END,
         2, event_id, 2000000000000 + event_id
  FROM events
),
points AS (
  SELECT Domain, Sub_domain, Domain_table, Area, Item, Element, coalesce(Unit, '') AS Unit, Year,
         max_by(struct_pack(v := Value), ord).v AS Value
  FROM facts WHERE Year IS NOT NULL GROUP BY ALL
),
bundles AS (
  SELECT Domain, Sub_domain, Domain_table, Area, Item, Element, Unit,
         min(Year) AS year_min, max(Year) AS year_max, count(*) AS n_members,
         count(*) FILTER (WHERE Value = 0) AS zeros, count(*) - count(Value) AS nulls,
         min(Value) AS lo, max(Value) AS hi, count(Value) AS nv,
         list(Value ORDER BY Year) FILTER (WHERE Value IS NOT NULL) AS vals,
         list(struct_pack(Year := Year, Value := Value) ORDER BY Year) AS data
  FROM points GROUP BY ALL
),
averaged AS (
  SELECT *, list_sum(vals) / nv AS mean,
         (list_sort(vals)[(nv + 1) // 2] + list_sort(vals)[nv // 2 + 1]) / 2 AS median
  FROM bundles
),
binned AS (
  SELECT *, list_sum(list_transform(vals, lambda v: (v - mean) * (v - mean))) / nv AS variance, least(20, greatest(2, CAST(floor(sqrt(nv)) AS BIGINT))) AS nb,
         CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS e_lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS e_hi
  FROM averaged
),
counted AS (
  SELECT *, list_transform(range(0, nb), lambda j:
           len(list_filter(vals, lambda v:
             len(list_filter(range(1, nb), lambda i: v >= e_lo + i * ((e_hi - e_lo) / nb))) = j))) AS bins
  FROM binned
),
series AS (
  SELECT *,
    CASE WHEN nv > 0 THEN list_sum(list_transform(bins, lambda c:
        CASE WHEN c > 0 THEN -(c / (nv + 1e-12)) * log2(c / (nv + 1e-12)) ELSE 0.0 END)) END AS entropy,
    'sha256:' || sha256('{"dims_l3":{"Domain":' || CAST(to_json(Domain) AS VARCHAR) || ',"Domain_table":'
        || CAST(to_json(Domain_table) AS VARCHAR) || ',"Sub_domain":' || CAST(to_json(Sub_domain) AS VARCHAR) || '}}') AS domain_key,
    'sha256:' || sha256('{"dims_l2":{"Area":' || CAST(to_json(Area) AS VARCHAR) || ',"Element":' || CAST(to_json(Element) AS VARCHAR)
        || ',"Item":' || CAST(to_json(Item) AS VARCHAR) || ',"Unit":' || CAST(to_json(Unit) AS VARCHAR)
        || '},"dims_l3":{"Domain":' || CAST(to_json(Domain) AS VARCHAR) || ',"Domain_table":'
        || CAST(to_json(Domain_table) AS VARCHAR) || ',"Sub_domain":' || CAST(to_json(Sub_domain) AS VARCHAR) || '}}') AS series_key,
    concat_ws(' | ', 'Statistics series', 'Domain: ' || nullif(Domain, ''), 'Sub-domain: ' || nullif(Sub_domain, ''),
        'Domain-table: ' || nullif(Domain_table, ''), 'Area: ' || nullif(Area, ''), 'Item: ' || nullif(Item, ''),
        'Element: ' || nullif(Element, ''), 'Unit: ' || nullif(Unit, '')) AS description
  FROM counted
),
domains AS (
  SELECT DISTINCT Domain, Sub_domain, Domain_table,
    'sha256:' || sha256('{"dims_l3":{"Domain":' || CAST(to_json(Domain) AS VARCHAR) || ',"Domain_table":'
        || CAST(to_json(Domain_table) AS VARCHAR) || ',"Sub_domain":' || CAST(to_json(Sub_domain) AS VARCHAR) || '}}') AS domain_key,
    concat_ws(' | ', 'Statistics domain', 'Domain: ' || Domain, 'Sub-domain: ' || Sub_domain, 'Domain-table: ' || Domain_table) AS description
  FROM facts
),
props AS (
  SELECT series_key, domain_key, Domain, Sub_domain, Domain_table, Area, Item, Element, Unit,
         unnest(['year_min', 'year_max', 'n_members', 'zeros', 'nulls', 'min', 'max', 'mean', 'median', 'variance', 'entropy']) AS property,
         unnest([CAST(year_min AS DOUBLE), year_max, n_members, zeros, nulls, lo, hi, mean, median, variance, entropy]) AS value
  FROM series
)
"""


def query(oracle: str | None = None, name: str | None = None, base: bool = True):
    """Register a query under its function name, with optional oracle SQL."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            text = oracle.strip()
            if base:
                # An oracle may continue the chain of common table expressions.
                text = BASE.strip() + (text if text.startswith(",") else "\n" + text)
            ORACLES[key] = text
        return fn

    return add


def sig(c: Column, digits: int = 9) -> Column:
    """Significant digits: sums may run in another order in another engine."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c.cast("double") + 0.0).cast("double"))


def sql_sig(expr: str, digits: int = 9) -> str:
    return f"CASE WHEN {expr} IS NOT NULL THEN CAST(printf('%.{digits - 1}e', CAST({expr} AS DOUBLE) + 0.0) AS DOUBLE) END"


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")
