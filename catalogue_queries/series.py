"""Grouping, dedup, statistics, filters, keys and descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tristrata.config import BuildSpec, Filters
from tristrata.functions import text as K
from tristrata.operators import columns as C
from tristrata.operators import series as S
from tristrata.schema import L2_DIMS, L3_DIMS, PROPERTIES, SERIES_DIMS
from tristrata.shared import materialize

from . import fixtures as X
from .registry import query, sig, sql_sig

DIMS = ", ".join(SERIES_DIMS)
CLEAN_DIMS = DIMS.replace("Unit", "coalesce(Unit, '') AS Unit")
STATS = (
    "CAST(year_min AS BIGINT) AS year_min, CAST(year_max AS BIGINT) AS year_max, n_members, zeros, nulls, "
    'lo AS "min", hi AS "max", mean, median, variance, round(entropy, 6) AS entropy'
)


def prepared(spark, sf_dir, **options):
    return C.prepare_facts(X.facts(spark, sf_dir), BuildSpec(**options), "ord")


def bundles(spark, sf_dir, shuffle="spread"):
    return S.record_bundles(S.dedup_keep_last(prepared(spark, sf_dir), shuffle))


def statistics(spark, sf_dir, only=None):
    return S.series_stats(bundles(spark, sf_dir), only)


def flat_properties(df, *keys):
    return df.select(
        *keys,
        *[F.col(f"properties.{p}").alias(p) for p in PROPERTIES[:-1]],
        F.round("properties.entropy", 6).alias("entropy"),
    )


@query(f"SELECT {DIMS}, {STATS} FROM series")
def series_stats(spark, sf_dir):
    return flat_properties(statistics(spark, sf_dir), *SERIES_DIMS)


@query("SELECT DISTINCT Domain, Sub_domain, Domain_table FROM facts")
def domain_cards(spark, sf_dir):
    return S.domain_cards(prepared(spark, sf_dir))


@query(f"SELECT {CLEAN_DIMS}, count(*) AS n_rows FROM facts GROUP BY ALL")
def series_groups(spark, sf_dir):
    return S.series_groups(prepared(spark, sf_dir))


@query(f"SELECT {DIMS}, Year, Value FROM points")
def dedup_keep_last(spark, sf_dir):
    return S.dedup_keep_last(prepared(spark, sf_dir)).select(*SERIES_DIMS, "Year", "Value")


@query(f"SELECT {DIMS}, Year, Value FROM points")
def dedup_keep_last_colocated(spark, sf_dir):
    """One exchange by series; same result."""
    return S.dedup_keep_last(prepared(spark, sf_dir), "colocate").select(*SERIES_DIMS, "Year", "Value")


@query(f"SELECT {DIMS}, min(Year) AS year_min, max(Year) AS year_max, count(*) AS n_members FROM points GROUP BY ALL")
def series_extent(spark, sf_dir):
    extent = ["year_min", "year_max", "n_members"]
    return statistics(spark, sf_dir, extent).select(*SERIES_DIMS, "properties.*")


@query(f"""
SELECT {DIMS}, count(*) FILTER (WHERE Value = 0) AS zeros, count(*) - count(Value) AS nulls,
       count(*) FILTER (WHERE Value = 0) / greatest(1, count(Value)) AS zero_share
FROM points GROUP BY ALL
""")
def zeros_nulls(spark, sf_dir):
    p = [F.col(f"properties.{n}") for n in ("n_members", "zeros", "nulls")]
    return statistics(spark, sf_dir, ["n_members", "zeros", "nulls"]).select(
        *SERIES_DIMS, "properties.zeros", "properties.nulls", S.zero_share(*p).alias("zero_share")
    )


@query(f"SELECT {DIMS}, round(entropy, 6) AS entropy FROM series")
def series_entropy(spark, sf_dir):
    return statistics(spark, sf_dir, ["entropy"]).select(*SERIES_DIMS, F.round("properties.entropy", 6).alias("entropy"))


@query(f"""
SELECT {CLEAN_DIMS}, min_by(struct_pack(c := Area_code), ord).c AS Area_code FROM facts GROUP BY ALL
""")
def first_codes(spark, sf_dir):
    return S.first_codes(prepared(spark, sf_dir, **X.WITH_CODES))


@query(f"""
SELECT {DIMS}, len(data) AS n,
       array_to_string(list_transform(data, lambda p: CAST(p.Year AS VARCHAR) || ':' ||
         coalesce(CAST(CAST(round(p.Value * 100) AS BIGINT) AS VARCHAR), '-')), ',') AS points
FROM bundles
""")
def record_bundles(spark, sf_dir):
    return bundles(spark, sf_dir).select(
        *SERIES_DIMS,
        F.size("data").cast("bigint").alias("n"),
        F.array_join(
            F.transform("data", lambda p: F.concat(p["Year"].cast("string"), F.lit(":"), F.coalesce(F.round(p["Value"] * 100).cast("bigint").cast("string"), F.lit("-")))), ","
        ).alias("points"),
    )


# Sums have another order, and the engines round halves apart: digits at which these data have none.
DIGITS = {"mean": 12, "median": 12, "variance": 9}


@query(f"SELECT {DIMS}, {STATS.replace('mean, median, variance', ', '.join(f'{sql_sig(c, DIGITS[c])} AS {c}' for c in DIGITS))} FROM series")
def point_stats(spark, sf_dir):
    """Statistics straight from the points, as for series too long for one row; sums have another order."""
    points = materialize(S.dedup_keep_last(prepared(spark, sf_dir)), "points")
    return flat_properties(S.point_stats(points), *SERIES_DIMS).withColumns({c: sig(F.col(c), n) for c, n in DIGITS.items()})


@query("""
SELECT (SELECT count(*) FROM domains) AS domains, (SELECT count(*) FROM series) AS series,
       (SELECT CAST(sum(n_members) AS BIGINT) FROM series) AS records
""")
def catalogue_counts(spark, sf_dir):
    return X.catalogue(spark, sf_dir).counts()


@query(f"SELECT {DIMS}, n_members FROM series WHERE n_members >= 5")
def filter_min_points(spark, sf_dir):
    return S.filter_min_points(statistics(spark, sf_dir), 5).select(*SERIES_DIMS, "properties.n_members")


@query(f"SELECT {DIMS}, zeros FROM series WHERE zeros / greatest(1, n_members - nulls) < 0.1")
def filter_zero_share(spark, sf_dir):
    return S.filter_zero_share(statistics(spark, sf_dir), 0.1).select(*SERIES_DIMS, "properties.zeros")


@query(f"SELECT {DIMS}, variance FROM series WHERE variance IS NULL OR variance > 1e-12")
def filter_constant(spark, sf_dir):
    return S.filter_constant(statistics(spark, sf_dir)).select(*SERIES_DIMS, "properties.variance")


@query(f"""
SELECT {DIMS}, n_members FROM series
WHERE n_members >= 4 AND zeros / greatest(1, n_members - nulls) < 0.2 AND (variance IS NULL OR variance > 1e-12)
""")
def select_bundles(spark, sf_dir):
    """All three filters applied to the bundles, before any statistic is computed."""
    kept = S.select_bundles(bundles(spark, sf_dir), Filters(4, 0.2, True))
    return kept.select(*SERIES_DIMS, F.size("data").cast("bigint").alias("n_members"))


@query(f"SELECT {CLEAN_DIMS}, min(ord) AS first_seen FROM facts GROUP BY ALL")
def first_seen_order(spark, sf_dir):
    """Order key by which levels are sorted when written in order of first appearance."""
    return bundles(spark, sf_dir).select(*SERIES_DIMS, F.col(S.FIRST).alias("first_seen"))


@query("""
SELECT doc_id, regexp_replace(text, '^[\\s\\x0B\\x1C-\\x1F\\x85\\xA0]+|[\\s\\x0B\\x1C-\\x1F\\x85\\xA0]+$', '', 'g') AS text
FROM documents
""", base=False)
def clean_str(spark, sf_dir):
    """Documents padded with several kinds of white space come back bare."""
    padded = F.concat(F.lit("　\t"), F.col("text"), F.lit("  \n"))
    return X.table(spark, sf_dir, "documents").select("doc_id", K.clean_str(padded).alias("text"))


@query("""
SELECT DISTINCT '{"Area":' || CAST(to_json(Area) AS VARCHAR) || ',"Element":"","Item":' || CAST(to_json(Item) AS VARCHAR)
       || ',"Unit":' || CAST(to_json(coalesce(Unit, '')) AS VARCHAR) || ',"code":' || CAST(to_json(coalesce(Area_code, '')) AS VARCHAR) || '}' AS dims
FROM facts
""")
def canonical_dims(spark, sf_dir):
    """Element is missing, one extra has a padded name, one an empty name, one shadows Area."""
    raw = F.create_map(
        F.lit("Area"), F.concat(F.lit(" "), F.col("Area")), F.lit("Item"), F.col("Item"), F.lit("Unit"), F.col("Unit"),
        F.lit(" code "), F.col("Area_code"), F.lit("  "), F.lit("dropped"), F.lit("Area "), F.lit("shadow"),
    )
    canonical = X.facts(spark, sf_dir).select(K.canonical_dims(raw, L2_DIMS).alias("map"))
    fields = {n: F.try_element_at("map", F.lit(n)) for n in [*L2_DIMS, "code"]}
    return canonical.select(F.when(F.size("map") == 5, K.canonical_json(fields)).alias("dims")).distinct()


@query("""
SELECT doc_id, '{"lang":' || CAST(to_json(lang) AS VARCHAR) || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}' AS json FROM documents
""", base=False)
def canonical_json(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select(
        "doc_id", K.canonical_json({"text": F.col("text"), "lang": F.col("lang")}).alias("json")
    )


@query("SELECT domain_key, Domain, Sub_domain, Domain_table FROM domains")
def domain_key(spark, sf_dir):
    return S.domain_cards(prepared(spark, sf_dir)).select(K.domain_key().alias("domain_key"), *L3_DIMS)


@query(f"SELECT series_key, {DIMS} FROM series")
def series_key(spark, sf_dir):
    return S.series_groups(prepared(spark, sf_dir)).select(K.series_key().alias("series_key"), *SERIES_DIMS)


@query("SELECT domain_key, description FROM domains")
def domain_description(spark, sf_dir):
    return S.domain_cards(prepared(spark, sf_dir)).select(
        K.domain_key().alias("domain_key"), K.domain_description("Statistics").alias("description")
    )


@query("""
SELECT series_key, description || CASE WHEN Domain = 'Sales' THEN ' | code: ' || upper(Area) ELSE '' END || ' | kind: x' AS description
FROM series
""")
def series_description(spark, sf_dir):
    """Description with extras; an empty extra and a core name are skipped."""
    extras = F.create_map(
        F.lit("kind"), F.lit("x"), F.lit("code"), F.when(F.col("Domain") == "Sales", F.upper("Area")).otherwise(" "),
        F.lit("Area"), F.lit("shadow"),
    )
    return S.series_groups(prepared(spark, sf_dir)).select(
        K.series_key().alias("series_key"), K.series_description("Statistics", extras=extras).alias("description")
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'none' AS absent FROM events", base=False)
def json_path(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        "event_id",
        K.json_text(F.col("props"), "$.k").cast("bigint").alias("k"),
        K.json_text(F.col("props"), "$.parent.child", "none").alias("absent"),
    )
