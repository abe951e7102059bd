"""Composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tristrata.config import CatalogueConfig, EmbeddingSpec, SourceSpec
from tristrata.operators.projection import AXES
from tristrata.plans.build import run
from tristrata.plans.diagnostics import diagnostics as characterise
from tristrata.plans.maps import map_l2_l3 as joint_map
from tristrata.plans.preview import series_preview as preview
from tristrata.shared import scratch_path

from . import fixtures as X
from .lookup import KNOWN_KEY, POINTS_TEXT, points_text
from .profile import NUMERIC
from .registry import big, query, sig, sql_sig


PROPERTY_TEXT = "concat_ws(',', year_min, year_max, n_members, zeros, nulls, CAST(round(lo * 100) AS BIGINT), CAST(round(hi * 100) AS BIGINT), CAST(round(median * 100) AS BIGINT))"


@query(f"""
SELECT 'l3' AS level, domain_key AS key, description AS content,
       concat_ws('|', 'Domain=' || Domain, 'Domain_table=' || Domain_table, 'Sub_domain=' || Sub_domain) AS dims, '' AS properties, '-,0,v_0_1_0' AS meta FROM domains
UNION ALL SELECT 'l2', series_key, description, concat_ws('|', 'Area=' || Area, 'Element=' || Element, 'Item=' || Item, 'Unit=' || Unit),
       {PROPERTY_TEXT}, '-,0,v_0_1_0' FROM series
UNION ALL SELECT 'l1', series_key, {POINTS_TEXT.format('data')}, '', '', '' FROM series
""")
def build_catalogue(spark, sf_dir):
    """Every field of the three levels: texts, dimensions, properties and embedding facts."""
    c = X.catalogue(spark, sf_dir, stage=True)
    dims = F.array_join(F.transform(F.array_sort(F.map_entries("dims")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    facts = F.concat_ws(",", F.coalesce("embedding_meta.embedding_model", F.lit("-")), F.col("embedding_meta.embedding_dim").cast("string"), "embedding_meta.schema_version")
    p = F.col("properties")
    whole = [p[x].cast("string") for x in ("year_min", "year_max", "n_members", "zeros", "nulls")]
    cents = [F.round(p[x] * 100).cast("bigint").cast("string") for x in ("min", "max", "median")]
    parts = (
        (c.l3, "l3", "identity.domain_key", F.col("description.string"), dims, F.lit(""), facts),
        (c.l2, "l2", "identity.series_key", F.col("description.string"), dims, F.concat_ws(",", *whole, *cents), facts),
        (c.l1, "l1", "identity.series_key", points_text("data"), F.lit(""), F.lit(""), F.lit("")),
    )
    out = None
    for df, level, key, content, dims, properties, meta in parts:
        part = df.select(
            F.lit(level).alias("level"), F.col(key).alias("key"), content.alias("content"), dims.alias("dims"), properties.alias("properties"), meta.alias("meta")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("""
SELECT 'l3' AS artefact, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_points, 'hashed-tokens-64' AS model, true AS checksums FROM domains
UNION ALL SELECT 'l2', count(*), CAST(sum(n_members) AS BIGINT), 'hashed-tokens-64', true FROM series
UNION ALL SELECT 'l1', count(*), CAST(sum(n_members) AS BIGINT), NULL, true FROM series
""")
def run_catalogue(spark, sf_dir):
    """Both sources as delimited files, built, written and counted by one call; rows from its manifest."""
    root = scratch_path(spark, "run")
    sources = []
    for number, (name, facts, meta) in enumerate((("sales", X.sales_facts, X.SALES_META), ("web", X.web_facts, X.WEB_META)), 1):
        facts(spark, sf_dir).orderBy("seq").drop("seq").write.option("header", True).csv(f"{root}/{name}")
        sources.append(SourceSpec(number, f"{root}/{name}", meta))
    config = CatalogueConfig(sources, embeddings=EmbeddingSpec(enabled=True))
    done = run(spark, config, f"{root}/out")
    manifest = spark.read.json(done["manifest"])
    levels = {x: spark.read.json(done["paths"][x]) for x in ("l3", "l2")}
    model = None
    for x, df in levels.items():
        part = df.select(F.lit(x).alias("artefact"), F.col("embedding_meta.embedding_model").alias("model")).distinct()
        model = part if model is None else model.unionByName(part)
    points = F.when(F.col("artefact") == "l3", 0).otherwise(done["counts"]["records"]).cast("bigint")
    files = manifest.groupBy("artefact").agg(
        F.first("rows_of_artefact").alias("n_rows"), (F.min(F.length("sha256")) == 64).alias("checksums")
    )
    return files.join(model, "artefact", "left").select("artefact", "n_rows", points.alias("n_points"), "model", "checksums")


@query(f"""
, {NUMERIC}
SELECT property, count(value) AS n, {sql_sig('quantile_cont(value, 0.5)', 12)} AS median, {sql_sig('avg(value)')} AS mean,
       count(value) / (SELECT count(*) FROM series) AS coverage,
       (SELECT count(*) FROM series) AS n_embedded
FROM props JOIN numeric USING (property) GROUP BY property
""")
def diagnostics(spark, sf_dir):
    d = characterise(X.stored_catalogue(spark, sf_dir, embedded=True))
    stats = d.stats.join(d.numeric.select("property", "coverage"), "property")
    return stats.select(
        "property", "n", sig(F.col("median"), 12).alias("median"), sig(F.col("mean")).alias("mean"), "coverage",
        F.lit(d.map_facts["n_total_embeddings"]).cast("bigint").alias("n_embedded"),
    )


@query("""
SELECT 'points' AS part, CAST(p.Year AS BIGINT) AS position, p.Value AS value
FROM (SELECT unnest(data) AS p FROM series WHERE Area = 'u1' AND Item = 'click')
UNION ALL
SELECT 'histogram', CAST(j AS BIGINT), CAST(len(list_filter(vals, lambda v:
   len(list_filter(range(1, 20), lambda i: v >= e_lo + i * ((e_hi - e_lo) / 20))) = j)) AS DOUBLE)
FROM (SELECT *, unnest(range(0, 20)) AS j FROM series WHERE Area = 'u1' AND Item = 'click')
""")
def series_preview(spark, sf_dir):
    p = preview(X.stored_catalogue(spark, sf_dir), KNOWN_KEY)
    points = p.points.select(F.lit("points").alias("part"), big("Year").alias("position"), F.col("Value").alias("value"))
    bins = p.histogram.select(
        F.lit("histogram").alias("part"), big("bin").alias("position"), F.col("count").cast("double").alias("value")
    )
    return points.unionByName(bins)


@query("""
SELECT series_key, description AS title FROM series ORDER BY n_members DESC, series_key LIMIT 1 OFFSET 2
""")
def series_preview_by_rank(spark, sf_dir):
    return preview(X.stored_catalogue(spark, sf_dir), rank=3).title


@query("""
, ranked AS (SELECT Item, row_number() OVER (ORDER BY count(*) DESC, Item) AS r FROM series GROUP BY Item)
SELECT 'series' AS part, CASE WHEN r <= 4 THEN Item ELSE 'Other' END AS label, count(*) AS label_count, count(*) AS n
FROM series JOIN ranked USING (Item) GROUP BY 1, 2
UNION ALL SELECT 'domain', Domain_table, 1, 1 FROM domains
""")
def map_l2_l3(spark, sf_dir):
    """Joint map of all series and domains, counted per colour label and symbol."""
    m = joint_map(X.stored_catalogue(spark, sf_dir, embedded=True), "Item", topk_colors=4)
    placed = F.col(f"`{AXES[0]}`").isNotNull() & F.col(f"`{AXES[1]}`").isNotNull()
    series = m.series.filter(placed).groupBy(F.lit("series").alias("part"), "label", "label_count").agg(F.count("*").alias("n"))
    domains = m.domains.filter(placed).groupBy(F.lit("domain").alias("part"), F.col("symbol").alias("label")).agg(
        F.count("*").alias("label_count"), F.count("*").alias("n")
    )
    return series.unionByName(domains)


@query("""
, codes AS (SELECT Domain, Area, Item, Element, coalesce(Unit, '') AS Unit, coalesce(min_by(struct_pack(c := Area_code), ord).c, '') AS code FROM facts GROUP BY ALL),
coded AS (SELECT series_key, CASE WHEN code = '' THEN '(empty)' ELSE code END AS code FROM series JOIN codes USING (Domain, Area, Item, Element, Unit)),
ranked AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) AS r FROM coded GROUP BY code)
SELECT CASE WHEN r <= 12 THEN code ELSE 'Other' END AS label, count(*) AS label_count, count(*) AS n
FROM coded JOIN ranked USING (code) GROUP BY 1
""")
def map_by_code(spark, sf_dir):
    """The joint map coloured by a code that only some series have."""
    m = joint_map(X.stored_catalogue(spark, sf_dir, embedded=True), "Area_code")
    return m.series.groupBy("label", "label_count").agg(F.count("*").alias("n"))
