"""Encoders, vector expressions and two-dimensional maps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tristrata.functions import vectors as V
from tristrata.operators import profile as P
from tristrata.operators import projection as M
from tristrata.operators import validate as C
from tristrata.plans.diagnostics import labelled_embeddings
from tristrata.schema import SERIES_DIMS
from tristrata.shared import materialize

from . import fixtures as X
from .registry import big, query


def micros(vec):
    """Vector as whole millionths, one row per slot."""
    return F.posexplode(F.transform(vec, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint"))).alias("slot", "x")


@query("""
SELECT vec_id, CAST(i - 1 AS BIGINT) AS slot,
       CAST(round(CAST(CAST(CAST(embedding[i] AS DOUBLE) / n AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT) AS x
FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) AS n,
             unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
""", base=False)
def l2_normalize(spark, sf_dir):
    e = X.table(spark, sf_dir, "embeddings")
    rows = e.select("vec_id", micros(V.l2_normalize(F.col("embedding"))))
    return rows.select("vec_id", big("slot").alias("slot"), "x")


HASHED = """
WITH tokens AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower({text}), '[ \\t\\r\\n]+'), lambda t: t <> '')) AS t FROM documents),
slots AS (
  SELECT doc_id, (strpos('0123456789abcdef', substr(md5(t), 1, 1)) - 1) * 4096 + (strpos('0123456789abcdef', substr(md5(t), 2, 1)) - 1) * 256
              + (strpos('0123456789abcdef', substr(md5(t), 3, 1)) - 1) * 16 + (strpos('0123456789abcdef', substr(md5(t), 4, 1)) - 1) AS h,
         CASE WHEN substr(md5(t), 5, 1) < '8' THEN 1 ELSE -1 END AS s FROM tokens),
sums AS (SELECT doc_id, h % 64 AS slot, CAST(sum(s) AS DOUBLE) AS v FROM slots GROUP BY ALL),
norms AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM sums GROUP BY doc_id)
SELECT doc_id, CAST(slot AS BIGINT) AS slot,
       CAST(round(CAST(CAST(v / n AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT) AS x
FROM sums JOIN norms USING (doc_id) WHERE v <> 0
"""


def _nonzero(df):
    return df.select("doc_id", micros("vec")).filter("x <> 0").select("doc_id", big("slot").alias("slot"), "x")


@query(HASHED.format(text="text"), base=False)
def embed_text(spark, sf_dir):
    """Default encoder over whole documents."""
    docs = X.table(spark, sf_dir, "documents").select("doc_id", "text")
    # The table may be one row group: its texts are dealt to all cores by measured work.
    return _nonzero(V.embed_text(docs, "text", "vec"))


@query(HASHED.format(text="lang || ' ' || source"), base=False)
def embed_distinct(spark, sf_dir):
    """Few distinct texts: each is encoded once and joined back."""
    docs = X.table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "lang", "source").alias("label"))
    return _nonzero(V.embed_distinct(docs, "label", "vec"))


@query("""
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars,
       CAST(length(text) - length(replace(text, ' ', '')) AS BIGINT) AS n_spaces FROM documents
""", base=False)
def embed_text_custom(spark, sf_dir):
    """A caller's encoder, loaded once per task and fed in batches."""
    def factory():
        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)

    docs = X.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = V.embed_text(docs, "text", "vec", factory, normalize=False, batch_size=100)
    return out.select("doc_id", big(F.col("vec")[0]).alias("n_chars"), big(F.col("vec")[1]).alias("n_spaces"))


@query("""
SELECT CAST(label AS BIGINT) AS label, count(*) AS n FROM embeddings WHERE vec_id % 5 NOT IN (0, 1, 2) GROUP BY 1
""", base=False)
def usable_embeddings(spark, sf_dir):
    """Missing, empty and non-finite vectors are left out."""
    k = F.col("vec_id") % 5
    e = X.table(spark, sf_dir, "embeddings").select(
        "label",
        F.when(k == 0, None)
        .when(k == 1, F.slice("embedding", 1, 0))
        .when(k == 2, F.concat("embedding", F.array(F.lit(float("nan")).cast("float"))))
        .otherwise(F.col("embedding"))
        .alias("embedding"),
    )
    rows = e.select("label", F.struct("embedding").alias("description"))
    return P.usable_embeddings(rows).groupBy(big("label").alias("label")).agg(F.count("*").alias("n"))


@query("""
SELECT count(*) AS n_series, count(*) AS n_usable, CAST(0 AS BIGINT) AS n_missing FROM series
""")
def embedding_coverage(spark, sf_dir):
    return P.embedding_coverage(X.stored_catalogue(spark, sf_dir, embedded=True).l2)


@query("""
SELECT CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS side,
       min_by(CAST(len(embedding) - label % 2 * (vec_id % 2) AS BIGINT), vec_id) AS embedding_dim,
       count(DISTINCT len(embedding) - label % 2 * (vec_id % 2)) <= 1 AS consistent
FROM embeddings GROUP BY 1
""", base=False)
def embedding_dim_check(spark, sf_dir):
    """Vectors of odd labels lose their last slot on odd rows."""
    odd = F.col("label") % 2
    e = X.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("line"), odd.alias("odd"),
        (F.size("embedding") - odd * (F.col("vec_id") % 2)).cast("bigint").alias("embedding_dim"),
    )
    parts = [
        C.embedding_dim_check(e.filter(F.col("odd") == flag)).withColumn("side", F.lit(name))
        for flag, name in ((0, "even"), (1, "odd"))
    ]
    return parts[0].unionByName(parts[1])


SQUARINGS = 14


def pca_sql(select: str) -> str:
    """Both axes from the covariance as a relation: repeated squaring is power iteration.

    A matrix squared again and again, at trace one, tends to the projector on its first
    axis; without that axis the same gives the second.
    """
    steps = []

    def axis(cov: str, name: str) -> None:
        steps.append(f"{name}0 AS (SELECT i, j, v / (SELECT sum(v) FROM {cov} WHERE i = j) AS v FROM {cov})")
        for k in range(SQUARINGS):
            steps.append(f"{name}s{k} AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {name}{k} a JOIN {name}{k} b ON a.j = b.i GROUP BY ALL)")
            steps.append(f"{name}{k + 1} AS (SELECT i, j, v / (SELECT sum(v) FROM {name}s{k} WHERE i = j) AS v FROM {name}s{k})")
        last = f"{name}{SQUARINGS}"
        steps.append(f"{name}top AS (SELECT i, v FROM {last} WHERE i = j ORDER BY v DESC, i LIMIT 1)")
        steps.append(f"{name}raw AS (SELECT p.i, p.v / sqrt(t.v) AS v FROM {last} p JOIN {name}top t ON p.j = t.i)")
        steps.append(f"{name} AS (SELECT i, v * (SELECT sign(v) FROM {name}raw ORDER BY abs(v) DESC, i LIMIT 1) AS v FROM {name}raw)")

    axis("cov", "one")
    steps.append("strength AS (SELECT sum(a.v * c.v * b.v) AS v FROM cov c JOIN one a ON a.i = c.i JOIN one b ON b.i = c.j)")
    steps.append("rest AS (SELECT c.i, c.j, c.v - (SELECT v FROM strength) * a.v * b.v AS v FROM cov c JOIN one a ON a.i = c.i JOIN one b ON b.i = c.j)")
    axis("rest", "two")
    chain = ",\n".join(step if " AS MATERIALIZED" in step else step.replace(" AS (", " AS MATERIALIZED (", 1) for step in steps)
    return f"""
WITH x AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
m AS (SELECT i, avg(v) AS v FROM x GROUP BY i),
c AS MATERIALIZED (SELECT vec_id, label, i, x.v - m.v AS v FROM x JOIN m USING (i)),
cov AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM c a JOIN c b USING (vec_id) GROUP BY ALL),
{chain},
placed AS (SELECT vec_id, label, sum(c.v * one.v) AS a, sum(c.v * two.v) AS b FROM c JOIN one USING (i) JOIN two USING (i) GROUP BY ALL)
{select}
"""


PLACED = "round(CAST(CAST(a AS FLOAT) AS DOUBLE), 4) AS dim_1, round(CAST(CAST(b AS FLOAT) AS DOUBLE), 4) AS dim_2"


def _coordinates():
    return [F.round(F.col(f"`{a}`").cast("double"), 4).alias(a.replace(" ", "_").lower()) for a in M.AXES]


@query(pca_sql(f"SELECT vec_id, label, {PLACED} FROM placed"), base=False)
def pca_2d(spark, sf_dir):
    return M.pca_2d(X.table(spark, sf_dir, "embeddings")).rows.select("vec_id", "label", *_coordinates())


@query(pca_sql(f"SELECT CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS side, vec_id, {PLACED} FROM placed"), base=False)
def pca_2d_joint(spark, sf_dir):
    """One fit over even and odd labels, split back."""
    e = X.table(spark, sf_dir, "embeddings")
    a, b = M.pca_2d_joint(e.filter("label % 2 = 0"), e.filter("label % 2 = 1"), "vec_id", "vec_id")
    both = a.withColumn("side", F.lit("even")).unionByName(b.withColumn("side", F.lit("odd")))
    return both.select("side", "vec_id", *_coordinates())


@query("""
SELECT 'pca' AS method, count(*) AS n_total, least(count(*), 300) AS n_used, CAST(42 AS BIGINT) AS seed,
       CAST(300 AS BIGINT) AS sample_n, CAST(2 AS BIGINT) AS n_ratios, true AS descending FROM embeddings
""", base=False)
def pca_meta(spark, sf_dir):
    _, facts = M.embedding_map(X.table(spark, sf_dir, "embeddings"), F.col("vec_id").cast("string"), sample_n=300)
    ratio = facts["explained_variance_ratio"]
    row = (
        facts["method"], facts["n_total_embeddings"], facts["n_used"], facts["seed"], facts["sample_n"],
        len(ratio), 1.0 > ratio[0] >= ratio[1] > 0.0,
    )
    return spark.createDataFrame(
        [row], "method string, n_total bigint, n_used bigint, seed bigint, sample_n bigint, n_ratios bigint, descending boolean"
    )


@query("""
SELECT vec_id, true AS moved, true AS near FROM embeddings
""", base=False)
def jitter_if_degenerate(spark, sf_dir):
    """Two distinct points only, so every row is moved a little."""
    flat = X.table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") % 2).cast("float").alias(M.AXES[0]), F.lit(0.0).cast("float").alias(M.AXES[1])
    )
    out = M.jitter_if_degenerate(flat.withColumn("x0", F.col(f"`{M.AXES[0]}`")), F.col("vec_id").cast("string"))
    dx, dy = F.col(f"`{M.AXES[0]}`") - F.col("x0"), F.col(f"`{M.AXES[1]}`")
    return out.select(
        "vec_id", (dy != 0).alias("moved"), ((F.abs(dx) < 0.001) & (F.abs(dy) < 0.001)).alias("near")
    )


@query("""
, long AS (SELECT unnest(['Domain', 'Sub_domain', 'Domain_table', 'Area', 'Item', 'Element', 'Unit']) AS dim,
                  unnest([Domain, Sub_domain, Domain_table, Area, Item, Element, Unit]) AS cat FROM series),
ranked AS (SELECT dim, cat, row_number() OVER (PARTITION BY dim ORDER BY count(*) DESC, cat) AS r FROM long GROUP BY dim, cat)
SELECT dim, CASE WHEN r <= 10 THEN cat ELSE '(other)' END AS label, count(*) AS label_count, count(*) AS n_points
FROM long JOIN ranked USING (dim, cat) GROUP BY 1, 2
""")
def scatter_tables(spark, sf_dir):
    """Map points of all embedded series, counted per label of each dimension."""
    found = M.embedding_map(
        labelled_embeddings(X.stored_catalogue(spark, sf_dir, embedded=True)), F.col("series_key")
    )
    points = materialize(found[0].select("series_key", *SERIES_DIMS, *M.AXES), "map")
    tables = M.scatter_tables(points).filter(F.col(f"`{M.AXES[0]}`").isNotNull())
    return tables.groupBy("dim", "label", "label_count").agg(F.count("*").alias("n_points"))
