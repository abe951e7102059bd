"""Validation of level lines with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from tristrata.functions.text import WHITESPACE
from tristrata.operators import validate as V
from tristrata.plans import validation as P
from tristrata.shared import scratch_path
from tristrata.sources.levels import read_lines as lines_of
from tristrata.sources.levels import write_jsonl_level

from . import fixtures as X
from .registry import query

# Hex digits of a series key decide which fault its lines get.
LINE = "CAST('0x' || substr(series_key, 8, 12) AS BIGINT)"
FAULTS = f"""
, faults AS (
  SELECT series_key, domain_key, n_members, {LINE} AS line, substr(series_key, 8, 1) AS d2, substr(series_key, 9, 1) AS d1,
    CASE substr(series_key, 8, 1) WHEN '0' THEN 'unknown_field' WHEN '1' THEN 'kind' WHEN '2' THEN 'series_key'
      WHEN '3' THEN 'properties' WHEN '4' THEN 'embedding_model' WHEN '7' THEN 'description' ELSE '' END AS e2,
    CASE substr(series_key, 9, 1) WHEN '0' THEN 'year' WHEN '2' THEN 'value' WHEN '4' THEN 'data_item'
      WHEN '5' THEN 'unparseable' WHEN '6' THEN 'unknown_field' ELSE '' END AS e1
  FROM series),
l2_ok AS (SELECT series_key, CASE WHEN d2 = '6' THEN 'sha256:zz' || substr(domain_key, 10) ELSE domain_key END AS domain_key,
                 n_members + CASE WHEN d2 = '5' THEN 1 ELSE 0 END AS n FROM faults WHERE e2 = ''),
l1_ok AS (SELECT series_key, n_members AS n FROM faults WHERE e1 = '' AND d1 <> '1')
"""


def _line(key):
    return F.conv(F.substring(key, 8, 12), 16, 10).cast("bigint")


def planted(spark, sf_dir):
    """(line, value) frames of the three levels with one kind of fault per key digit."""
    c = X.stored_catalogue(spark, sf_dir)
    key = F.col("identity.series_key")
    value = F.col("value")
    options = {"ignoreNullFields": "false"}

    def as_lines(df, key):
        return df.select(key.alias("key"), _line(key).alias("line"), F.to_json(F.struct("*"), options).alias("value"))

    def patched(lines, digit, patches):
        out = None
        for d, patch in patches.items():
            out = F.when(digit == d, patch) if out is None else out.when(digit == d, patch)
        return lines.select("line", out.otherwise(value).alias("value"))

    l2, l1 = as_lines(c.l2, key), as_lines(c.l1, key)
    n = F.regexp_extract(value, '"n_members":([0-9]+)', 1).cast("bigint") + 1
    return {
        "l3": as_lines(c.l3, F.col("identity.domain_key")).select("line", "value"),
        "l2": patched(l2, F.substring("key", 8, 1), {
            "0": F.concat(F.lit('{"extra":1,'), F.substring(value, F.lit(2), F.length(value))),
            "1": F.replace(value, F.lit('"kind":"series"'), F.lit('"kind":"serie"')),
            "2": F.replace(value, F.lit('"series_key":"sha256:'), F.lit('"series_key":"md5:')),
            "3": F.regexp_replace(value, '"n_members":[0-9]+', '"n_members":null'),
            "4": F.replace(value, F.lit('"embedding_dim":0'), F.lit('"embedding_dim":5')),
            "5": F.regexp_replace(value, F.lit('"n_members":[0-9]+'), F.concat(F.lit('"n_members":'), n.cast("string"))),
            "6": F.regexp_replace(value, '"domain_key":"sha256:..', '"domain_key":"sha256:zz'),
            "7": F.replace(value, F.lit('"string":'), F.lit('"strong":')),
        }),
        "l1": patched(l1.filter(F.substring("key", 9, 1) != "1"), F.substring("key", 9, 1), {
            "0": F.regexp_replace(value, r'^(.*?)"Year":-?[0-9]+', '$1"Year":null'),
            "2": F.regexp_replace(value, r'^(.*?)"Value":[^,}]+', '$1"Value":"abc"'),
            "3": F.regexp_replace(value, r'^(.*?)"Value":[^,}]+', '$1"Value":" "'),
            "4": F.replace(value, F.lit('"Year":'), F.lit('"Yr":1,"Year":')),
            "5": F.substring(value, F.lit(1), F.length(value) - 2),
            "6": F.replace(value, F.lit('"data":'), F.lit('"date":')),
            # A missing number, as other writers spell it: valid.
            "7": F.regexp_replace(value, r'^(.*?)"Value":[^,}]+', '$1"Value":NaN'),
            "8": F.regexp_replace(value, r'^(.*?)"Value":[^,}]+', '$1"Value": -Infinity '),
        }),
    }


def lines(spark, sf_dir):
    return X.stored(spark, sf_dir, "lines", lambda: planted(spark, sf_dir))


def checked(spark, sf_dir):
    """Links and error codes of every line, as the composite check keeps them."""
    def build():
        return {level: V.validate_level(df, level) for level, df in lines(spark, sf_dir).items()}

    return X.stored(spark, sf_dir, "checked", build)


def valid(spark, sf_dir):
    return {level: df.filter(F.size("errors") == 0) for level, df in checked(spark, sf_dir).items()}


@query(FAULTS + """
SELECT 'l2' AS level, line, e2 AS error FROM faults
UNION ALL SELECT 'l1', line, e1 FROM faults WHERE d1 <> '1'
UNION ALL SELECT 'l3', """ + LINE.replace("series_key", "domain_key") + """ + k, e
FROM domains, (VALUES (0, ''), (1, 'kind'), (2, 'dims'), (3, 'domain_key')) AS planted(k, e)
""")
def validate_level(spark, sf_dir):
    """Error codes of every line; valid lines have none. Domain lines come whole and with three faults."""
    given = dict(lines(spark, sf_dir))
    value = F.col("value")
    faults = F.array(
        value,
        F.replace(value, F.lit('"kind":"domain"'), F.lit('"kind":"dom"')),
        F.regexp_replace(value, r'"dims":\{[^}]*\},', ""),
        F.replace(value, F.lit('"domain_key":"sha256:'), F.lit('"domain_key":"md5:')),
    )
    given["l3"] = given["l3"].select((F.col("line")).alias("at"), F.posexplode(faults).alias("k", "value")).select((F.col("at") + F.col("k")).alias("line"), "value")
    found = {level: V.validate_level(df, level) for level, df in given.items()}
    parts = [
        found[x].select(F.lit(x).alias("level"), "line", F.array_join("errors", ",").alias("error")) for x in ("l2", "l1", "l3")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(FAULTS + """
SELECT 'l2' AS level, line, e2 AS error FROM faults WHERE e2 <> ''
UNION ALL SELECT 'l1', line, e1 FROM faults WHERE d1 <> '1' AND e1 <> ''
""")
def validation_errors(spark, sf_dir):
    return V.validation_errors(checked(spark, sf_dir), max_errors=None)


@query(FAULTS + """
, e AS (SELECT 'l2' AS level, line, e2 AS error FROM faults WHERE e2 <> ''
        UNION ALL SELECT 'l1', line, e1 FROM faults WHERE d1 <> '1' AND e1 <> '')
SELECT level, line, error FROM (SELECT *, row_number() OVER (PARTITION BY level ORDER BY line) AS r FROM e) WHERE r <= 20
""")
def error_limit(spark, sf_dir):
    """First twenty faulty lines of each level."""
    return V.error_limit(V.validation_errors(checked(spark, sf_dir), max_errors=None))


SUMMARY = """
, counts AS (
  SELECT (SELECT count(*) FROM domains) AS n_domains_l3, (SELECT count(*) FROM l2_ok) AS n_series_l2,
         (SELECT count(*) FROM l1_ok) AS n_series_l1, CAST(0 AS BIGINT) AS embedding_dim_l3, CAST(0 AS BIGINT) AS embedding_dim_l2,
         (SELECT count(*) FROM l2_ok JOIN l1_ok USING (series_key) WHERE l2_ok.n <> l1_ok.n) AS n_members_mismatch,
         (SELECT count(*) FROM l2_ok WHERE series_key NOT IN (SELECT series_key FROM l1_ok)) AS missing_series_in_l1,
         (SELECT count(*) FROM l1_ok WHERE series_key NOT IN (SELECT series_key FROM l2_ok)) AS missing_series_in_l2,
         (SELECT count(DISTINCT domain_key) FROM l2_ok WHERE domain_key NOT IN (SELECT domain_key FROM domains)) AS missing_domain_in_l3,
         CAST(0 AS BIGINT) AS errors_l3, (SELECT count(*) FROM faults WHERE e2 <> '') AS errors_l2,
         (SELECT count(*) FROM faults WHERE d1 <> '1' AND e1 <> '') AS errors_l1)
SELECT *, missing_series_in_l1 = 0 AND missing_series_in_l2 = 0 AS series_keys_match, missing_domain_in_l3 = 0 AS domain_keys_covered,
       n_members_mismatch + missing_series_in_l1 + missing_series_in_l2 + missing_domain_in_l3 + errors_l3 + errors_l2 + errors_l1 = 0 AS ok
FROM counts
"""


@query(FAULTS + SUMMARY)
def validation_summary(spark, sf_dir):
    return V.validation_summary(checked(spark, sf_dir))


@query(FAULTS + "SELECT series_key FROM l2_ok WHERE series_key NOT IN (SELECT series_key FROM l1_ok)")
def series_missing_in_records(spark, sf_dir):
    c = valid(spark, sf_dir)
    return V.series_missing_in_records(c["l2"], c["l1"])


@query(FAULTS + "SELECT series_key FROM l1_ok WHERE series_key NOT IN (SELECT series_key FROM l2_ok)")
def records_missing_in_series(spark, sf_dir):
    c = valid(spark, sf_dir)
    return V.records_missing_in_series(c["l2"], c["l1"])


@query(FAULTS + "SELECT DISTINCT domain_key FROM l2_ok WHERE domain_key NOT IN (SELECT domain_key FROM domains)")
def uncovered_domains(spark, sf_dir):
    c = valid(spark, sf_dir)
    return V.uncovered_domains(c["l3"], c["l2"])


@query(FAULTS + """
SELECT series_key, l2_ok.n AS n_members, l1_ok.n AS n_points FROM l2_ok JOIN l1_ok USING (series_key) WHERE l2_ok.n <> l1_ok.n
""")
def n_members_mismatch(spark, sf_dir):
    c = valid(spark, sf_dir)
    return V.n_members_mismatch(c["l2"], c["l1"])


@query(FAULTS + """
SELECT (SELECT count(*) FROM l2_ok) AS n_l2, (SELECT count(*) FROM l1_ok) AS n_l1,
       (SELECT count(*) FROM l2_ok JOIN l1_ok USING (series_key)) AS n_common,
       (SELECT count(*) FROM l2_ok WHERE series_key NOT IN (SELECT series_key FROM l1_ok)) AS only_l2,
       (SELECT count(*) FROM l1_ok WHERE series_key NOT IN (SELECT series_key FROM l2_ok)) AS only_l1, false AS equal
""")
def key_set_report(spark, sf_dir):
    c = valid(spark, sf_dir)
    return V.key_set_report(c["l2"], c["l1"])


@query(FAULTS + """
SELECT series_key FROM l2_ok UNION ALL SELECT series_key FROM l1_ok
""")
def union_all(spark, sf_dir):
    c = valid(spark, sf_dir)
    return c["l2"].select("series_key").unionByName(c["l1"].select("series_key"))


@query("""
SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS line, CAST(length(lang || source) AS BIGINT) AS n FROM documents
""", base=False)
def read_lines(spark, sf_dir):
    """Lines written over several files keep their number; blank lines do not count."""
    path = scratch_path(spark, "lines")
    docs = X.table(spark, sf_dir, "documents")
    text = F.concat(F.lit("  "), F.col("doc_id").cast("string"), F.lit(" "), "lang", "source", F.lit("\n \n"))
    docs.orderBy("doc_id").select(text.alias("value")).write.text(path)
    words = F.split("value", " ", 2)
    return lines_of(spark, path).select(
        words[0].cast("bigint").alias("doc_id"), "line",
        F.length(F.btrim(words[1], F.lit(WHITESPACE))).cast("bigint").alias("n"),
    )


@query("""
SELECT true AS ok, (SELECT count(*) FROM domains) AS n_domains_l3, count(*) AS n_series_l2, count(*) AS n_series_l1,
       CAST(64 AS BIGINT) AS embedding_dim_l3, CAST(64 AS BIGINT) AS embedding_dim_l2, true AS series_keys_match,
       true AS domain_keys_covered, CAST(0 AS BIGINT) AS n_members_mismatch, CAST(0 AS BIGINT) AS errors_l3,
       CAST(0 AS BIGINT) AS errors_l2, CAST(0 AS BIGINT) AS errors_l1
FROM series
""")
def validate_catalogue(spark, sf_dir):
    """An embedded catalogue written as JSON lines passes every check."""
    return P.validate_catalogue(spark, _written(spark, sf_dir)).summary.drop(
        "missing_series_in_l1", "missing_series_in_l2", "missing_domain_in_l3"
    )


def _written(spark, sf_dir):
    c = X.stored_catalogue(spark, sf_dir, embedded=True)
    return {
        level: write_jsonl_level(getattr(c, level), scratch_path(spark, f"{level}-jsonl")) for level in ("l3", "l2", "l1")
    }


@query("""
SELECT artefact, n AS "rows", true AS has_files, 'v_0_1_0' AS schema_version, true AS ok, (SELECT count(*) FROM series) AS n_series,
       CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS n_reported
FROM (SELECT 'l3' AS artefact, count(*) AS n FROM domains UNION ALL SELECT 'l2', count(*) FROM series UNION ALL SELECT 'l1', count(*) FROM series)
""")
def repro_manifest(spark, sf_dir):
    """The manifest's stable fields, read back from its JSON."""
    kind = (
        "artefacts array<struct<artefact string, files bigint, bytes bigint, rows bigint>>, contract struct<schema_version string>, "
        "validation struct<summary struct<ok boolean, n_series_l2 bigint, errors_l1 bigint, errors_l2 bigint, errors_l3 bigint>, errors array<string>>"
    )
    said = P.repro_manifest(spark, _written(spark, sf_dir)).select(F.from_json("manifest", kind).alias("m"))
    summary = F.col("m.validation.summary")
    return said.select("m", F.inline("m.artefacts")).select(
        "artefact", "rows", ((F.col("files") > 0) & (F.col("bytes") > F.col("rows"))).alias("has_files"),
        F.col("m.contract.schema_version").alias("schema_version"), summary.ok.alias("ok"), summary.n_series_l2.alias("n_series"),
        (summary.errors_l1 + summary.errors_l2 + summary.errors_l3).alias("errors"), F.size("m.validation.errors").cast("bigint").alias("n_reported"),
    )
