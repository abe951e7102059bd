"""Validate written levels and record the evidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CatalogueConfig
from ..operators.validate import LEVELS, validate_level, validation_errors, validation_summary
from ..schema import SCHEMA_VERSION
from ..shared import materialize
from ..sources.levels import content_digest, dataset_manifest, read_lines


@dataclass
class Validation:
    """One-row summary and the reported errors."""

    summary: DataFrame
    errors: DataFrame


def validate_lines(lines: dict[str, DataFrame], max_errors: int | None = None) -> Validation:
    """Check (line, value) frames of the three levels.

    Each level is parsed once; only its links and error codes are kept for the checks.
    """
    checked = {
        level: materialize(validate_level(lines[level], level), f"checked-{level}") for level in LEVELS
    }
    return Validation(validation_summary(checked), validation_errors(checked, max_errors))


def validate_catalogue(
    spark: SparkSession, paths: dict[str, str], max_errors: int | None = None
) -> Validation:
    return validate_lines({level: read_lines(spark, paths[level]) for level in LEVELS}, max_errors)


def repro_manifest(
    spark: SparkSession,
    paths: dict[str, str],
    config: CatalogueConfig | None = None,
    max_errors: int = 20,
    validate: bool = True,
) -> DataFrame:
    """One JSON row: contract, configuration, runtime, artefacts and validation.

    Only totals and at most ``max_errors`` errors per level enter the document: file
    count, bytes, lines and an order-free digest per artefact. The checksum of every
    part file is a table of its own (:func:`dataset_manifest`).
    """
    files = dataset_manifest(spark, paths).groupBy("artefact").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
    )
    digests = None
    for level in sorted(paths):
        part = content_digest(spark.read.text(paths[level]), ["value"]).withColumn("artefact", F.lit(level))
        digests = part if digests is None else digests.unionByName(part)
    artefacts = files.join(digests, "artefact").agg(
        F.array_sort(F.collect_list(F.struct("artefact", "files", "bytes", "rows", "digest_xor", "digest_sum")))
        .alias("artefacts")
    )
    checks = validate_catalogue(spark, paths, max_errors) if validate else None
    null = F.lit(None).cast("string")
    document = {
        "written_utc": F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
        ),
        "contract": F.struct(
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit("l3.domain_key -> l2.domain_key -> l1.series_key").alias("expansion"),
        ),
        "config": F.lit(config.to_json()) if config else null,
        "environment": F.struct(
            F.lit(spark.version).alias("spark"),
            F.lit(spark.conf.get("spark.sql.shuffle.partitions")).alias("shuffle_partitions"),
            F.lit(spark.conf.get("spark.sql.adaptive.enabled")).alias("adaptive"),
        ),
        "artefacts": F.col("artefacts"),
    }
    if checks is not None:
        summary = checks.summary.select(F.struct("*").alias("s")).scalar()
        errors = checks.errors.agg(
            F.array_sort(F.collect_list(F.struct("level", "line", "error"))).alias("e")
        ).scalar()
        document["validation"] = F.struct(summary.alias("summary"), errors.alias("errors"))
    fields = [c.alias(n) for n, c in document.items()]
    return artefacts.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("manifest"))


