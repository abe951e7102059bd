"""The catalogue build: facts to L3, L2 and L1."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BuildSpec, CatalogueConfig, EmbeddingSpec
from ..functions.vectors import HashedTokens, embed_distinct, embed_text
from ..operators.columns import prepare_facts
from ..operators.levels import domain_level, records_level, series_level, with_keys
from ..operators.series import (
    FIRST,
    catalogue_counts,
    code_sets,
    dedup_keep_last,
    record_bundles,
    select_bundles,
    series_stats,
)
from ..schema import L3_DIMS, LEVEL_SCHEMAS, ORDER
from ..shared import materialize, scratch_scope
from ..sources.levels import dataset_manifest, read_jsonl_level, read_keyed_level, write_jsonl_level, write_keyed_level
from ..sources.tables import read_sources


@dataclass
class Catalogue:
    """The three levels as DataFrames."""

    l3: DataFrame
    l2: DataFrame
    l1: DataFrame

    def counts(self) -> DataFrame:
        return catalogue_counts(self.l3, self.l2)


def resolve_encoder(spec: EmbeddingSpec, encoder=None) -> tuple[object, str | None]:
    """The encoder to run and the model name to record; an unknown name without encoder is an error.

    An encoder that has a ``name`` goes by it, any other by the configured name.
    """
    if not spec.enabled:
        return None, None
    if encoder is None:
        hashed = re.fullmatch(r"hashed-tokens-([0-9]+)", spec.model_name)
        if hashed is None:
            raise ValueError(f"no encoder is given for the model {spec.model_name!r}")
        encoder = HashedTokens(int(hashed[1]))
    return encoder, getattr(encoder, "name", spec.model_name)


def _with_embeddings(df: DataFrame, spec: EmbeddingSpec, level: str, encoder) -> DataFrame:
    if not spec.enabled or level not in spec.levels:
        return df
    text = df.withColumn("__text", F.col("description.string"))
    # Few domains share few texts; series descriptions are unique by construction.
    # They come out of an exchange, so they are spread already.
    add = embed_distinct if level == "l3" else partial(embed_text, partitions=0)
    encoded = add(text, "__text", "__vec", encoder, spec.l2_normalize, spec.batch_size)
    return encoded.withColumns({
        "description": F.struct(
            F.col("description.string").alias("string"), F.col("__vec").alias("embedding")
        ),
        "embedding_meta": F.struct(
            F.col("embedding_meta.embedding_model").alias("embedding_model"),
            F.coalesce(F.array_size("__vec"), F.lit(0)).alias("embedding_dim"),
            F.col("embedding_meta.schema_version").alias("schema_version"),
        ),
    }).select(*LEVEL_SCHEMAS[level].names)


def build_catalogue(
    facts: DataFrame,
    spec: BuildSpec | None = None,
    embeddings: EmbeddingSpec | None = None,
    encoder=None,
    order_col: str = ORDER,
    stage: bool = False,
    ordered: bool = False,
) -> Catalogue:
    """Build all levels from a long table.

    One scan of the facts feeds everything: they are deduplicated per (series, year),
    then bundled per series; domains, series and records are projections of the bundles.
    ``stage=True`` writes the bundles once to shared storage, for callers that consume
    more than one level. ``ordered=True`` sorts each level by first appearance.
    """
    spec = spec or BuildSpec()
    embeddings = embeddings or EmbeddingSpec()
    encoder, model = resolve_encoder(embeddings, encoder)
    prepared = prepare_facts(facts, spec, order_col)
    bundles = record_bundles(dedup_keep_last(prepared, spec.shuffle), code_sets(prepared))
    if stage:
        bundles = materialize(bundles, "bundles")
    cards = bundles.groupBy(*L3_DIMS).agg(F.min(FIRST).alias(FIRST))
    kept = with_keys(select_bundles(bundles, spec.filters))
    return Catalogue(
        l3=_with_embeddings(
            domain_level(cards, spec.dataset, model, ordered), embeddings, "l3", encoder
        ),
        l2=_with_embeddings(
            series_level(series_stats(kept), spec.dataset, model, ordered), embeddings, "l2", encoder
        ),
        l1=records_level(kept, ordered),
    )


LEVELS = ("l3", "l2", "l1")


def write_catalogue(catalogue: Catalogue, out: str, keyed: bool = True) -> dict[str, str]:
    """Write the levels as JSON lines below ``out`` and return their paths.

    ``keyed`` also writes the columnar form for lookups below ``out/keyed``.
    """
    paths = {level: write_jsonl_level(getattr(catalogue, level), f"{out}/{level}") for level in LEVELS}
    if keyed:
        write_keyed(catalogue, f"{out}/keyed")
    return paths


def write_keyed(catalogue: Catalogue, out: str) -> dict[str, str]:
    """Only the columnar form, below ``out``."""
    return {level: write_keyed_level(getattr(catalogue, level), f"{out}/{level}", level) for level in LEVELS}


def read_keyed(spark: SparkSession, out: str) -> Catalogue:
    return Catalogue(**{level: read_keyed_level(spark, f"{out}/{level}", level) for level in LEVELS})


def read_catalogue(spark: SparkSession, out: str) -> Catalogue:
    """The catalogue below ``out``: its columnar form if there is one, else the JSON lines."""
    keyed = f"{out}/keyed"
    try:
        spark.read.parquet(f"{keyed}/l1")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return Catalogue(**{level: read_jsonl_level(spark, f"{out}/{level}", level) for level in LEVELS})
    return read_keyed(spark, keyed)


def run(spark: SparkSession, config: CatalogueConfig, out: str, encoder=None, keyed: bool = True) -> dict:
    """Read the configured sources, build, write, and return paths and counts.

    Below ``out`` lie the levels, their columnar form (``keyed``) and ``manifest``: name, rows, file, sha256 and bytes of
    every part file. Counts come from the staged bundles; no level is read again.
    Intermediate tables are deleted at the end.
    """
    resolve_encoder(config.embeddings, encoder)
    with scratch_scope(spark):
        facts = read_sources(spark, config.sources)
        built = build_catalogue(
            facts, config.build, config.embeddings, encoder, stage=True
        )
        paths = write_catalogue(built, out, keyed)
        points = built.l1.agg(
            F.count("*").alias("series"), F.coalesce(F.sum(F.size("data")), F.lit(0)).cast("bigint").alias("records")
        ).first()
        counts = {"domains": built.l3.count(), **points.asDict()}
        rows = F.create_map(F.lit("l3"), F.lit(counts["domains"]), F.lit("l2"), F.lit(counts["series"]), F.lit("l1"), F.lit(counts["series"]))
        manifest = dataset_manifest(spark, paths).withColumn("rows_of_artefact", rows[F.col("artefact")])
        manifest.write.json(f"{out}/manifest")
    return {
        "run_id": config.run_id, "seed": config.seed, "paths": paths, "counts": counts,
        "manifest": f"{out}/manifest", "config": asdict(config),
    }
