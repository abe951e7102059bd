"""Fact view derived from the given tables, and level frames built from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.config import BuildSpec, EmbeddingSpec
from tristrata.plans.build import Catalogue, build_catalogue, read_keyed, write_keyed
from tristrata.shared import scratch_path

SEQ_BASE = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals per nation, segment, status and priority, without literal columns."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    key = F.col("o_orderkey")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("Area"),
            F.col("c_mktsegment").alias("Item"),
            F.col("o_orderstatus").alias("Element"),
            F.col("o_orderpriority").alias("Unit"),
            F.col("n_nationkey").cast("string").alias("Area_code"),
            F.year("o_orderdate").alias("Year"),
            F.when(key % 17 == 0, None)
            .when(key % 13 == 0, 0.0)
            .otherwise(F.col("o_totalprice"))
            .alias("Value"),
            key.alias("seq"),
        )
    )


def web_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values per user group and type; the unit of errors is null."""
    key = F.col("event_id")
    error = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string")).alias("Area"),
        F.col("event_type").alias("Item"),
        F.lit("value").alias("Element"),
        F.when(~error, "USD").alias("Unit"),
        F.lit(None).cast("string").alias("Area_code"),
        F.dayofmonth("ts").alias("Year"),
        F.when(key % 19 == 0, None)
        .when(error, 7.5)
        .when(key % 11 == 0, 0.0)
        .otherwise(F.col("value"))
        .alias("Value"),
        key.alias("seq"),
    )


SALES_META = {"Domain": "Sales", "Sub_domain": "Orders", "Domain_table": "Order totals"}
WEB_META = {"Domain": "Web", "Sub_domain": "Events", "Domain_table": "Event values"}


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def source(df: DataFrame, meta: dict[str, str], index: int) -> DataFrame:
        return df.withColumns({k: F.lit(v) for k, v in meta.items()}).withColumns({
            "src": F.lit(index), "ord": F.lit(index) * F.lit(SEQ_BASE) + F.col("seq"),
        })

    return source(sales_facts(spark, sf_dir), SALES_META, 1).unionByName(
        source(web_facts(spark, sf_dir), WEB_META, 2)
    )


# The fact view keeps its code column, so the default drop pattern loses "Code" here.
WITH_CODES = dict(include_codes=True, drop_columns_regex=r".*(Source|Flag|Note|Unnamed).*")


def catalogue(
    spark: SparkSession,
    sf_dir: str,
    spec: BuildSpec | None = None,
    embeddings: EmbeddingSpec | None = None,
    stage: bool = False,
) -> Catalogue:
    return build_catalogue(
        facts(spark, sf_dir), spec or BuildSpec(), embeddings, order_col="ord", stage=stage
    )


_STORED: dict[tuple, str] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Named tables in shared storage, built once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    for _ in range(2):
        if key not in _STORED:
            root = scratch_path(spark, name)
            for part, df in build().items():
                df.write.parquet(f"{root}/{part}")
            _STORED[key] = root
        root = _STORED[key]
        try:
            # The parts of a set are its sub-folders; a vanished folder is built anew.
            return {part: spark.read.parquet(f"{root}/{part}") for part in ("l3", "l2", "l1")}
        except AnalysisException:
            del _STORED[key]
    raise RuntimeError(f"cannot read back {name}")


def stored_catalogue(spark: SparkSession, sf_dir: str, embedded: bool = False) -> Catalogue:
    """The catalogue in the keyed form that the library writes.

    Navigation, profiling and checks run on a written catalogue, as in production.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "embedded" if embedded else "catalogue")
    for _ in range(2):
        if key not in _STORED:
            root = scratch_path(spark, key[-1])
            built = catalogue(spark, sf_dir, BuildSpec(**WITH_CODES), EmbeddingSpec(enabled=embedded), stage=True)
            write_keyed(built, root)
            _STORED[key] = root
        try:
            found = read_keyed(spark, _STORED[key])
            spark.read.parquet(f"{_STORED[key]}/l1")  # a vanished folder is built anew
            return found
        except AnalysisException:
            del _STORED[key]
    raise RuntimeError("cannot read the catalogue back")
