"""Shared-storage helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local runs may fall back to a temp folder.

    A cluster without the setting is an error: executors could not read a folder
    that exists on one machine only.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tristrata-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_SCOPES: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch root, or below the innermost ``scratch_scope``."""
    root = _SCOPES[-1] if _SCOPES else f"{scratch_root(spark)}/tristrata"
    return f"{root}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end: for jobs that write their results elsewhere."""
    _SCOPES.append(scratch_path(spark, "scope"))
    try:
        yield
    finally:
        remove(spark, _SCOPES.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and return a scan of it.

    Unlike a cache this survives lost executors, and several consumers share it
    without recomputing the shuffles behind it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_alone(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` of what ``make`` returns; the intermediate tables that it wrote are deleted at once."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)
