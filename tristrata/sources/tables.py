"""Long-format table sources: delimited files, literal metadata, union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SourceSpec
from ..functions.numbers import na_to_null
from ..schema import ORDER, SERIES_DIMS, SOURCE_TABLE, SOURCE_URL
from ..shared import materialize

# An order key is a whole number of these parts, from the lowest: row in its task, start
# of the split, rank of the file, index of the source. Together 126 bits, 38 digits.
ROW_BITS, BLOCK_BITS, FILE_BITS = 33, 43, 30
SOURCE_BITS = ROW_BITS + BLOCK_BITS + FILE_BITS
KEY = "decimal(38,0)"


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip white space around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def _part(c: Column, bits: int) -> Column:
    """``c`` as a part of an order key that starts at bit ``bits``."""
    return (c.cast(KEY) * F.lit(str(1 << bits)).cast(KEY)).cast(KEY)


def _file_ranks(spark: SparkSession, path: str) -> DataFrame:
    """Place of each file in path order: one small row per file, written so its size is known."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("__file"))
    ranked = files.distinct().withColumn("__rank", F.row_number().over(Window.orderBy("__file")))
    return materialize(ranked, "file-ranks")


def _distinct_names(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Header names as written; a later one that differs in case or white space only gets its position.

    Spark numbers such names itself, and all of them, so the first would be lost.
    """
    first = spark.read.option("escape", '"').csv(path).first()
    written = [x if x is not None else y for x, y in zip(first or [], names)]
    if len(written) != len(names):
        return names
    seen: set[str] = set()
    out = []
    for i, name in enumerate(written):
        folded = name.strip().lower()
        out.append(f"{name.strip()}_{i + 1}" if folded in seen else name)
        seen.add(folded)
    return out


def read_long_csv(
    spark: SparkSession, path: str, multi_line: bool = False, with_order: bool = True, ragged: str = "fail"
) -> DataFrame:
    """Delimited file(s) with a header; every column is text and NA tokens are null.

    ``__order__`` restores file order after any shuffle: rank of the file by path, start
    of the split, row number in the task. Rows of one split are numbered in their order,
    wherever the task began, and splits never compare by row number.

    A row with more cells than the header stops the read (``ragged="fail"``) or loses the
    surplus (``"cut"``); a short row is filled with nulls. All files of a path share
    their columns' order. Of names equal but for case and white space the first is kept.
    """
    if ragged not in ("fail", "cut"):
        raise ValueError(f"ragged must be 'fail' or 'cut', got {ragged!r}")
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    names = reader.csv(path).columns
    given = _distinct_names(spark, path, names)
    if given != names:
        # Names that Spark had to number do not equal the header any more.
        reader = reader.option("enforceSchema", True)
    if ragged == "fail":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "__bad"]])
        raw = reader.schema(schema).option("columnNameOfCorruptRecord", "__bad").csv(path)
        # A quoted cell counts as one letter; what is left between commas are the cells.
        cells = F.size(F.split(F.regexp_replace("__bad", '"(?:[^"]|"")*+"', "q"), ","))
        surplus = F.col("__bad").isNotNull() & (cells > len(names))
        message = F.concat(F.lit(f"more than {len(names)} cells in a row of {path}: "), F.col("__bad"))
        first = F.when(surplus, F.raise_error(message)).otherwise(na_to_null(F.col(f"`{names[0]}`")))
    else:
        raw = reader.csv(path)
        first = na_to_null(F.col(f"`{names[0]}`"))
    values = [first.alias(given[0]), *[na_to_null(F.col(f"`{c}`")).alias(g) for c, g in zip(names[1:], given[1:])]]
    if not with_order:
        return trim_headers(raw.select(*values))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = raw.select(
        *values,
        (row.cast(KEY) + _part(F.col("_metadata.file_block_start"), ROW_BITS)).cast(KEY).alias(ORDER),
        F.col("_metadata.file_path").alias("__file"),
    )
    key = (F.col(ORDER) + _part(F.col("__rank"), ROW_BITS + BLOCK_BITS)).cast(KEY)
    return trim_headers(placed.join(_file_ranks(spark, path), "__file").withColumn(ORDER, key).drop("__file", "__rank"))


def load_source(df: DataFrame, source: SourceSpec) -> DataFrame:
    """Attach the source's literal metadata and lineage; a same-named column is replaced."""
    df = trim_headers(df)
    literals = {
        k: F.lit(None if v is None else str(v)).cast("string") for k, v in source.meta.items()
    }
    literals[SOURCE_TABLE] = F.lit(int(source.table))
    literals[SOURCE_URL] = F.lit(source.url)
    return df.withColumns(literals)


def union_sources(
    frames: Sequence[DataFrame], spark: SparkSession | None = None
) -> DataFrame:
    """Concatenate by name, absent columns filled with null.

    When every frame has ``__order__`` the position of its source becomes the leading
    part of the key, so "last" and "first" follow source order, then file order.
    """
    if not frames:
        if spark is None:
            raise ValueError("an empty union needs the session")
        return spark.createDataFrame([], ", ".join(f"{d} string" for d in SERIES_DIMS))
    ordered = all(ORDER in f.columns for f in frames)
    out = None
    for i, frame in enumerate(frames):
        if ordered:
            frame = frame.withColumn(ORDER, (F.col(ORDER).cast(KEY) + F.lit(str(i << SOURCE_BITS)).cast(KEY)).cast(KEY))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def read_sources(spark: SparkSession, sources: Sequence[SourceSpec], multi_line: bool = False) -> DataFrame:
    """Read every source from its path (``url``), attach metadata and concatenate."""
    return union_sources(
        [load_source(read_long_csv(spark, s.url, multi_line), s) for s in sources], spark
    )
