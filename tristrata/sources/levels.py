"""Level files: JSON lines, delimited tables and checksum manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..schema import LEVEL_SCHEMAS, ORDER
from ..shared import materialize

#: Most bytes of a part file of a level (a line that is longer has a file to itself).
FILE_BYTES = 512 << 20
#: A line of so many mean lengths is written apart, so that it does not shrink all files.
LONG_LINE = 4
#: Children of a node of a file's digest tree, and levels above the lines.
FAN_OUT = 4096
LEVELS_ABOVE = 3
#: Names of the part files of an artefact.
PART_FILES = "part-*"
#: Files of more bytes than this have a digest tree, but no checksum of their content in one piece.
WHOLE_BYTES = 1 << 30


def write_jsonl_level(df: DataFrame, path: str, mode: str = "errorifexists", file_bytes: int = FILE_BYTES) -> str:
    """One nested JSON object per line, null fields kept.

    Files are cut by measured bytes: one pass measures the lines, and the longest of the
    ordinary ones says how many rows keep a file below ``file_bytes``. Lines of LONG_LINE
    mean lengths or more are dealt to files of their own rule.
    """
    options = {"ignoreNullFields": "false"}
    size = F.octet_length(F.to_json(F.struct("*"), options)) + 1
    total = df.select(size.alias("size")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max("size").alias("longest")).first()
    if not total["rows"]:
        df.write.mode(mode).json(path)
        return path
    edge = LONG_LINE * total["bytes"] / total["rows"]
    parts = [(df, total["longest"], mode)]
    if total["longest"] > edge and total["bytes"] > file_bytes:
        sized = df.withColumn("__size", size)
        parts = [(sized.where(F.col("__size") <= edge).drop("__size"), edge, mode), (sized.where(F.col("__size") > edge).drop("__size"), total["longest"], "append")]
    for part, longest, how in parts:
        rows = max(1, int(file_bytes // longest))
        part.write.mode(how).options(**options, maxRecordsPerFile=rows).json(path)
    return path


def read_jsonl_level(spark: SparkSession, path: str, level: str) -> DataFrame:
    """Typed scan of a level; blank lines are skipped, only used fields are parsed.

    A point whose Value is the token NaN has no value.
    """
    rows = spark.read.schema(LEVEL_SCHEMAS[level]).json(path)
    if level != "l1":
        return rows
    value = lambda p: F.when(~F.isnan(p["Value"]), p["Value"])
    return rows.withColumn("data", F.transform("data", lambda p: p.withField("Value", value(p))))


#: Row groups of the keyed form: small enough that a lookup reads little.
ROW_GROUP_BYTES = 8 << 20


def level_key(level: str) -> str:
    """The field that a level's documents are looked up by."""
    return "identity.domain_key" if level == "l3" else "identity.series_key"


def write_keyed_level(df: DataFrame, path: str, level: str, mode: str = "errorifexists", row_group_bytes: int = ROW_GROUP_BYTES) -> str:
    """Columnar form for lookups: Parquet in key order with a Bloom filter on the key.

    Ranges of keys are dealt to files and sorted within them, so the bounds of a row group
    tell whether it can hold a key, and the filter whether it does. Keys are hashes: ranges
    are even whatever the data.
    """
    key = level_key(level)
    (
        df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
        .write.mode(mode)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )
    return path


def read_keyed_level(spark: SparkSession, path: str, level: str) -> DataFrame:
    """Scan of the keyed form; a filter on the key reaches its row groups."""
    return spark.read.schema(LEVEL_SCHEMAS[level]).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def _numbered(raw: DataFrame, per_file: bool) -> DataFrame:
    """``raw`` (file, block, …) with ``line``: 1-based over all files in path order, or within each file.

    Numbering takes one counting pass: rows are numbered inside their split, and the
    splits' starts are running totals over one small row per split.
    """
    numbered = raw.withColumn(ORDER, F.monotonically_increasing_id())
    splits = numbered.groupBy("file", "block").agg(F.count("*").alias("n"), F.min(ORDER).alias("first"))
    over = "partition by file order by block" if per_file else "order by file, block"
    running = splits.selectExpr(
        "file", "block", "first", f"coalesce(sum(n) over ({over} rows between unbounded preceding and 1 preceding), 0) as before"
    )
    # One row per split; written, so that the planner sees how small it is.
    return numbered.join(materialize(running, "splits"), ["file", "block"]).withColumn(
        "line", F.col("before") + F.col(ORDER) - F.col("first") + 1
    ).drop("before", "first", ORDER)


def _text_lines(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    return spark.read.option("pathGlobFilter", names).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with their 1-based number over all files in path order."""
    raw = _text_lines(spark, path).withColumn("value", F.btrim(F.col("value"), F.lit(WHITESPACE))).filter("value <> ''")
    return _numbered(raw, per_file=False).select("line", "value")


def content_digest(df: DataFrame, columns: list[str | Column] | None = None) -> DataFrame:
    """Row count and order-free digest: equal content in any file layout, equal digest.

    A row is hashed by the first 60 bits of the md5 of its text: its JSON, or the one text
    column or several joined by the unit separator that ``columns`` names.
    """
    text = F.to_json(F.struct("*")) if columns is None else F.concat_ws("\x1f", *[F.col(c) if isinstance(c, str) else c for c in columns])
    row_hash = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return df.select(row_hash.alias("h")).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0).cast("bigint")).alias("digest_xor"),
        F.coalesce(F.sum(F.pmod("h", F.lit(1 << 31))), F.lit(0).cast("bigint")).alias("digest_sum"),
    )


def line_trees(spark: SparkSession, path: str, by_file: bool = True) -> DataFrame:
    """(path, lines, tree_sha256): a digest of each text file's lines in order, as a tree.

    With ``by_file`` off, one tree over the lines of all part files in path order: equal for
    equal lines, however they are dealt to files.

    Leaves are SHA-256 of the lines; a node is SHA-256 of the hexadecimal digests of up to
    FAN_OUT children run together, LEVELS_ABOVE times. Nodes are small whatever the file's
    size, so no file has to fit a row. A file without lines has no row.
    """
    if by_file:
        rows = _numbered(_text_lines(spark, path), per_file=True)
    else:
        rows = _numbered(_text_lines(spark, path, PART_FILES), per_file=False).withColumn("file", F.lit(path))
    nodes = rows.select("file", (F.col("line") - 1).alias("at"), F.sha2("value", 256).alias("digest"), F.lit(1).cast("bigint").alias("lines"))
    for _ in range(LEVELS_ABOVE):
        children = F.array_sort(F.collect_list(F.struct("at", "digest")))
        nodes = nodes.groupBy("file", F.floor(F.col("at") / FAN_OUT).alias("at")).agg(
            F.sha2(F.array_join(F.transform(children, lambda c: c.digest), ""), 256).alias("digest"), F.sum("lines").alias("lines")
        )
    return nodes.select(F.col("file").alias("path"), "lines", F.col("digest").alias("tree_sha256"))


def dataset_manifest(spark: SparkSession, paths: dict[str, str], by_file: bool = True) -> DataFrame:
    """artefact, path, sha256, bytes, mtime_utc, lines and tree_sha256 of every part file of text artefacts.

    With ``by_file`` off one row per artefact that has part files: its folder, all bytes, the
    latest time and the tree over all lines in path order, without a ``sha256``.

    ``tree_sha256`` (see :func:`line_trees`) has no limit of size; ``sha256``, the checksum
    of the bytes in one piece, is null for files over WHOLE_BYTES, whose content is not read
    for it.
    """
    out = None
    for name, path in sorted(paths.items()):
        listed = spark.read.format("binaryFile").option("pathGlobFilter", PART_FILES).load(path)
        if by_file:
            sums = listed.where(F.col("length") <= WHOLE_BYTES).select("path", F.sha2("content", 256).alias("sha256"))
        else:
            listed = listed.groupBy(F.lit(path).alias("path")).agg(F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime"))
            sums = listed.select("path", F.lit(None).cast("string").alias("sha256"))
        files = (
            listed.select(
                "path",
                F.col("length").alias("bytes"),
                F.date_format(F.to_utc_timestamp("modificationTime", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("mtime_utc"),
            )
            .join(sums, "path", "left")
            .join(line_trees(spark, path, by_file), "path", "left")
            .select(
                F.lit(name).alias("artefact"), "path", "sha256", "bytes", "mtime_utc",
                F.coalesce("lines", F.lit(0).cast("bigint")).alias("lines"), "tree_sha256",
            )
        )
        out = files if out is None else out.unionByName(files)
    if out is None:
        raise ValueError("no artefacts given")
    return out
