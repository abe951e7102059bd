"""Level schemas, dimension names and other fixed values of the catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

# Version tag, kinds and canonical dimension order of the documents.
SCHEMA_VERSION = "v_0_1_0"
KIND = {"l3": "domain", "l2": "series", "l1": "records"}
L3_DIMS = ["Domain", "Sub_domain", "Domain_table"]
L2_DIMS = ["Area", "Item", "Element", "Unit"]
SERIES_DIMS = L3_DIMS + L2_DIMS
CODE_DIMS = ["Area_code", "Item_code", "Element_code", "Unit_code"]
KEY_PREFIX = "sha256:"

# Display labels of dimensions inside descriptions.
DIM_LABELS = {"Sub_domain": "Sub-domain", "Domain_table": "Domain-table"}

PROPERTIES = [
    "year_min", "year_max", "n_members", "zeros", "nulls",
    "min", "max", "mean", "median", "variance", "entropy",
]

# Lineage and order columns carried by source tables.
SOURCE_TABLE = "__source_table__"
SOURCE_URL = "__source_url__"
ORDER = "__order__"


def dim_label(name: str) -> str:
    return DIM_LABELS.get(name, name)


DESCRIPTION = T.StructType([
    T.StructField("string", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

EMBEDDING_META = T.StructType([
    T.StructField("embedding_model", T.StringType()),
    T.StructField("embedding_dim", T.IntegerType()),
    T.StructField("schema_version", T.StringType()),
])

DIMS = T.MapType(T.StringType(), T.StringType())

SERIES_IDENTITY = T.StructType([
    T.StructField("domain_key", T.StringType()),
    T.StructField("series_key", T.StringType()),
])

SERIES_PROPERTIES = T.StructType(
    [T.StructField(n, T.LongType()) for n in PROPERTIES[:5]]
    + [T.StructField(n, T.DoubleType()) for n in PROPERTIES[5:]]
)

POINT = T.StructType([
    T.StructField("Year", T.LongType()),
    T.StructField("Value", T.DoubleType()),
])

LEVEL_SCHEMAS = {
    "l3": T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("identity", T.StructType([T.StructField("domain_key", T.StringType())])),
        T.StructField("dims", DIMS),
        T.StructField("description", DESCRIPTION),
        T.StructField("embedding_meta", EMBEDDING_META),
    ]),
    "l2": T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("identity", SERIES_IDENTITY),
        T.StructField("dims", DIMS),
        T.StructField("description", DESCRIPTION),
        T.StructField("properties", SERIES_PROPERTIES),
        T.StructField("embedding_meta", EMBEDDING_META),
    ]),
    "l1": T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("identity", SERIES_IDENTITY),
        T.StructField("data", T.ArrayType(POINT)),
    ]),
}

MILESTONE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("utc", T.StringType()),
    T.StructField("t_seconds", T.DoubleType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
])
