"""Strict checks of level files and of the links between levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..schema import KEY_PREFIX, KIND, LEVEL_SCHEMAS, PROPERTIES

LEVELS = ("l3", "l2", "l1")
NULLABLE_INTS = ["year_min", "year_max"]
PLAIN_INTS = ["n_members", "zeros", "nulls"]
FLOATS = PROPERTIES[5:]


def plain_json(line: Column) -> Column:
    """The line with the number tokens NaN and Infinity outside texts as null.

    Only lines that hold such a word are taken apart, into texts and what is between.
    """
    parts = F.regexp_extract_all(line, F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]+|"'), F.lit(0))
    told = F.transform(
        parts, lambda p: F.when(p.startswith('"'), p).otherwise(F.regexp_replace(p, r"(?<![\w.])-?(?:NaN|Infinity)(?!\w)", "null"))
    )
    return F.when(line.rlike("NaN|Infinity"), F.array_join(told, "")).otherwise(line)


def _get(node: Column, name: str) -> Column:
    return F.try_element_at(node, F.lit(name))


def _object(node: Column) -> Column:
    """JSON object as a map of its fields; null for anything else."""
    return F.try_variant_get(node, "$", "map<string,variant>")


def _type(node: Column) -> Column:
    """'' when the field is absent, else the JSON type name."""
    return F.coalesce(F.schema_of_variant(node), F.lit(""))


def _absent(node: Column) -> Column:
    return _type(node) == ""


def _null(node: Column) -> Column:
    return _type(node) == "VOID"


def _is_text(node: Column) -> Column:
    return _type(node) == "STRING"


def _text(node: Column) -> Column:
    return F.when(_is_text(node), F.try_variant_get(node, "$", "string"))


def _as_number(node: Column) -> Column:
    """Number of a numeric, boolean or numeric-text field; null otherwise."""
    text = F.btrim(_text(node), F.lit(WHITESPACE))
    from_text = F.when(~text.rlike(r"(?i)[0-9.][df]$|x"), text.try_cast("double"))
    from_bool = F.try_variant_get(node, "$", "boolean").cast("int").cast("double")
    return (
        F.when(_is_text(node), from_text)
        .when(_type(node) == "BOOLEAN", from_bool)
        .when(_type(node).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(node, "$", "double"))
    )


def _is_whole(node: Column) -> Column:
    n = _as_number(node)
    return F.coalesce((n == F.floor(n)) & (F.abs(n) != float("inf")), F.lit(False))


def _unknown(obj: Column, allowed: list[str]) -> Column:
    return F.coalesce(F.size(F.array_except(F.map_keys(obj), F.array(*map(F.lit, allowed)))) > 0, F.lit(False))


def _bad_key(node: Column) -> Column:
    key = F.coalesce(F.btrim(_text(node), F.lit(WHITESPACE)), F.lit(""))
    return ~key.startswith(KEY_PREFIX)


def _bad_embedding(node: Column) -> Column:
    items = F.try_variant_get(node, "$", "array<variant>")
    numeric = F.coalesce(F.forall(items, lambda x: _as_number(x).isNotNull()), F.lit(False))
    return ~(_absent(node) | _null(node) | numeric)


def _bad_optional_text(node: Column) -> Column:
    return ~(_absent(node) | _null(node) | _is_text(node))


def _bad_properties(props: Column) -> Column:
    """True unless every entry is a known property with a readable number."""
    def bad(e: Column) -> Column:
        name, node = e["key"], e["value"]
        return (
            F.when(name.isin(NULLABLE_INTS), ~(_null(node) | _is_whole(node)))
            .when(name.isin(PLAIN_INTS), ~_is_whole(node))
            .when(name.isin(FLOATS), ~(_null(node) | _as_number(node).isNotNull()))
            .otherwise(F.lit(True))
        )

    return props.isNull() | F.exists(F.map_entries(props), bad)


def _year_ok(node: Column) -> Column:
    n = _as_number(node)
    return F.coalesce(~F.isnan(n) & (F.abs(n) != float("inf")), F.lit(False))


def _value_ok(node: Column) -> Column:
    blank = F.btrim(_text(node), F.lit(WHITESPACE)) == ""
    return (
        _absent(node) | _null(node) | _as_number(node).isNotNull() | F.coalesce(blank, F.lit(False))
    )


def validate_level(lines: DataFrame, level: str) -> DataFrame:
    """Check (line, value) rows of one level against its strict document schema.

    Adds the level's links (keys, counts, embedding size) and ``errors``, an array of
    codes that is empty for a valid line. Checks: readable JSON object, no unknown
    field at any depth, literal kind, prefixed keys, required parts, readable numbers,
    and a named model wherever an embedding size is given. ``kind``,
    ``schema_version``, every property and ``data`` may be absent.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, got {level!r}")
    parsed = lines.select(
        "line", _object(F.try_parse_json(plain_json(F.col("value")))).alias("doc")
    )
    parts = {n: _get(F.col("doc"), n) for n in LEVEL_SCHEMAS[level].names}
    objects = [n for n in ("identity", "description", "properties", "embedding_meta") if n in parts]
    nodes = parsed.select(
        "line", "doc",
        *[(_object(parts[n]) if n in objects else parts[n]).alias(n) for n in parts],
        *([F.try_variant_get(parts["data"], "$", "array<variant>").alias("items")] if level == "l1" else []),
    )
    identity = F.col("identity")
    keys = ["domain_key"] if level == "l3" else ["domain_key", "series_key"]
    kind, version = F.col("kind"), F.col("schema_version")
    tests: dict[str, Column] = {
        "unknown_field": _unknown(F.col("doc"), LEVEL_SCHEMAS[level].names),
        "kind": ~(_absent(kind) | F.coalesce(_text(kind) == KIND[level], F.lit(False))),
        "schema_version": ~(_absent(version) | _is_text(version)),
        "identity": identity.isNull() | _unknown(identity, keys),
        **{k: _bad_key(_get(identity, k)) for k in keys},
    }
    if level != "l1":
        description, meta = F.col("description"), F.col("embedding_meta")
        vec = _get(description, "embedding")
        dim, model = _get(meta, "embedding_dim"), _get(meta, "embedding_model")
        version = _get(meta, "schema_version")
        tests |= {
            "dims": _absent(F.col("dims")),
            "description": description.isNull()
            | _unknown(description, ["string", "embedding"])
            | ~_is_text(_get(description, "string")),
            "embedding": _bad_embedding(vec),
            "embedding_meta": meta.isNull()
            | _unknown(meta, ["embedding_model", "embedding_dim", "schema_version"])
            | _bad_optional_text(model)
            | ~(_absent(dim) | _is_whole(dim))
            | ~(_absent(version) | _is_text(version)),
            "embedding_model": F.coalesce(_as_number(dim) > 0, F.lit(False))
            & (F.coalesce(_text(model), F.lit("")) == ""),
        }
    if level == "l2":
        tests["properties"] = _bad_properties(F.col("properties"))
    if level == "l1":
        item = F.coalesce(F.col("items"), F.array().cast("array<variant>"))
        tests |= {
            "data": ~_absent(F.col("data")) & F.col("items").isNull(),
            "data_item": F.exists(item, lambda x: F.coalesce(_unknown(_object(x), ["Year", "Value"]), F.lit(True)) | _object(x).isNull()),
            "year": F.exists(item, lambda x: _object(x).isNotNull() & ~_year_ok(_get(_object(x), "Year"))),
            "value": F.exists(item, lambda x: ~_value_ok(_get(_object(x), "Value"))),
        }
    codes = F.array_sort(F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(True)), F.lit(code)) for code, bad in tests.items()
    ])))
    links = {k: F.btrim(_text(_get(identity, k)), F.lit(WHITESPACE)) for k in keys}
    if level == "l2":
        links["n_members"] = F.coalesce(
            _as_number(_get(F.col("properties"), "n_members")).cast("bigint"), F.lit(0).cast("bigint")
        )
    if level == "l1":
        links["n_points"] = F.coalesce(F.array_size("items"), F.lit(0)).cast("bigint")
    if level != "l1":
        size = F.size(F.try_variant_get(_get(F.col("description"), "embedding"), "$", "array<variant>"))
        links["embedding_dim"] = F.when(size > 0, size.cast("bigint"))
    return nodes.select(
        "line",
        *[c.alias(n) for n, c in links.items()],
        F.when(F.col("doc").isNull(), F.array(F.lit("unparseable"))).otherwise(codes).alias("errors"),
    )


def _valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0)


def validation_errors(checked: dict[str, DataFrame], max_errors: int | None = None) -> DataFrame:
    """(level, line, error) of faulty lines; the first ``max_errors`` lines per level.

    ``None`` reports every faulty line.
    """
    out = None
    for level, df in checked.items():
        part = df.filter(F.size("errors") > 0).select(
            F.lit(level).alias("level"), "line", F.array_join("errors", ",").alias("error")
        )
        if max_errors is not None:
            part = part.orderBy("line").limit(int(max_errors))
        out = part if out is None else out.unionByName(part)
    return out


def error_limit(errors: DataFrame, max_errors: int = 20) -> DataFrame:
    """First ``max_errors`` rows per level by line.

    Every task keeps its own first rows per level before the shuffle, so a level that
    holds most errors does not end in one task.
    """
    rank = F.row_number().over(Window.partitionBy("level").orderBy("line"))
    return errors.withColumn("__r", rank).filter(F.col("__r") <= int(max_errors)).drop("__r")


def key_summary(l2: DataFrame, l1: DataFrame) -> DataFrame:
    """One row per series key: presence on both sides and the counts to compare.

    Both levels are stacked and grouped once, which answers every key question with a
    single shuffle. Of repeated keys the last line wins.
    """
    sides = l2.select("series_key", F.lit(True).alias("in2"), "line", F.col("n_members").alias("n")).unionByName(
        l1.select("series_key", F.lit(False).alias("in2"), "line", F.col("n_points").alias("n"))
    )
    return sides.groupBy("series_key").agg(
        F.max("in2").alias("in_l2"),
        F.max(~F.col("in2")).alias("in_l1"),
        F.max_by("n", F.when(F.col("in2"), F.col("line"))).alias("n_members"),
        F.max_by("n", F.when(~F.col("in2"), F.col("line"))).alias("n_points"),
    )


def domain_summary(l3: DataFrame, l2: DataFrame) -> DataFrame:
    """One row per domain key with its presence in domains and in series."""
    sides = l3.select("domain_key", F.lit(True).alias("in3")).unionByName(
        l2.select("domain_key", F.lit(False).alias("in3"))
    )
    return sides.groupBy("domain_key").agg(
        F.max("in3").alias("in_l3"), F.max(~F.col("in3")).alias("in_l2")
    )


def series_missing_in_records(l2: DataFrame, l1: DataFrame) -> DataFrame:
    return l2.select("series_key").distinct().join(l1, "series_key", "left_anti")


def records_missing_in_series(l2: DataFrame, l1: DataFrame) -> DataFrame:
    return l1.select("series_key").distinct().join(l2, "series_key", "left_anti")


def uncovered_domains(l3: DataFrame, l2: DataFrame) -> DataFrame:
    """Domain keys used by series without a domain card.

    The series side is reduced to distinct keys before the join, so a domain with most
    of the series costs one row per task.
    """
    return l2.select("domain_key").distinct().join(l3, "domain_key", "left_anti")


def n_members_mismatch(l2: DataFrame, l1: DataFrame) -> DataFrame:
    """Common keys whose stated and actual number of points differ."""
    return key_summary(l2, l1).filter(
        F.col("in_l2") & F.col("in_l1") & (F.col("n_members") != F.col("n_points"))
    ).select("series_key", "n_members", "n_points")


def key_set_report(l2: DataFrame, l1: DataFrame) -> DataFrame:
    """One row: sizes of both key sets, of their intersection and differences, equality."""
    keys = key_summary(l2, l1)
    return keys.agg(
        F.count_if("in_l2").alias("n_l2"),
        F.count_if("in_l1").alias("n_l1"),
        F.count_if(F.col("in_l2") & F.col("in_l1")).alias("n_common"),
        F.count_if(F.col("in_l2") & ~F.col("in_l1")).alias("only_l2"),
        F.count_if(~F.col("in_l2") & F.col("in_l1")).alias("only_l1"),
        (F.count_if(F.col("in_l2") != F.col("in_l1")) == 0).alias("equal"),
    )


def embedding_dim_check(checked: DataFrame) -> DataFrame:
    """One row: reported size (of the first line that has one) and consistency."""
    return checked.agg(
        F.coalesce(
            F.min_by("embedding_dim", F.when(F.col("embedding_dim").isNotNull(), F.col("line"))),
            F.lit(0).cast("bigint"),
        ).alias("embedding_dim"),
        F.coalesce(F.min("embedding_dim") == F.max("embedding_dim"), F.lit(True)).alias("consistent"),
    )


def validation_summary(checked: dict[str, DataFrame]) -> DataFrame:
    """One row of counts and flags over the three checked levels.

    Every check reduces to a few named numbers; these small rows are stacked and folded
    into one, so no join between the checks is needed.
    """
    l3, l2, l1 = (_valid(checked[x]) for x in LEVELS)

    def named(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("v")) for c in columns
        ])))

    keys = key_summary(l2, l1).agg(
        F.count_if("in_l2").alias("n_series_l2"),
        F.count_if("in_l1").alias("n_series_l1"),
        F.count_if(F.col("in_l2") & ~F.col("in_l1")).alias("missing_series_in_l1"),
        F.count_if(~F.col("in_l2") & F.col("in_l1")).alias("missing_series_in_l2"),
        F.count_if(F.col("in_l2") & F.col("in_l1") & (F.col("n_members") != F.col("n_points"))).alias(
            "n_members_mismatch"
        ),
    )
    domains = domain_summary(l3, l2).agg(
        F.count_if("in_l3").alias("n_domains_l3"),
        F.count_if(F.col("in_l2") & ~F.col("in_l3")).alias("missing_domain_in_l3"),
    )
    rows = named(keys, keys.columns).unionByName(named(domains, domains.columns))
    for level, df in (("l3", l3), ("l2", l2)):
        dims = embedding_dim_check(df).withColumnsRenamed(
            {"embedding_dim": f"embedding_dim_{level}", "consistent": f"consistent_{level}"}
        )
        rows = rows.unionByName(named(dims, dims.columns))
    for level in LEVELS:
        faulty = checked[level].agg(F.count_if(F.size("errors") > 0).alias(f"errors_{level}"))
        rows = rows.unionByName(named(faulty, faulty.columns))
    names = [
        "n_domains_l3", "n_series_l2", "n_series_l1", "embedding_dim_l3", "embedding_dim_l2",
        "n_members_mismatch", "missing_series_in_l1", "missing_series_in_l2",
        "missing_domain_in_l3", "errors_l3", "errors_l2", "errors_l1",
        "consistent_l3", "consistent_l2",
    ]
    flat = rows.agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in names])
    zero = [
        "n_members_mismatch", "missing_series_in_l1", "missing_series_in_l2",
        "missing_domain_in_l3", "errors_l3", "errors_l2", "errors_l1",
    ]
    clean = sum((F.col(n) for n in zero), F.lit(0)) == 0
    return flat.select(
        (clean & (F.col("consistent_l3") == 1) & (F.col("consistent_l2") == 1)).alias("ok"),
        *names[:5],
        ((F.col("missing_series_in_l1") == 0) & (F.col("missing_series_in_l2") == 0)).alias("series_keys_match"),
        (F.col("missing_domain_in_l3") == 0).alias("domain_keys_covered"),
        *names[5:12],
    )
