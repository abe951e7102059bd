"""Column resolution: from a raw long table to canonical facts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BuildSpec
from ..functions.numbers import clean_code, parse_value, parse_year
from ..functions.text import clean_str
from ..schema import CODE_DIMS, L2_DIMS, L3_DIMS, ORDER


def _positions(df: DataFrame) -> dict[str, int]:
    """Place of the first column of each name, white space and case aside."""
    places: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        places.setdefault(c.strip().lower(), i)
    return places


def resolve_column(df: DataFrame, name: str, optional: bool = False) -> str | None:
    """The table's own spelling of a column name; of several the first."""
    place = _positions(df).get(name.strip().lower())
    if place is None and not optional:
        raise KeyError(f"no column is called {name!r}; the table has {', '.join(map(repr, df.columns))}")
    return None if place is None else df.columns[place]


def drop_columns_matching(df: DataFrame, regex: str | None) -> DataFrame:
    """Drop columns whose name matches from its start, case-sensitively."""
    if not regex:
        return df
    pattern = re.compile(regex)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not pattern.match(c)])


def require_domain_columns(df: DataFrame) -> DataFrame:
    """The table with its three domain columns under their canonical names."""
    found = {name: name if name in df.columns else resolve_column(df, name, optional=True) for name in L3_DIMS}
    absent = [name for name, c in found.items() if c is None]
    if absent:
        raise KeyError(f"domain columns {absent} are neither in the table nor in the source's metadata")
    return df.withColumnsRenamed({c: name for name, c in found.items() if c != name})


def _is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def prepare_facts(df: DataFrame, spec: BuildSpec | None = None, order_col: str = ORDER) -> DataFrame:
    """Canonical facts: cleaned dimensions, parsed Year and Value, order key, optional codes.

    Dimensions are cleaned before any grouping, so texts that differ only in outer white
    space form one series. Only the selected columns reach the scan.
    """
    spec = spec or BuildSpec()
    mandatory = {
        "Area": spec.area_col, "Item": spec.item_col, "Element": spec.element_col,
        "Unit": spec.unit_col, "Year": spec.year_col, "Value": spec.value_col,
    }
    resolved = {k: resolve_column(df, v) for k, v in mandatory.items()}
    order = resolve_column(df, order_col)
    kept = drop_columns_matching(df, spec.drop_columns_regex)
    for column in resolved.values():
        if column not in kept.columns:
            raise KeyError(f"drop_columns_regex removes the mandatory column '{column}'")
    codes = {
        name: resolve_column(kept, name.replace("_", " "), optional=True)
        or resolve_column(kept, name, optional=True)
        for name in (CODE_DIMS if spec.include_codes else [])
    }
    kept = require_domain_columns(kept if order in kept.columns else df)

    def col(name: str) -> Column:
        return F.col(f"`{name}`")

    return kept.select(
        *[clean_str(col(d)).alias(d) for d in L3_DIMS],
        *[clean_str(col(resolved[d])).alias(d) for d in L2_DIMS],
        parse_year(col(resolved["Year"]), _is_numeric(kept, resolved["Year"])).alias("Year"),
        parse_value(col(resolved["Value"]), _is_numeric(kept, resolved["Value"])).alias("Value"),
        (col(order) if isinstance(kept.schema[order].dataType, T.DecimalType) else col(order).cast("bigint")).alias(ORDER),
        *[clean_code(col(c)).alias(name) for name, c in codes.items() if c],
    )
