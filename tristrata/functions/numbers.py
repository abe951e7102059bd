"""Lenient numeric parsing of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE

# Cell texts that mean "missing" in a delimited file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def _number(c: Column, numeric: bool) -> Column:
    if numeric:
        return c.cast("double")
    text = F.btrim(c, F.lit(WHITESPACE))
    parsed = text.try_cast("double")
    # The JVM also reads "1d", "2f" and hexadecimal floats; those are not numbers here.
    return F.when(parsed.isNotNull() & ~text.rlike(r"(?i)[0-9.][df]$|x"), parsed)


def parse_value(c: Column, numeric: bool = False) -> Column:
    """Text to double; unreadable text and NaN become null, infinities stay.

    Digit-group underscores (``1_000``) are not accepted.
    """
    number = _number(c, numeric)
    return F.when(~F.isnan(number), number)


def parse_year(c: Column, numeric: bool = False) -> Column:
    """Text to whole number, truncated toward zero; unreadable or non-finite is null."""
    number = _number(c, numeric)
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, number).try_cast("bigint")


def clean_code(c: Column) -> Column:
    """Classification codes: digits-only text is normalised as a whole number."""
    text = F.btrim(c.cast("string"), F.lit(WHITESPACE))
    return F.when(text.rlike("^[0-9]{1,18}$"), text.try_cast("bigint").cast("string")).otherwise(text)
