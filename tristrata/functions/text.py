"""String, map and JSON expressions: cleaning, canonical JSON, keys, descriptions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import KEY_PREFIX, L2_DIMS, L3_DIMS, SERIES_DIMS, dim_label
from .arrays import let

# The characters Unicode treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_str(c: Column) -> Column:
    """Null becomes ""; Unicode white space is stripped from both ends.

    Trimming by a character set walks the text character by character. Texts that begin
    and end with a visible ASCII byte, nearly all of them, are recognised by comparing
    bytes and skip it.
    """
    text = F.coalesce(c.cast("string"), F.lit(""))
    last = F.substring(text.cast("binary"), -1, 1)
    plain = (text >= "!") & (text < "\x7f") & last.between(F.lit(b"!"), F.lit(b"~"))
    return F.when(plain | (text == ""), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def canonical_dims(dims: Column, order: list[str], keep_extras: bool = True) -> Column:
    """Map with every name of ``order`` (missing ones as ""), then cleaned extras.

    Extras with an empty name are dropped, a canonical name wins over an extra of
    the same cleaned name, and the first of several equal extras wins.
    """
    dims = F.coalesce(dims, F.create_map().cast("map<string,string>"))
    canon = F.array(*[
        F.struct(F.lit(k).alias("key"), clean_str(F.try_element_at(dims, F.lit(k))).alias("value"))
        for k in order
    ])
    if not keep_extras:
        return F.map_from_entries(canon)
    cleaned = F.transform(
        F.map_entries(dims),
        lambda e: F.struct(clean_str(e["key"]).alias("key"), clean_str(e["value"]).alias("value")),
    )
    extras = F.filter(cleaned, lambda e: (e["key"] != "") & ~e["key"].isin(order))
    return let(
        extras,
        lambda x: let(
            F.transform(x, lambda e: e["key"]),
            lambda names: F.map_from_entries(
                F.concat(canon, F.filter(x, lambda e, i: F.array_position(names, e["key"]) == i + 1))
            ),
        ),
    )


def _lower_escapes(json: Column) -> Column:
    """Rewrite ``\\u001F``-style escapes to lower-case hex, leaving other text alone."""
    out = json
    for letter in "ABCDEF":
        out = F.regexp_replace(
            out, r"(?<!\\)((?:\\\\)*\\u00[01])" + letter, "$1" + letter.lower()
        )
    return F.when(json.contains("\\u00"), out).otherwise(json)


def canonical_json(fields: Mapping[str, Column | Mapping]) -> Column:
    """Compact JSON text with sorted names and unescaped non-ASCII text."""

    def build(spec: Mapping) -> Column:
        return F.struct(*[
            (build(spec[k]) if isinstance(spec[k], Mapping) else spec[k]).alias(k)
            for k in sorted(spec)
        ])

    return _lower_escapes(F.to_json(build(fields)))


def _sha256_key(json: Column) -> Column:
    return F.concat(F.lit(KEY_PREFIX), F.sha2(json, 256))


def _columns(names: list[str], source: Mapping[str, Column] | None) -> dict[str, Column]:
    """Columns of the given names; ones taken from ``source`` are cleaned first.

    Without a source the frame's own columns are used, which canonical facts already hold
    in cleaned form.
    """
    return {n: clean_str(source[n]) if source else F.col(n) for n in names}


def domain_json(source: Mapping[str, Column] | None = None) -> Column:
    return canonical_json({"dims_l3": _columns(L3_DIMS, source)})


def series_json(source: Mapping[str, Column] | None = None) -> Column:
    return canonical_json({
        "dims_l3": _columns(L3_DIMS, source),
        "dims_l2": _columns(L2_DIMS, source),
    })


def domain_key(source: Mapping[str, Column] | None = None) -> Column:
    """``sha256:<hex>`` over the canonical JSON of the three domain dimensions."""
    return _sha256_key(domain_json(source))


def series_key(source: Mapping[str, Column] | None = None) -> Column:
    """``sha256:<hex>`` over the canonical JSON of all seven dimensions."""
    return _sha256_key(series_json(source))


def _labelled(names: list[str], source: Mapping[str, Column] | None) -> list[Column]:
    cols = _columns(names, source)
    return [
        F.when(cols[n] != "", F.concat(F.lit(f"{dim_label(n)}: "), cols[n])) for n in names
    ]


def domain_description(dataset: str, source: Mapping[str, Column] | None = None) -> Column:
    """``"<dataset> domain | Domain: … | …"``; empty dimensions are skipped."""
    return F.concat_ws(" | ", F.lit(f"{dataset} domain"), *_labelled(L3_DIMS, source))


def series_description(
    dataset: str,
    source: Mapping[str, Column] | None = None,
    extras: Column | None = None,
) -> Column:
    """As the domain text plus the four series dimensions and optional sorted extras."""
    parts = [F.lit(f"{dataset} series"), *_labelled(SERIES_DIMS, source)]
    if extras is not None:
        entries = F.filter(
            F.array_sort(F.map_entries(extras)),
            lambda e: ~e["key"].isin(SERIES_DIMS) & (clean_str(e["value"]) != ""),
        )
        parts.append(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), clean_str(e["value"]))))
    return F.concat_ws(" | ", *parts)


def plot_header(dataset: str, l3: Column, l2: Column) -> Column:
    """Header that keeps empty slots, from the two dimension maps."""
    slots = [(n, F.coalesce(F.try_element_at(l3, F.lit(n)), F.lit(""))) for n in L3_DIMS]
    slots += [(n, F.coalesce(F.try_element_at(l2, F.lit(n)), F.lit(""))) for n in L2_DIMS]
    parts = [F.concat(F.lit(f"{dim_label(n)}: "), c) for n, c in slots]
    return F.concat_ws(" | ", F.lit(f"{dataset} series"), *parts)


def plot_title(dataset: str, l3: Column, l2: Column, limit: int = 240) -> Column:
    """Title that skips empty slots and is cut to ``limit`` characters plus an ellipsis."""
    source = {n: F.try_element_at(l3, F.lit(n)) for n in L3_DIMS}
    source |= {n: F.try_element_at(l2, F.lit(n)) for n in L2_DIMS}
    text = series_description(dataset, source)
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("…"))
    ).otherwise(text)


def extra_dims(dims: Column) -> Column:
    """Entries outside the four core dimensions with a value, sorted by name."""
    kept = F.map_filter(
        dims, lambda k, v: ~k.isin(L2_DIMS) & v.isNotNull() & (v != "")
    )
    return F.array_sort(F.map_entries(kept))


def json_text(json: Column, path: str, default: str | None = None) -> Column:
    """Text at a JSON path; a missing parent yields null (or ``default``)."""
    found = F.get_json_object(json, path)
    return found if default is None else F.coalesce(found, F.lit(default))
