"""Reading JSON through VARIANT and writing JSON text with ``", "`` and ``": "``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talkloom.functions.text import blank_if_null, null_if_blank

_SHORT_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}
_ESCAPES = {**{chr(c): f"\\u{c:04x}" for c in range(0x20)}, **_SHORT_ESCAPES}


# ---- reading ---------------------------------------------------------------


def parse_json(value: Column | str, fallback: str | None = None) -> Column:
    """JSON text to VARIANT: malformed is NULL, blank is ``fallback``."""
    text = null_if_blank(blank_if_null(value))
    if fallback is not None:
        text = F.coalesce(text, F.lit(fallback))
    return F.try_parse_json(text)


def json_list(variant: Column, path: str = "$") -> Column:
    """The list at ``path`` as array<variant>; NULL when it is not a list."""
    return F.try_variant_get(variant, path, "array<variant>")


def is_object(variant: Column) -> Column:
    return F.schema_of_variant(variant).startswith("OBJECT<")


def json_field(variant: Column, path: str) -> Column:
    """Scalar at ``path`` as text; missing and JSON null are blank, booleans read True/False."""
    raw = F.try_variant_get(variant, path, "string")
    boolean = F.schema_of_variant(F.try_variant_get(variant, path, "variant")) == "BOOLEAN"
    return (
        F.when(raw.isNull(), F.lit(""))
        .when(raw.isin("true", "false") & boolean, F.initcap(raw))
        .otherwise(raw)
    )


def json_field_or_blank(variant: Column, path: str) -> Column:
    """As ``json_field``, with 0, false, [] and {} counting as missing.

    Only values that print like one of those pay for a type test.
    """
    raw = F.try_variant_get(variant, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
    return (
        F.when(raw.isNull(), F.lit(""))
        .when(~raw.isin("0", "0.0", "-0.0", "-0", "true", "false", "[]", "{}"), raw)
        .when(kind == "STRING", raw)
        .when(raw == "true", F.lit("True"))
        .otherwise(F.lit(""))
    )


# ---- writing ---------------------------------------------------------------


def json_string(value: Column | str) -> Column:
    """A quoted JSON string.

    Plain text passes as it is, the usual escapes are plain replacements, and only a
    text with rarer control characters is taken apart.
    """
    text = blank_if_null(value)
    usual = text
    for char in ("\\", '"', "\n", "\r", "\t"):
        usual = F.replace(usual, F.lit(char), F.lit(_ESCAPES[char]))
    table = F.create_map(*[F.lit(x) for pair in _ESCAPES.items() for x in pair])
    every = F.array_join(
        F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), ""
    )
    body = (
        F.when(~text.rlike(r'[\x00-\x1f"\\]'), text)
        .when(~text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), usual)
        .otherwise(every)
    )
    return F.concat(F.lit('"'), body, F.lit('"'))


def json_object(fields: list[tuple[str, Column]]) -> Column:
    """An object from (name, JSON text) pairs; pairs whose value is NULL are left out."""
    members = [F.concat(F.lit(_quoted(name) + ": "), value) for name, value in fields]
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def json_array(values: Column) -> Column:
    """A JSON list from an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]"))


def json_string_list(values: Column) -> Column:
    return json_array(F.transform(values, json_string))


def spaced_json(variant: Column) -> Column:
    """JSON text of a VARIANT: sorted keys, a space after each separator.

    Each match starts where the last one ended, so a separator inside a string is
    never taken for one outside.
    """
    text = F.to_json(variant)
    spaced = F.regexp_replace(text, r'\G((?:"(?:[^"\\]++|\\.)*+"|[^":,]++)*+)([:,])', "$1$2 ")
    return F.when(text.rlike("[:,]"), spaced).otherwise(text)


def filled_json(variant: Column, path: str) -> Column:
    """JSON text at ``path``, NULL when it is missing, null, "", [] or {}."""
    value = F.try_variant_get(variant, path, "variant")
    text = spaced_json(value)
    return F.when(~text.isin("null", '""', "[]", "{}"), text)


def _quoted(name: str) -> str:
    return '"' + "".join(_ESCAPES.get(c, c) for c in name) + '"'
