"""Column helpers over feed text held as VARIANT.

Feed keys differ only by case, and "absent", "null" and "not a number" mean different things. A
field is read as text (NULL for absent and for null) plus an ``absent`` flag. Rendering a VARIANT
back to JSON, and looking up a key that is not there, cost far more than reading one that is: types
are asked for only where the text leaves them open, keys only where the event type has them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = "~end~"
# Decimal text with optional exponent and digit-group underscores; no NaN, inf or type suffix.
_DIGITS = r"\d+(?:_\d+)*"
NUMBER_TEXT = (rf"^\s*([+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
               rf"(?:[eE][+-]?{_DIGITS})?)\s*$")


def boxed(text: Column) -> Column:
    """Parse ``text`` inside an array that closes with a marker.

    Spark's parser stops after the first value and so accepts trailing junk. Inside the array,
    junk breaks the syntax or moves the marker; ``intact`` tells.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def intact(box: str, text: str) -> Column:
    """The marker is where it belongs; text that holds the marker itself must not have moved it."""
    return F.expr(f"try_variant_get({box}, '$[1]', 'string') <=> '{_END}' "
                  f"AND (NOT contains({text}, '{_END}') "
                  f"OR variant_get({box}, '$[2]', 'variant') IS NULL)")


def may_hold(text: str, *keys: str) -> str:
    """SQL that is false only where ``text`` cannot have all ``keys``.

    Looking up a missing VARIANT path is slow, a substring test is not. Escaped keys pass.
    """
    plain = " AND ".join(f"""contains({text}, '"{key}"')""" for key in keys)
    return f"(({plain}) OR contains({text}, r'\\u'))"


def field(body: str, path: str) -> Column:
    return F.expr(f"variant_get({body}, '$.{path}', 'variant')")


def _path(path: str | None) -> str:
    return f"$.{path}" if path else "$"


def text_of(body: str, path: str | None) -> Column:
    """Scalar as text; NULL for absent and for JSON null. No path means the value itself."""
    return F.expr(f"try_variant_get({body}, '{_path(path)}', 'string')")


def long_of(body: str, path: str | None) -> Column:
    return F.expr(f"try_variant_get({body}, '{_path(path)}', 'bigint')")


def is_kind(value: Column, kind: str) -> Column:
    """STRING, BOOLEAN, OBJECT ...: the type of one VARIANT value."""
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def _plain(text: Column) -> Column:
    """Decimal text as DOUBLE; NULL for NaN, infinity, type suffixes and anything else."""
    return F.replace(F.regexp_extract(text, NUMBER_TEXT, 1), F.lit("_"), F.lit("")).try_cast("double")


def number(text: Column, value: Column) -> Column:
    """DOUBLE: 0.0 when absent, NULL when present but not convertible."""
    boolean = F.when(is_kind(value, "BOOLEAN"), F.when(text == "true", 1.0).otherwise(0.0))
    return (F.when(text.isNull(), F.when(value.isNull(), 0.0))
            .when(text.isin("true", "false"), boolean)
            .otherwise(_plain(text)))


def levels(pairs: str) -> Column:
    """``[[price, qty], ...]`` as ARRAY<STRUCT<price, qty>>, by the number rule of all other fields."""
    return F.transform(pairs, lambda pair: F.struct(
        _plain(F.get(pair, 0)).alias("price"), _plain(F.get(pair, 1)).alias("qty")))
