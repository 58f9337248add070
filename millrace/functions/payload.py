"""Typed access to JSON payloads. Missing fields and bad values give NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parsed(text: Column) -> Column:
    return F.try_parse_json(text)


def canonical(variant: Column) -> Column:
    """JSON text with sorted keys: equal for equal documents."""
    return F.to_json(variant)


def text(source: Column, name: str) -> Column:
    """Scalars as plain text, objects and arrays as JSON text."""
    return F.try_variant_get(source, f"$.{name}", "string")


def given(source: Column, name: str) -> Column:
    """Whether a field holds anything: neither missing, nor null, nor a blank text."""
    return F.nullif(F.trim(text(source, name)), F.lit("")).isNotNull()


def number(source: Column, name: str, type_: str = "decimal(15,4)") -> Column:
    return F.try_variant_get(source, f"$.{name}", type_)


def integer(source: Column, name: str) -> Column:
    """Whole number; a fraction rounds half to even, an out-of-range value gives NULL."""
    return F.bround(F.try_variant_get(source, f"$.{name}", "double")).try_cast("int")


def boolean(source: Column, name: str) -> Column:
    return F.try_variant_get(source, f"$.{name}", "boolean")


def day(source: Column, name: str) -> Column:
    """Date, or the date part of a timestamp text."""
    return F.nullif(text(source, name), F.lit("")).try_cast("date")


def instant(source: Column, name: str) -> Column:
    return F.try_variant_get(source, f"$.{name}", "timestamp")


def elements(source: Column, name: str) -> Column:
    """Array field as an array of variants; NULL if missing or not an array."""
    return F.try_variant_get(source, f"$.{name}", "array<variant>")


def strings(source: Column, name: str) -> Column:
    return F.try_variant_get(source, f"$.{name}", "array<string>")


def is_object(source: Column, name: str) -> Column:
    part = F.try_variant_get(source, f"$.{name}", "variant")
    return F.coalesce(F.schema_of_variant(part).startswith("OBJECT"), F.lit(False))


def as_object(source: Column, name: str) -> Column:
    """JSON text of an object field; any other value is wrapped as {"value": ...}."""
    part = F.to_json(F.try_variant_get(source, f"$.{name}", "variant"))
    wrapped = F.concat(F.lit('{"value":'), F.coalesce(part, F.lit("null")), F.lit("}"))
    return F.when(is_object(source, name), part).otherwise(wrapped)


def override(document: Column, name: str, type_: str) -> Column:
    """Struct<value> if the document holds `name` (or the generic `value`), else NULL.

    An explicit JSON null gives a struct with a NULL value: "changed to nothing".
    """
    named = F.try_variant_get(document, f"$.{name}", "variant")
    generic = F.try_variant_get(document, "$.value", "variant")
    found = F.coalesce(named, generic)
    value = F.coalesce(
        F.try_variant_get(document, f"$.{name}", type_),
        F.when(named.isNull(), F.try_variant_get(document, "$.value", type_)),
    )
    return F.when(found.isNotNull(), F.struct(value.alias("value")))
