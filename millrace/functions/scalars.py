"""Small column expressions shared by the plans. All of them stay inside Spark's code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(15,4)"
RATIO = "decimal(8,4)"
QTY_LIMIT = 1_000_000
LBS_PER_KG = "2.20462"


def blank(column: Column) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(column, F.lit("")) == ""


def first_filled(*columns: Column) -> Column:
    """First value that is neither NULL nor empty; the last column is taken as it is."""
    head = [F.nullif(c, F.lit("")) for c in columns[:-1]]
    return F.coalesce(*head, columns[-1])


def after_last(column: Column, separator: str) -> Column:
    """The part after the last separator; the whole string if there is none."""
    return F.substring_index(column, separator, -1)


def month_floor(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_from_text(text: Column) -> Column:
    """First of the month for 'YYYY-MM'; NULL for NULL or malformed text."""
    return F.try_to_date(text, "yyyy-M")


def date_prefix(text: Column) -> Column:
    """Date in the first ten characters of a timestamp text."""
    return F.substring(text, 1, 10).try_cast("date")


def lbs_to_kg(weight: Column) -> Column:
    return weight / F.lit(LBS_PER_KG).cast("decimal(6,5)")


def within_limit(quantity: Column, limit: int = QTY_LIMIT) -> Column:
    """NULL where the quantity exceeds the plausibility limit."""
    return F.when(quantity <= limit, quantity)


def ratio(numerator: Column, denominator: Column, type_: str = RATIO) -> Column:
    """numerator / denominator at scale 4, NULL for a zero denominator."""
    wide = "decimal(24,4)"
    return (numerator.cast(wide) / F.nullif(denominator.cast(wide), F.lit(0).cast(wide))).cast(type_)


def surrogate_key(natural: Column, *rest: Column) -> Column:
    """Stable surrogate key: a digest of the natural key, the same in every rebuild."""
    return F.md5(F.concat_ws("|", natural, *[c.cast("string") for c in rest]))


# A row of a shuffle states place and length of each of its texts, and these compress badly. Texts that only pass through are
# put into one for the way. Any text (of valid UTF-8) comes back as it was, separators in it and NULL included.
_SEPARATOR, _ESCAPE = "\u0001", "\u0002"
_ESCAPED = [(_ESCAPE, f"{_ESCAPE}e"), (_SEPARATOR, f"{_ESCAPE}s")]
_NULL = f"{_ESCAPE}n"


def packed(names: Sequence[str]) -> Column:
    """The texts of the columns as one."""

    def escaped(column: Column) -> Column:
        for plain, sign in _ESCAPED:
            column = F.replace(column, F.lit(plain), F.lit(sign))
        return F.coalesce(column, F.lit(_NULL))

    return F.concat_ws(_SEPARATOR, *[escaped(F.col(name)) for name in names])


def unpacked(column: Column, names: Sequence[str]) -> dict[str, Column]:
    """The texts that `packed` put together, by name."""

    parts = F.split(column, _SEPARATOR)

    def part(i: int) -> Column:
        text = whole = parts[i]
        for plain, sign in reversed(_ESCAPED):
            text = F.replace(text, F.lit(sign), F.lit(plain))
        return F.when(whole != F.lit(_NULL), text)

    return {name: part(i) for i, name in enumerate(names)}


def in_calendar(day: Column, low: Column, high: Column) -> Column:
    """The date itself inside the calendar, NULL outside."""
    return F.when(day.between(low, high), day)
