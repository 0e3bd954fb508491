"""Scalar functions of the staging layer, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_bigint(c: Column) -> Column:
    """Number to BIGINT, rounding half to even (a bare cast would truncate)."""
    return F.rint(c).cast("bigint")


def text_to_bigint(c: Column, lenient: bool = False) -> Column:
    """Text of a JSON number to BIGINT: exact for integers, half-even for decimals."""
    whole = c.try_cast("bigint")
    number = c.try_cast("double") if lenient else c.cast("double")
    return F.coalesce(whole, to_bigint(number))


def text_to(c: Column, sql_type: str, lenient: bool = False) -> Column:
    """Text of a JSON scalar to a declared type."""
    if sql_type in ("string", "json"):
        return c
    if sql_type == "bigint":
        return text_to_bigint(c, lenient)
    if sql_type == "map<string,double>":
        return F.transform_values(c, lambda _, v: text_to(v, "double", lenient))
    return c.try_cast(sql_type) if lenient else c.cast(sql_type)


def item(c: Column, position: int) -> Column:
    """1-based list subscript; NULL when out of range."""
    return F.get(c, position - 1)


def json_text(c: Column, key: str) -> Column:
    """Value under a key as text: NULL when missing or null, JSON text for an object."""
    return F.get_json_object(c, f"$.{key}")


def json_first(c: Column, key: str) -> Column:
    """First item of the list under a key: NULL for an empty list, '' stays ''."""
    return F.get_json_object(c, f"$.{key}[0]")


def map_value(c: Column, key: str) -> Column:
    """Value of a map entry; NULL when the key is absent."""
    return F.try_element_at(c, F.lit(key))


def drop_empty(c: Column) -> Column:
    """List without null or empty items; a null list becomes an empty one."""
    present = F.filter(c, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(present, F.array().cast("array<string>"))


def trim_slashes(c: Column) -> Column:
    return F.btrim(c, F.lit("/"))


def utc(c: Column) -> Column:
    """Any time to naive UTC: a naive one is UTC already, an aware one is converted.

    Right under a UTC session time zone, which ``session.configure`` sets.
    """
    return c.cast("timestamp_ntz")


def epoch_ms(c: Column) -> Column:
    """UTC time to whole epoch milliseconds (floor)."""
    return F.unix_millis(c.cast("timestamp"))


def hour_start(c: Column) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def upper_ticker(c: Column) -> Column:
    return F.upper(c)
