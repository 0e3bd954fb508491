"""Object keys: building them, and reading coin, date and fetch time back from a path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwell.functions.scalars import trim_slashes, utc
from tickwell.schemas import KEY_PREFIX

# How time is written in a key, and how a key is read back.
FETCHED_FORMAT = "yyyy-MM-dd'T'HH-mm-ss'Z'"
FETCHED_PATTERN = r"fetched_at=([^/]+)\.json"
DATE_PATTERN = r"date=([^/]+)/"
CHART_COIN_PATTERN = r"raw/coins/([^/]+)/market_chart/"


def raw_key(prefix: Column, fetched_at: Column) -> Column:
    """raw/<prefix>/date=YYYY-MM-DD/fetched_at=YYYY-MM-DDTHH-MM-SSZ.json"""
    at = utc(fetched_at)
    return F.concat(
        F.lit("raw/"),
        trim_slashes(prefix),
        F.lit("/date="),
        F.date_format(at, "yyyy-MM-dd"),
        F.lit("/fetched_at="),
        F.date_format(at, FETCHED_FORMAT),
        F.lit(".json"),
    )


def key_prefix(kind: Column, coin_id: Column) -> Column:
    """Object key prefix of a payload from its kind and coin."""
    prefix = F.lit(None).cast("string")
    for name, template in KEY_PREFIX.items():
        before, hole, after = template.partition("{id}")
        built = F.concat(F.lit(before), coin_id, F.lit(after)) if hole else F.lit(before)
        prefix = F.when(kind == name, built).otherwise(prefix)
    return prefix


def fetched_at_of(path: Column, lenient: bool = False) -> Column:
    """Fetch time from a path, naive UTC.  A path without one is an error unless lenient."""
    text = F.regexp_extract(path, FETCHED_PATTERN, 1)
    if lenient:
        return F.try_to_timestamp(text, F.lit(FETCHED_FORMAT)).cast("timestamp_ntz")
    return F.to_timestamp_ntz(text, F.lit(FETCHED_FORMAT))


def date_of(path: Column, lenient: bool = False) -> Column:
    text = F.regexp_extract(path, DATE_PATTERN, 1)
    return text.try_cast("date") if lenient else text.cast("date")


def chart_coin_of(path: Column) -> Column:
    return F.regexp_extract(path, CHART_COIN_PATTERN, 1)


def kind_of(path: Column) -> Column:
    """Payload kind from an object path; NULL when the path fits none."""
    kind = F.lit(None).cast("string")
    for name, template in KEY_PREFIX.items():
        pattern = "raw/" + template.replace("{id}", "[^/]+") + "/date="
        kind = F.when(path.rlike(pattern), F.lit(name)).otherwise(kind)
    return kind


def coin_of(path: Column) -> Column:
    """Coin folder of a per-coin object path; '' for the other kinds."""
    coin = F.lit("")
    for template in KEY_PREFIX.values():
        if "{id}" in template:
            pattern = "raw/" + template.replace("{id}", "([^/]+)") + "/date="
            found = F.regexp_extract(path, pattern, 1)
            coin = F.when(found != "", found).otherwise(coin)
    return coin
