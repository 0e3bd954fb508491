"""Shapes of the five payload kinds, their storage layout and their staged views.

The tables below are fixed values: field names, order, type and whether a field
may be absent or null follow the public market data API and its contracts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- contract terms


@dataclass(frozen=True)
class Scalar:
    kind: str  # str | float | int | datetime


@dataclass(frozen=True)
class ListOf:
    item: Scalar
    item_nullable: bool = False
    keep_empty: bool = True  # False: typed records drop '' and null items


@dataclass(frozen=True)
class MapOf:
    value: Scalar
    value_nullable: bool = False


@dataclass(frozen=True)
class Rows:
    """A list of numeric rows, every row of the same width."""

    width: int


@dataclass(frozen=True)
class Record:
    fields: tuple[Field, ...]


@dataclass(frozen=True)
class RecordList:
    record: Record


@dataclass(frozen=True)
class Field:
    name: str
    spec: object
    required: bool = False
    nullable: bool = True


STR, FLOAT, INT, DATETIME = Scalar("str"), Scalar("float"), Scalar("int"), Scalar("datetime")


def _required(name: str, spec: object) -> Field:
    return Field(name, spec, required=True, nullable=False)


# ------------------------------------------------------- fixed values: contracts

SNAPSHOT = RecordList(
    Record(
        (
            _required("id", STR),
            _required("symbol", STR),
            _required("name", STR),
            _required("last_updated", DATETIME),
            Field("current_price", FLOAT),
            Field("market_cap", FLOAT),
            Field("market_cap_rank", INT),
            Field("total_volume", FLOAT),
            Field("high_24h", FLOAT),
            Field("low_24h", FLOAT),
            Field("price_change_24h", FLOAT),
            Field("price_change_percentage_24h", FLOAT),
            Field("circulating_supply", FLOAT),
            Field("total_supply", FLOAT),
            Field("max_supply", FLOAT),
            Field("ath", FLOAT),
            Field("ath_change_percentage", FLOAT),
            Field("ath_date", DATETIME),
            Field("atl", FLOAT),
            Field("atl_change_percentage", FLOAT),
            Field("atl_date", DATETIME),
            Field("price_change_percentage_1h_in_currency", FLOAT),
            Field("price_change_percentage_7d_in_currency", FLOAT),
        )
    )
)

CHART = Record(
    (
        _required("prices", Rows(2)),
        _required("market_caps", Rows(2)),
        _required("total_volumes", Rows(2)),
    )
)

METADATA = Record(
    (
        _required("id", STR),
        _required("symbol", STR),
        _required("name", STR),
        Field("categories", ListOf(STR, item_nullable=True), nullable=False),
        Field("description", Record((Field("en", STR),))),
        Field(
            "links",
            Record(
                (
                    Field("homepage", ListOf(STR, keep_empty=False)),
                    Field("blockchain_site", ListOf(STR, keep_empty=False)),
                )
            ),
        ),
        Field("genesis_date", STR),
        Field("market_cap_rank", INT),
        Field("platforms", MapOf(STR, value_nullable=True), nullable=False),
    )
)

GLOBAL = Record(
    (
        _required(
            "data",
            Record(
                (
                    Field("active_cryptocurrencies", INT),
                    Field("markets", INT),
                    Field("total_market_cap", MapOf(FLOAT), nullable=False),
                    Field("total_volume", MapOf(FLOAT), nullable=False),
                    Field("market_cap_percentage", MapOf(FLOAT), nullable=False),
                    Field("market_cap_change_percentage_24h_usd", FLOAT),
                    Field("updated_at", INT),
                )
            ),
        ),
    )
)

OHLC = Rows(5)

CONTRACTS = {
    "coins_markets": SNAPSHOT,
    "coins_metadata": METADATA,
    "market_chart": CHART,
    "global": GLOBAL,
    "ohlc": OHLC,
}

# ---------------------------------------------- fixed values: keys in the object store

# Object key prefix of each payload kind; {id} is the coin.
KEY_PREFIX = {
    "coins_markets": "coins/markets",
    "coins_metadata": "coins_metadata/{id}",
    "market_chart": "coins/{id}/market_chart",
    "global": "global",
    "ohlc": "coins/{id}/ohlc",
}

# Series of a market chart payload and the value column each one is staged under.
CHART_SERIES = {
    "prices": "price_usd",
    "market_caps": "market_cap_usd",
    "total_volumes": "volume_usd",
}

# Metadata columns as scanned: JSON keeps the raw text of a value with dynamic keys.
METADATA_COLUMNS = (
    ("id", "string"),
    ("symbol", "string"),
    ("name", "string"),
    ("web_slug", "string"),
    ("asset_platform_id", "string"),
    ("platforms", "json"),
    ("detail_platforms", "json"),
    ("block_time_in_minutes", "bigint"),
    ("hashing_algorithm", "string"),
    ("categories", "json"),
    ("description", "json"),
    ("links", "json"),
    ("image", "json"),
    ("country_origin", "string"),
    ("genesis_date", "string"),
    ("contract_address", "string"),
    ("public_notice", "string"),
    ("market_cap_rank", "bigint"),
    ("market_cap_rank_with_rehypothecated", "bigint"),
    ("preview_listing", "boolean"),
    ("has_supply_breakdown", "boolean"),
    ("watchlist_portfolio_users", "bigint"),
    ("sentiment_votes_up_percentage", "double"),
    ("sentiment_votes_down_percentage", "double"),
    ("status_updates", "json"),
    ("additional_notices", "json"),
    ("last_updated", "string"),
)

# ------------------------------------------------------------------ scan schemas

_SQL_TYPE = {"str": "string", "float": "double", "int": "bigint", "datetime": "timestamp"}

SNAPSHOT_COLUMNS = tuple((f.name, _SQL_TYPE[f.spec.kind]) for f in SNAPSHOT.record.fields)

GLOBAL_COLUMNS = (
    ("active_cryptocurrencies", "bigint"),
    ("markets", "bigint"),
    ("total_market_cap", "map<string,double>"),
    ("total_volume", "map<string,double>"),
    ("market_cap_percentage", "map<string,double>"),
    ("market_cap_change_percentage_24h_usd", "double"),
    ("updated_at", "bigint"),
)


def as_text(columns: tuple[tuple[str, str], ...]) -> T.StructType:
    """The same columns with every leaf read as text.

    Spark's JSON reader turns ``1.0`` read as BIGINT, or ``"60000"`` read as
    DOUBLE, into NULL without a word.  Both are valid payload values, so scans
    read text and cast explicitly.
    """
    leaf = {"map<string,double>": T.MapType(T.StringType(), T.StringType())}
    return T.StructType([T.StructField(n, leaf.get(t, T.StringType())) for n, t in columns])


SNAPSHOT_TEXT = as_text(SNAPSHOT_COLUMNS)
METADATA_TEXT = as_text(METADATA_COLUMNS)
GLOBAL_TEXT = T.StructType([T.StructField("data", as_text(GLOBAL_COLUMNS))])

# The landing table.  kind and date are directories: their number follows the
# calendar, never the data.  One fetch of one coin is (kind, coin_id,
# fetched_at); a very long response may be stored in several bounded parts.  batch
# names the landing run that wrote the row.
LANDING = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("part", T.LongType()),
        T.StructField("landed_at", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("batch", T.StringType()),
    ]
)
LANDING_KEY = ("kind", "coin_id", "fetched_at")
LANDING_DIRS = ("kind", "date", "batch")
# Beside the landing table: runs that are complete, keys a run has landed again, and runs rewritten by another.
RUNS = "batch string, landed_at bigint, rows bigint, first_date date, last_date date"
REPLACED = "kind string, coin_id string, fetched_at timestamp_ntz, date date, batch string"
SUPERSEDED = "batch string, first_date date, last_date date, by string"
ALL_COINS = "_all"  # coin_id of the kinds that are not per coin

# ----------------------------------------------------- fixed values: data tests

STAGING_TESTS = {
    "stg_coins_markets": {
        "not_null": ["coin_id", "fetched_at", "current_price"],
        "unique_combination": [["coin_id", "fetched_at"]],
    },
    "stg_global": {"not_null": ["fetched_at", "total_market_cap_usd"]},
    "stg_coin_metadata": {"not_null": ["coin_id"]},
    "stg_market_chart": {"not_null": ["coin_id", "ts_ms"]},
    "my_first_dbt_model": {"unique": ["id"], "not_null": ["id"]},
    "my_second_dbt_model": {"unique": ["id"], "not_null": ["id"]},
}
