"""The watch list: which coins are fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default list, in request order (id, symbol, name).
DEFAULT_COINS = (
    ("bitcoin", "btc", "Bitcoin"),
    ("ethereum", "eth", "Ethereum"),
    ("tether", "usdt", "Tether"),
    ("usd-coin", "usdc", "USD Coin"),
    ("binancecoin", "bnb", "BNB"),
    ("solana", "sol", "Solana"),
    ("ripple", "xrp", "XRP"),
    ("dogecoin", "doge", "Dogecoin"),
    ("cardano", "ada", "Cardano"),
    ("shiba-inu", "shib", "Shiba Inu"),
)


def watchlist(df: DataFrame) -> DataFrame:
    """Entries of a watch list table that have an id."""
    return df.filter(F.col("id").isNotNull())


def default_watchlist(spark: SparkSession) -> DataFrame:
    rows = [(i, *coin) for i, coin in enumerate(DEFAULT_COINS)]
    return spark.createDataFrame(rows, "position int, id string, symbol string, name string")


def watchlist_json(spark: SparkSession, path: str) -> DataFrame:
    """Watch list from a JSON file ``{"coins": [{"id": ..., "symbol": ..., "name": ...}]}``.

    Entries that are no objects, or have no id key, are skipped; a file without
    ``coins`` gives an empty list.
    """
    doc = spark.read.text(path, wholetext=True)
    coins = F.try_variant_get(F.try_parse_json("value"), "$.coins", "array<variant>")
    entry = F.col("entry")

    def text(key: str):
        return F.try_variant_get(entry, f"$.{key}", "string").alias(key)

    return (
        doc.select(F.posexplode(coins).alias("position", "entry"))
        .filter(F.schema_of_variant("entry").startswith("OBJECT"))
        .filter(F.try_variant_get(entry, "$.id", "variant").isNotNull())
        .select("position", text("id"), text("symbol"), text("name"))
    )


def watchlist_yaml(spark: SparkSession, path: str) -> DataFrame:
    """The same from a YAML file at any Hadoop path, where a YAML reader is installed."""
    import yaml

    text = spark.read.text(path, wholetext=True).first()  # an empty file has no row
    coins = (yaml.safe_load(text[0]) or {}).get("coins", []) if text else []
    rows = [
        (i, str(c["id"]), c.get("symbol"), c.get("name"))
        for i, c in enumerate(coins)
        if isinstance(c, dict) and "id" in c
    ]
    return spark.createDataFrame(rows, "position int, id string, symbol string, name string")
