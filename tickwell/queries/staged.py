"""Queries over the staged views: land, scan, flatten."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.functions import keys
from tickwell.functions.scalars import item, json_first, json_text, trim_slashes, upper_ticker, utc
from tickwell.operators.landing import land_raw
from tickwell.operators.staging import stg_chart_points, stg_global, stg_metadata, stg_snapshots
from tickwell.plans.layers import register_views
from tickwell.queries import payloads as P
from tickwell.queries.registry import query, table
from tickwell.sources.scans import scan_charts, scan_global, scan_metadata, scan_snapshots


CHART_SQL = """
    select cast(user_id as varchar) as coin_id, '2024-02-01 00:00:00' as fetched_at,
           '2024-02-01' as snapshot_date, epoch_us(ts) // 1000 as ts_ms, value as price_usd
    from events
"""


@query(CHART_SQL)
def chart_points(spark, sf_dir):
    """Charts of all coins landed, scanned and flattened to points."""
    root = P.new_root(spark, "chart")
    land_raw(P.charts(spark, sf_dir), root)
    return stg_chart_points(scan_charts(spark, root, "landed"))


@query("""
    select cast(user_id as varchar) as coin_id, '2024-02-01 00:00:00' as fetched_at,
           '2024-02-01' as snapshot_date, epoch_us(ts) // 1000 as ts_ms,
           cast(event_id as double) as volume_usd
    from events
""")
def chart_volumes(spark, sf_dir):
    """Another series of the same payloads."""
    return stg_chart_points(P.unlanded(P.charts(spark, sf_dir)), "total_volumes")


SNAPSHOT_SQL = """
    select cast(o_orderkey as varchar) as coin_id, o_orderstatus as symbol,
           o_orderpriority as name, o_totalprice as current_price,
           o_totalprice * 4 as market_cap, o_custkey as market_cap_rank,
           o_totalprice as total_volume, cast(null as double) as high_24h,
           cast(null as double) as low_24h, cast(null as double) as price_change_24h,
           cast(null as double) as price_change_percentage_24h,
           cast(null as double) as circulating_supply, cast(null as double) as total_supply,
           cast(null as double) as max_supply,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as api_last_updated,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as snapshot_date,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d 00:00:00') as fetched_at
    from orders
"""


@query(SNAPSHOT_SQL)
def snapshot_stage(spark, sf_dir):
    """Snapshot lists landed, scanned and typed; unknown keys are not read."""
    root = P.new_root(spark, "snapshot")
    land_raw(P.snapshots(spark, sf_dir, loose=True), root)
    return stg_snapshots(scan_snapshots(spark, root, "landed"))


@query(SNAPSHOT_SQL)
def snapshot_objects(spark, sf_dir):
    """The same view over the object layout: JSON under date=/fetched_at=...json keys.

    What Spark writes under an object's key is a folder, one document per file.
    """
    root = P.new_root(spark, "objects")
    at = F.col("fetched_at")
    documents = P.snapshots(spark, sf_dir, filled=True).select(
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        F.concat(F.date_format(at, keys.FETCHED_FORMAT), F.lit(".json")).alias("fetched_at"),
        F.col("payload").alias("value"),
    )
    (
        P.objects_writer(documents.hint("rebalance", "date", "fetched_at"))
        .partitionBy("date", "fetched_at")
        .option("maxRecordsPerFile", 1)
        .text(f"{root}/raw/coins/markets")
    )
    return stg_snapshots(scan_snapshots(spark, root, "objects"))


METADATA_SQL = """
    select cast(doc_id as varchar) as coin_id, source as symbol, lang as name,
           '["' || lang || '","' || source || '"]' as categories,
           case when lang = 'de' then '{"' || source || '":null,"":""}'
                else '{"' || source || '":"' || lang || '","":""}' end as platforms,
           case when lang = 'en' then text end as description_en,
           case when lang = 'fr' then ''
                else 'https://' || source || '.example/' || doc_id end as homepage_url,
           case when lang = 'en' then 'https://' || source || '.example/' || doc_id end
               as block_explorer_url,
           '2009-01-03' as genesis_date, n_chars as market_cap_rank,
           '2024-01-31T10:00:00.000Z' as api_last_updated, '2024-02-01' as snapshot_date,
           '2024-02-01 00:00:00' as fetched_at
    from documents
"""


@query(METADATA_SQL)
def metadata_stage(spark, sf_dir):
    """Metadata documents landed, scanned with nested JSON as text, and flattened."""
    root = P.new_root(spark, "metadata")
    land_raw(P.metadata(spark, sf_dir), root)
    return stg_metadata(scan_metadata(spark, root, "landed"))


GLOBAL_SQL = """
    select count(*) as active_cryptocurrencies,
           cast(sum(cast(value as decimal(18,2))) filter (where event_type = 'purchase') as double)
               as total_market_cap_purchase,
           count(distinct event_type) as markets,
           cast(nullif(count(*) filter (where event_type = 'purchase'), 0) as double)
               as total_volume_purchase,
           round(nullif(count(*) filter (where event_type = 'click'), 0) / count(*) * 100, 9)
               as click_dominance_pct,
           strftime(ts, '%Y-%m-%d') as snapshot_date,
           strftime(ts, '%Y-%m-%d %H:00:00') as fetched_at
    from events group by all
"""


@query(GLOBAL_SQL)
def global_stage(spark, sf_dir):
    """Global documents per hour: envelope opened, one currency and one coin picked."""
    root = P.new_root(spark, "global")
    land_raw(P.global_payloads(spark, sf_dir), root)
    df = stg_global(scan_global(spark, root, "landed"), "purchase", "click")
    return df.withColumn("click_dominance_pct", F.round("click_dominance_pct", 9))


@query("""
    select event_id, props ->> 'k' as k, props ->> 'absent' as absent,
           json_extract_string('{"h":["' || event_type || '",""]}', '$.h[0]') as first_item,
           cast(null as varchar) as no_item
    from events
""")
def json_extract(spark, sf_dir):
    """Text under a JSON key and first item of a JSON list; missing gives NULL."""
    listed = F.concat(F.lit('{"h":["'), F.col("event_type"), F.lit('",""]}'))
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_text(F.col("props"), "k").alias("k"),
        json_text(F.col("props"), "absent").alias("absent"),
        json_first(listed, "h").alias("first_item"),
        json_first(F.lit('{"h":[]}'), "h").alias("no_item"),
    )


@query("""
    select page_id, regexp_extract(url, '://([^/]+)/', 1) as host,
           string_split(url, '/')[4] as first_segment, string_split(url, '/')[40] as no_segment,
           trim(regexp_extract(url, '://[^/]+(/.*)$', 1), '/') as path
    from pages
""")
def url_extract(spark, sf_dir):
    """Path segments by pattern and by position, slashes trimmed."""
    url = F.col("url")
    parts = F.split(url, "/")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract(url, "://([^/]+)/", 1).alias("host"),
        item(parts, 4).alias("first_segment"),
        item(parts, 40).alias("no_segment"),
        trim_slashes(F.regexp_extract(url, "://[^/]+(/.*)$", 1)).alias("path"),
    )


@query("""
    select event_id,
           'raw/' || event_type || strftime(ts, '/date=%Y-%m-%d/fetched_at=%Y-%m-%dT%H-%M-%SZ.json')
               as key,
           'raw/coins/' || user_id || '/market_chart'
               || strftime(ts, '/date=%Y-%m-%d/fetched_at=%Y-%m-%dT%H-%M-%SZ.json') as chart_key,
           cast(user_id as varchar) as coin_id, strftime(ts, '%Y-%m-%d') as date,
           strftime(ts, '%Y-%m-%d %H:%M:%S') as fetched_at
    from events
""")
def raw_keys(spark, sf_dir):
    """Object keys from prefix and time, and coin, date and time read back from them."""
    prefix = F.concat(F.lit("/"), F.col("event_type"), F.lit("//"))
    chart_prefix = keys.key_prefix(F.lit("market_chart"), F.col("user_id").cast("string"))
    keyed = table(spark, sf_dir, "events").select(
        "event_id",
        keys.raw_key(prefix, F.col("ts")).alias("key"),
        keys.raw_key(chart_prefix, F.col("ts")).alias("chart_key"),
    )
    path = F.col("chart_key")
    return keyed.select(
        "*",
        keys.chart_coin_of(path).alias("coin_id"),
        keys.date_of(path).alias("date"),
        keys.fetched_at_of(path).alias("fetched_at"),
    )


@query("""
    with replayed as (select distinct user_id from events where value > 250)
    select cast(user_id as varchar) as coin_id, '2024-02-01 00:00:00' as fetched_at,
           epoch_us(ts) // 1000 as ts_ms, value * 2 as price_usd
    from events where value > 250
    union all
    select cast(user_id as varchar), '2024-02-01 00:00:00', epoch_us(ts) // 1000, value
    from events where user_id not in (select user_id from replayed)
    union all
    select cast(user_id as varchar), '2024-02-02 00:00:00', epoch_us(ts) // 1000, value
    from events where event_type = 'signup'
""")
def land_idempotent(spark, sf_dir):
    """A rerun replaces exactly its own fetches, a new logical time adds, the rest stays."""
    root = P.new_root(spark, "replay")
    land_raw(P.charts(spark, sf_dir), root)
    replay = P.charts(spark, sf_dir, factor=2.0, where="value > 250")
    land_raw(replay, root)
    land_raw(replay, root)
    land_raw(P.charts(spark, sf_dir, as_of=P.REFETCH_AT, where="event_type = 'signup'"), root)
    points = stg_chart_points(scan_charts(spark, root, "landed"))
    return points.drop("snapshot_date")


@query("""
    select cast(user_id as varchar) as coin_id, '2024-02-01' as snapshot_date,
           count(*) as n_points, min(epoch_us(ts) // 1000) as first_ms,
           max(epoch_us(ts) // 1000) as last_ms
    from events group by user_id
""")
def views_sql(spark, sf_dir):
    """SQL over the registered staged views."""
    root = P.new_root(spark, "views")
    land_raw(P.charts(spark, sf_dir), root)
    register_views(spark, root, "landed")
    return spark.sql("""
        select coin_id, snapshot_date, count(*) as n_points, min(ts_ms) as first_ms,
               max(ts_ms) as last_ms
        from stg_market_chart group by coin_id, snapshot_date
    """)


def register_lake(spark, sf_dir):
    """All four kinds of documents landed in one lake, and the staged views registered over it."""
    root = P.new_root(spark, "lake")
    for build in (P.snapshots, P.metadata, P.global_payloads, P.charts):
        land_raw(build(spark, sf_dir), root)
    return register_views(spark, root, "landed")


# The staged views and the SQL that gives their rows from the tables.
VIEW_SQL = {
    "stg_coins_markets": SNAPSHOT_SQL,
    "stg_coin_metadata": METADATA_SQL,
    "stg_global": GLOBAL_SQL,
    "stg_market_chart": CHART_SQL,
}


def _view_counts(sources: dict[str, str]) -> str:
    return " union all ".join(
        f"""
        select '{name}' as view_name, cast(snapshot_date as varchar(10)) as snapshot_date, count(*) as n_rows,
               count(distinct {"fetched_at" if name == "stg_global" else "coin_id"}) as n_keys
        from {source} group by snapshot_date"""
        for name, source in sources.items()
    )


@query(_view_counts({name: f"({sql})" for name, sql in VIEW_SQL.items()}))
def views_all(spark, sf_dir):
    """SQL over all four staged views of one lake: rows and keys per day."""
    register_lake(spark, sf_dir)
    return spark.sql(_view_counts({name: name for name in VIEW_SQL}))


@query("""
    select event_id, upper(event_type) as ticker, strftime(ts, '%Y-%m-%d %H:%M:%S') as naive,
           strftime(ts - interval 330 minute, '%Y-%m-%d %H:%M:%S') as aware
    from events
""")
def utc_times(spark, sf_dir):
    """Naive times are UTC already, aware ones are converted; tickers in capitals."""
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    offset = F.concat(second.cast("string"), F.lit("+05:30")).cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id", upper_ticker(F.col("event_type")).alias("ticker"), utc(second).alias("naive"), utc(offset).alias("aware")
    )
