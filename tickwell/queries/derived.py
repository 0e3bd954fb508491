"""Queries over consolidation, ranking, watch lists, marts and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.functions.scalars import epoch_ms, hour_start
from tickwell.operators.consolidate import ids_string, last_n_days, restrict_to, top_by
from tickwell.operators.landing import land_raw
from tickwell.operators.staging import stg_chart_points, stg_global
from tickwell.plans import marts
from tickwell.plans.layers import layer_path, save_table, write_table
from tickwell.queries import payloads as P
from tickwell.queries.registry import query, table
from tickwell.session import materialize
from tickwell.sources.scans import decode_global, decode_metadata
from tickwell.sources.watchlist import watchlist
from tickwell.streaming.ingest import stream_points

# ------------------------------------------------------------ lists, ranks, windows


@query("""
    select o_orderkey, cast(o_custkey as varchar) as coin_id, o_totalprice from orders
    where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')
""")
def watchlist_restrict(spark, sf_dir):
    """Rows of the coins on a watch list."""
    customer = table(spark, sf_dir, "customer")
    listed = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey").cast("string"))
    watch = watchlist(customer.select(listed.alias("id")))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("coin_id"), "o_totalprice"
    )
    return restrict_to(orders, watch, "coin_id")


@query("""
    select c_custkey // 100 as page, string_agg(c_custkey, ',' order by c_custkey) as ids
    from customer group by c_custkey // 100
""")
def watchlist_ids(spark, sf_dir):
    """Ids of a watch list as comma strings, one per request page."""
    watch = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("position"), F.col("c_custkey").alias("id")
    )
    return ids_string(watchlist(watch))


@query("""
    select o_orderkey, o_totalprice from orders
    order by o_totalprice desc, o_orderkey limit 100
""")
def top_by_value(spark, sf_dir):
    """The first page of a ranking."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_by(orders, "o_totalprice", 100, "o_orderkey")


@query("""
    select c_mktsegment, c_custkey, c_acctbal,
           cast(row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey)
                as integer) as rank
    from customer
    qualify row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) <= 10
""")
def top_per_group(spark, sf_dir):
    """The first ten of a ranking per group."""
    customers = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return top_by(customers, "c_acctbal", 10, "c_custkey", ["c_mktsegment"])


@query("""
    select event_id, user_id, value from events
    where ts between timestamp '2024-01-25' and timestamp '2024-02-01'
""")
def last_seven_days(spark, sf_dir):
    """Trailing window before a logical time."""
    events = table(spark, sf_dir, "events")
    return last_n_days(events, "ts", P.BACKFILL_AT, 7).select("event_id", "user_id", "value")


# ------------------------------------------------------------------- consolidation


def _both_fetches(spark, sf_dir):
    """Points of a backfill and of a later seven-day fetch with changed values."""
    backfill = P.charts(spark, sf_dir)
    refetch = P.charts(spark, sf_dir, as_of=P.REFETCH_AT, days=7, factor=2.0)
    return stg_chart_points(P.unlanded(backfill.unionByName(refetch)))


LATEST_SQL = """
    select cast(user_id as varchar) as coin_id, epoch_us(ts) // 1000 as ts_ms,
           case when ts >= timestamp '2024-01-26' then value * 2 else value end as price_usd,
           case when ts >= timestamp '2024-01-26' then '2024-02-02 00:00:00'
                else '2024-02-01 00:00:00' end as fetched_at
    from events
"""


@query(LATEST_SQL)
def latest_points(spark, sf_dir):
    """Overlapping fetches consolidated: the later fetch wins."""
    return marts.latest_points(_both_fetches(spark, sf_dir))


_DAILY_SQL = """
    select cast(user_id as varchar) as coin_id, strftime(ts, '%Y-%m-%d') as day,
           arg_min(price, epoch_us(ts) // 1000) as open, max(price) as high, min(price) as low,
           arg_max(price, epoch_us(ts) // 1000) as close, count(*) as n_points
    from (select *, case when ts >= timestamp '2024-01-26' then value * 2 else value end as price
          from events)
    group by user_id, strftime(ts, '%Y-%m-%d')
"""


@query(_DAILY_SQL)
def daily_ohlc(spark, sf_dir):
    """Daily fact of the consolidated points."""
    return marts.daily_ohlc(marts.latest_points(_both_fetches(spark, sf_dir)))


@query(_DAILY_SQL)
def write_layers(spark, sf_dir):
    """The daily fact written as a partitioned table of its layer and read back."""
    root = P.new_root(spark, "layers")
    daily = marts.daily_ohlc(marts.latest_points(_both_fetches(spark, sf_dir)))
    path = write_table(daily, layer_path(root, "marts", "market_daily"), ["day"])
    return spark.read.schema(daily.schema).parquet(path)


@query(_DAILY_SQL)
def bucketed_layer(spark, sf_dir):
    """Consolidated points as a table bucketed by coin, and the daily fact grouped from it without a shuffle."""
    root = P.new_root(spark, "core")
    name = f"points_{root.rsplit('-', 1)[1]}"
    points = marts.latest_points(_both_fetches(spark, sf_dir))
    return marts.daily_ohlc(spark.table(save_table(points, root, "core", name, ["coin_id"], 16)))


@query("""
    select cast(user_id as varchar) as coin_id, strftime(ts, '%Y-%m-%d %H:00:00') as hour,
           arg_max(event_id, (ts, event_id)) as event_id,
           arg_max(event_type, (ts, event_id)) as event_type
    from events group by user_id, strftime(ts, '%Y-%m-%d %H:00:00')
""")
def hourly_fact(spark, sf_dir):
    """Per coin and hour the row of the latest fetch."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("coin_id"), F.col("ts").alias("fetched_at"),
        "event_id", "event_type",
    )
    return marts.hourly_fact(rows).select("coin_id", "hour", "event_id", "event_type")


@query("""
    select cast(user_id as varchar) as coin_id, '2024-02-01 00:00:00' as fetched_at,
           '2024-02-01' as snapshot_date, epoch_us(ts) // 1000 as ts_ms, value as price_usd
    from events
""")
def stream_ingest(spark, sf_dir):
    """Landed charts read as a stream and staged in micro-batches."""
    root = P.new_root(spark, "stream")
    land_raw(P.charts(spark, sf_dir), root)
    stream_points(spark, root, f"{root}/points", f"{root}/checkpoint")
    schema = stg_chart_points(P.unlanded(P.charts(spark, sf_dir))).schema
    return spark.read.schema(schema).parquet(f"{root}/points").select(*schema.names)


# --------------------------------------------------------------------------- marts


@query("""
    with latest as (
        select * from documents
        qualify row_number() over (partition by source order by n_chars desc, doc_id desc) = 1)
    select w.source as coin_id, w.n as position,
           case when lang = 'en' then text end as description_en,
           case when lang = 'fr' then 0 else 1 end as n_homepages,
           case when lang = 'en' then 1 else 0 end as n_explorers,
           '2009-01-03' as genesis_date
    from (select source, count(*) as n from documents group by source) w
    left join latest l on w.source = l.source
""")
def coin_dim(spark, sf_dir):
    """Watch list enriched with each coin's latest metadata, links cleaned."""
    documents = table(spark, sf_dir, "documents")
    # The newest document of a source is its longest; ties go to the higher id.
    scan = decode_metadata(P.unlanded(P.metadata(spark, sf_dir))).select(
        F.col("symbol").alias("id"),
        "description",
        "links",
        "genesis_date",
        F.timestamp_seconds(F.col("market_cap_rank").cast("bigint")).alias("fetched_at"),
        F.lpad("id", 20, "0").alias("filename"),
    )
    watch = documents.groupBy(F.col("source").alias("id")).agg(F.count(F.lit(1)).alias("position"))
    dim = marts.coin_dim(scan, watch)
    return dim.select(
        "coin_id",
        "position",
        "description_en",
        F.size("homepages").alias("n_homepages"),
        F.size("block_explorers").alias("n_explorers"),
        "genesis_date",
    )


@query("""
    with hourly as (
        select date_trunc('hour', ts) as h,
               cast(sum(cast(value as decimal(18,2))) as double) as total,
               cast(sum(case when event_type = 'click' then cast(value as decimal(18,2)) else 0 end)
                    as double) as clicks
        from events group by 1),
    lagged as (select *, lag(total) over (order by h) as prev from hourly)
    select strftime(h, '%Y-%m-%d %H:%M:%S') as fetched_at, total as total_market_cap,
           round(clicks / nullif(total, 0) * 100, 6) as coin_share_pct, prev as prev_total_market_cap,
           round(total - prev, 6) as cap_change, round((total - prev) / nullif(prev, 0) * 100, 6) as cap_change_pct
    from lagged
""")
def market_health(spark, sf_dir):
    """Level, change and share of the global figures in time order."""
    value = F.col("value").cast("decimal(18,2)")
    clicks = F.sum(F.when(F.col("event_type") == "click", value).otherwise(F.lit(0)))
    totals = (
        table(spark, sf_dir, "events")
        .groupBy(hour_start(F.col("ts")).alias("fetched_at"))
        .agg(F.sum(value).cast("double").alias("total_market_cap"), clicks.cast("double").alias("clicks"))
        .select(
            "fetched_at",
            "total_market_cap",
            F.round(F.try_divide(F.col("clicks"), F.col("total_market_cap")) * 100, 6).alias("coin_share_pct"),
        )
    )
    # One row per hour, read twice below: worked out once.
    health = marts.market_health(materialize(totals, "totals"))
    return health.withColumns({c: F.round(c, 6) for c in ("cap_change", "cap_change_pct")})


@query("""
    with hourly as (
        select date_trunc('hour', ts) as h,
               cast(sum(cast(value as decimal(18,2))) filter (where event_type = 'purchase') as double) as total,
               nullif(count(*) filter (where event_type = 'click'), 0) / count(*) * 100 as share
        from events group by 1),
    lagged as (select *, lag(total) over (order by h) as prev from hourly)
    select strftime(h, '%Y-%m-%d %H:%M:%S') as fetched_at, total as total_market_cap,
           round(share, 6) as coin_share_pct, prev as prev_total_market_cap, round(total - prev, 6) as cap_change,
           round((total - prev) / nullif(prev, 0) * 100, 6) as cap_change_pct
    from lagged
""")
def global_health(spark, sf_dir):
    """The same from the staged global documents: totals in one currency, share of one coin."""
    staged = stg_global(decode_global(P.unlanded(P.global_payloads(spark, sf_dir))), "purchase", "click")
    totals = staged.select(
        "fetched_at",
        F.col("total_market_cap_purchase").alias("total_market_cap"),
        F.round("click_dominance_pct", 6).alias("coin_share_pct"),
    )
    health = marts.market_health(materialize(totals, "totals"))
    return health.withColumns({c: F.round(c, 6) for c in ("cap_change", "cap_change_pct")})


@query("""
    with hourly as (
        select event_type as currency, date_trunc('hour', ts) as h,
               cast(sum(cast(value as decimal(18,2))) as double) as total
        from events group by 1, 2)
    select currency, strftime(h, '%Y-%m-%d %H:%M:%S') as fetched_at, total as total_market_cap,
           lag(total) over (partition by currency order by h) as prev_total_market_cap
    from hourly
""")
def market_health_by_currency(spark, sf_dir):
    """The same per currency, from the long form of the global documents."""
    data = decode_global(P.unlanded(P.global_payloads(spark, sf_dir))).select("fetched_at", "data.*")
    long = marts.currency_long(data, "fetched_at").select(
        "currency", "fetched_at", F.col("value").cast("double").alias("total_market_cap")
    )
    return marts.market_health(materialize(long, "totals"), ["currency"]).select(
        "currency", "fetched_at", "total_market_cap", "prev_total_market_cap"
    )


@query("""
    with daily as (
        select cast(user_id as varchar) as coin_id, strftime(ts, '%Y-%m-%d 00:00:00') as fetched_at,
               round((arg_max(value, ts) / nullif(arg_min(value, ts), 0) - 1) * 100, 6) as change
        from events group by 1, 2),
    ranked as (
        select *, row_number() over (partition by fetched_at order by change desc, coin_id) as up,
               row_number() over (partition by fetched_at order by change, coin_id) as down
        from daily where change is not null)
    select fetched_at, coin_id, change as price_change_percentage_24h, cast(up as integer) as rank,
           'gainer' as direction from ranked where up <= 5
    union all
    select fetched_at, coin_id, change, cast(down as integer), 'loser' from ranked where down <= 5
""")
def top_movers(spark, sf_dir):
    """Strongest gainers and losers per snapshot."""
    day = F.to_date("ts").cast("timestamp_ntz")
    moved = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("coin_id"), day.alias("fetched_at"))
        .agg((F.try_divide(F.max_by("value", "ts"), F.min_by("value", "ts")) - 1).alias("ratio"))
        .select(
            "coin_id",
            "fetched_at",
            F.round(F.col("ratio") * 100, 6).alias("price_change_percentage_24h"),
        )
    )
    return marts.top_movers(materialize(moved, "moved"), 5)


@query("""
    with daily as (
        select cast(user_id as varchar) as coin_id, cast(ts as date) as d, arg_max(value, ts) as close
        from events group by 1, 2),
    steps as (
        select a.*, b.close as c1, c.close as c7, e.close as c30
        from daily a
        left join daily b on b.coin_id = a.coin_id and b.d = a.d - 1
        left join daily c on c.coin_id = a.coin_id and c.d = a.d - 7
        left join daily e on e.coin_id = a.coin_id and e.d = a.d - 30)
    select coin_id, strftime(d, '%Y-%m-%d') as day, close,
           round(close / nullif(c1, 0) - 1, 6) as return_1d,
           round(close / nullif(c7, 0) - 1, 6) as return_7d,
           round(close / nullif(c30, 0) - 1, 6) as return_30d,
           round(avg(close) over (partition by coin_id order by d
                 range between interval 6 days preceding and current row), 6) as moving_average,
           round(stddev_samp(case when close > 0 and c1 > 0 then ln(close / c1) end) over (partition by coin_id order by d
                 range between interval 29 days preceding and current row), 6) as volatility
    from steps
""")
def performance(spark, sf_dir):
    """Returns, trailing mean and volatility per coin and day."""
    points = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("coin_id"),
        epoch_ms(F.col("ts")).alias("ts_ms"),
        F.col("value").alias("price_usd"),
    )
    result = marts.performance(marts.daily_ohlc(points))
    rounded = ("return_1d", "return_7d", "return_30d", "moving_average", "volatility")
    return result.withColumns({c: F.round(c, 6) for c in rounded})


@query("""
    select strftime(ts, '%Y-%m-%d %H:00:00') as fetched_at, event_type as currency,
           cast(sum(cast(value as decimal(18,2))) as double) as value
    from events group by 1, 2
""")
def currency_long(spark, sf_dir):
    """One row per fetch and currency."""
    data = decode_global(P.unlanded(P.global_payloads(spark, sf_dir))).select("fetched_at", "data.*")
    return marts.currency_long(data, "fetched_at").withColumn("value", F.col("value").cast("double"))


@query("""
    select cast(doc_id as varchar) as coin_id, source as chain, lang as address
    from documents where lang <> 'de'
""")
def chain_bridge(spark, sf_dir):
    """One row per coin and chain it has an address on."""
    docs = decode_metadata(P.unlanded(P.metadata(spark, sf_dir))).select(
        F.col("id").alias("coin_id"), F.from_json("platforms", "map<string,string>").alias("platforms")
    )
    return marts.chain_bridge(docs, "coin_id")


ALIGNED_SQL = """
    select cast(user_id as varchar) as coin_id, epoch_us(ts) // 1000 as ts_ms,
           case when event_type <> 'error' then value end as price_usd,
           case when event_type = 'click' then value * 1000 end as market_cap_usd,
           case when event_type in ('error', 'purchase') then cast(event_id as double) end as volume_usd
    from events
"""


@query(ALIGNED_SQL)
def aligned_series(spark, sf_dir):
    """The three series of a chart side by side though they do not share positions."""
    t, kind = F.col("t"), F.col("event_type")
    parts = P.chart_parts(
        spark,
        sf_dir,
        {
            "prices": F.when(kind != "error", F.array(t, "value")),
            "market_caps": F.when(kind == "click", F.array(t, F.col("value") * 1000)),
            "total_volumes": F.when(
                kind.isin("error", "purchase"), F.array(t, F.col("event_id").cast("double"))
            ),
        },
    )
    return marts.aligned_series(parts).drop("fetched_at")
