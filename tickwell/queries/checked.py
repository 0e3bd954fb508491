"""Queries over contracts, data tests and load jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.functions.scalars import epoch_ms
from tickwell.operators import quality
from tickwell.operators.contracts import ContractError, conform, report, validate
from tickwell.operators.landing import land_raw, read_batch
from tickwell.operators.staging import ohlc_rows, stg_snapshots
from tickwell.plans.layers import first_rows
from tickwell.plans.loads import backfill_summary, load, load_charts, report_files, summarize, validate_stored
from tickwell.queries import payloads as P
from tickwell.queries.registry import query, table
from tickwell.queries.staged import VIEW_SQL, register_lake
from tickwell.schemas import STAGING_TESTS
from tickwell.session import scratch_dir
from tickwell.sources.requests import json_of, request_documents
from tickwell.sources.scans import decode_snapshots, scan_ohlc
from tickwell.sources.store import local_path, store_local

_CHART_KEY = """'raw/coins/' || user_id ||
    '/market_chart/date=2024-02-01/fetched_at=2024-02-01T00-00-00Z.json'"""


@query(f"""
    select {_CHART_KEY} as s3_key, count(*) as prices_count, 'valid' as status
    from events group by user_id
""")
def readback_summary(spark, sf_dir):
    """Backfill of all coins: landed, read back, validated, summarized."""
    root = P.new_root(spark, "backfill")
    return load_charts(
        table(spark, sf_dir, "events"), root, P.BACKFILL_AT, 365,
        "user_id", "ts", "event_id", P.chart_values(),
    )


@query(f"""
    select {_CHART_KEY} as s3_key, count(*) as prices_count, 'valid' as status
    from events where ts between timestamp '2024-01-25' and timestamp '2024-02-01'
    group by user_id
""")
def incremental_summary(spark, sf_dir):
    """Trailing seven days of all coins: landed, read back, validated, summarized."""
    root = P.new_root(spark, "incremental")
    return load_charts(
        table(spark, sf_dir, "events"), root, P.BACKFILL_AT, 7,
        "user_id", "ts", "event_id", P.chart_values(),
    )


@query(f"""
    select {_CHART_KEY} as s3_key, count(*) as prices_count, 'valid' as status
    from events where user_id in (select user_id from events where value > 250)
    group by user_id
""")
def keyed_readback(spark, sf_dir):
    """Some fetches read back from the table by their keys, validated and summarized."""
    root = P.new_root(spark, "keyed")
    land_raw(P.charts(spark, sf_dir), root)
    wanted = (
        table(spark, sf_dir, "events")
        .filter("value > 250")
        .select(
            F.lit("market_chart").alias("kind"),
            F.col("user_id").cast("string").alias("coin_id"),
            F.lit(P.BACKFILL_AT.isoformat(sep=" ")).cast("timestamp_ntz").alias("fetched_at"),
        )
    )
    return summarize(validate_stored(spark, root, wanted, "market_chart"), "market_chart")


@query("""
    select 'raw/coins/markets' || strftime(date_trunc('month', o_orderdate),
               '/date=%Y-%m-%d/fetched_at=%Y-%m-%dT%H-%M-%SZ.json') as s3_key,
           count(*) as coins_count, 'valid' as status
    from orders group by date_trunc('month', o_orderdate)
""")
def snapshot_summary(spark, sf_dir):
    """Number of records per validated snapshot."""
    return summarize(validate(P.unlanded(P.snapshots(spark, sf_dir)), "coins_markets"), "coins_markets")


@query("""
    select strftime(date_trunc('hour', ts),
               'raw/global/date=%Y-%m-%d/fetched_at=%Y-%m-%dT%H-%M-%SZ.json') as s3_key,
           'valid' as status
    from events group by date_trunc('hour', ts)
""")
def global_load(spark, sf_dir):
    """Global documents landed, read back and validated."""
    root = P.new_root(spark, "global")
    return load(P.global_payloads(spark, sf_dir), root, "global")


@query("""
    select cast(doc_id as varchar) as coin_id, source as symbol, 'valid' as status from documents
""")
def metadata_summary(spark, sf_dir):
    """Summary rows of validated metadata."""
    return summarize(
        validate(P.unlanded(P.metadata(spark, sf_dir)), "coins_metadata"), "coins_metadata"
    )


@query("""
    select cast(user_id as varchar) as coin_id, event_id // 262144 as part,
           case when count(*) filter (where event_type = 'error' or value > 150) > 0
                then 'invalid' else 'valid' end as status,
           cast(case when count(*) filter (where event_type = 'error') > 0 then 1 else 0 end as bigint)
               as value_errors,
           count(*) filter (where value > 200) as float_type_errors,
           count(*) filter (where value > 150 and value <= 200) as float_parsing_errors
    from events group by user_id, event_id // 262144
""")
def validate_chart_errors(spark, sf_dir):
    """Charts with short rows, nulls and text for numbers, counted per kind of error."""
    t = F.col("t")
    value = F.col("value")
    damaged = P.chart_parts(
        spark,
        sf_dir,
        {
            "prices": F.when(F.col("event_type") == "error", F.array(t)).otherwise(F.array(t, value)),
            "market_caps": F.array(t, F.when(value <= 200, value)),
            "total_volumes": F.array(
                t.cast("string"),
                F.when(value.between(150, 200) & (value > 150), "n/a").otherwise(value.cast("string")),
            ),
        },
    )
    checked = validate(damaged, "market_chart")

    def count_of(kind: str):
        return F.size(F.filter("errors", lambda e: e["type"] == kind)).cast("bigint")

    return checked.select(
        "coin_id",
        "part",
        "status",
        count_of("value_error").alias("value_errors"),
        count_of("float_type").alias("float_type_errors"),
        count_of("float_parsing").alias("float_parsing_errors"),
    )


@query("""
    select doc_id,
           case when n_chars > 5000 or lang in ('fr', 'de') or source = 'src1'
                then 'FAIL' else 'PASS' end as status,
           cast((n_chars > 5000)::int + (lang = 'fr')::int + (lang = 'de')::int
                + (source = 'src1')::int as bigint) as n_errors,
           concat_ws(chr(10),
               case when n_chars > 5000 then 'field: id | a text value is needed (string_type)' end,
               case when source = 'src1' then 'field: name | a required field is absent (missing)' end,
               case when lang = 'fr' then 'field: categories | a list is needed (list_type)' end,
               case when lang = 'de'
                    then 'field: links -> homepage -> 1 | a text value is needed (string_type)' end)
               as errors
    from documents
""")
def validate_metadata_report(spark, sf_dir):
    """PASS or FAIL per document with every error's place and kind."""
    lang, source = F.col("lang"), F.col("source")
    members = [
        F.concat(F.lit('"id":'), F.when(F.col("n_chars") > 5000, F.col("doc_id").cast("string")).otherwise(
            F.concat(F.lit('"'), F.col("doc_id").cast("string"), F.lit('"')))),
        F.concat(F.lit('"symbol":"'), source, F.lit('"')),
        F.when(source != "src1", F.concat(F.lit('"name":"'), lang, F.lit('"'))),
        F.when(lang == "fr", F.lit('"categories":null')),
        F.when(lang == "de", F.lit('"links":{"homepage":["x",null]}')).otherwise(F.lit('"links":null')),
        F.concat(F.lit('"description":'), json_of(F.struct(F.col("text").alias("en")))),
        F.lit('"platforms":{"":"","a":null}'),
        F.lit('"unknown":[1]'),
    ]
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("payload")
    )
    return report(validate(documents, "coins_metadata"), "doc_id")


@query("""
    select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as fetched_at,
           case when hour(ts) in (0, 6, 12) then 'invalid' else 'valid' end as status,
           case hour(ts) when 0 then 'data|missing'
                         when 6 then 'data -> total_market_cap|dict_type'
                         when 12 then 'data -> active_cryptocurrencies|int_parsing'
                         else '' end as errors
    from events group by all
""")
def validate_global(spark, sf_dir):
    """Global documents: envelope missing, a null map, text for a count; an absent map is fine."""
    hour = F.hour("fetched_at")
    cap = F.when(hour != 6, F.col("caps"))
    whole = F.struct(
        F.when(hour == 12, "many").otherwise(F.col("n").cast("string")).alias("active_cryptocurrencies"),
        cap.alias("total_market_cap"),
    )
    totals = P.hourly_totals(spark, sf_dir)
    payloads = totals.select(
        "fetched_at",
        F.when(hour == 0, json_of(whole)).otherwise(json_of(F.struct(whole.alias("data")))).alias("payload"),
    )
    listed = F.transform("errors", lambda e: F.concat(e["loc"], F.lit("|"), e["type"]))
    return validate(payloads, "global").select(
        "fetched_at", "status", F.array_join(listed, ";").alias("errors")
    )


@query("""
    select cast(o_orderkey as varchar) as id, o_orderstatus as symbol,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as last_updated,
           o_totalprice as current_price, o_custkey as market_cap_rank,
           o_totalprice as total_volume, cast(null as double) as ath
    from orders
""")
def conform_snapshots(spark, sf_dir):
    """Typed records of valid snapshots: numeric text and whole decimals coerced."""
    valid = validate(P.unlanded(P.snapshots(spark, sf_dir, loose=True)), "coins_markets")
    return conform(valid, "coins_markets").select(F.inline("record")).select(
        "id", "symbol", "last_updated", "current_price", "market_cap_rank", "total_volume", "ath"
    )


@query("""
    select cast(user_id as varchar) as coin_id,
           cast(epoch_ms(date_trunc('day', ts)) as bigint) as ts_ms,
           arg_min(value, ts) as open, max(value) as high, min(value) as low,
           arg_max(value, ts) as close
    from events group by user_id, date_trunc('day', ts)
""")
def ohlc_candles(spark, sf_dir):
    """Daily candles per coin as one payload, validated, decoded and flattened."""
    day = F.to_date("ts")
    ts_ms = epoch_ms(F.col("day")).cast("double")
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("coin"), day.alias("day"))
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
        )
    )
    # One candle per coin and calendar day bounds the list.
    lists = daily.groupBy("coin").agg(
        F.collect_list(F.array(ts_ms, "open", "high", "low", "close")).alias("candles")
    )
    fetched = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    payloads = request_documents(lists, "ohlc", F.col("coin"), fetched, F.col("candles"))
    checked = validate(payloads, "ohlc")
    valid = checked.select(
        "coin_id", F.explode(F.when(F.size("errors") == 0, F.array("payload"))).alias("payload")
    )
    return ohlc_rows(scan_ohlc(valid), "coin_id")


@query("""
    select o_orderkey, case when o_orderkey % 8 in (0, 7) then 'PASS' else 'FAIL' end as status,
           cast(case o_orderkey % 8 when 0 then 0 when 7 then 0 when 5 then 2 else 1 end as bigint) as n_errors,
           case o_orderkey % 8
                when 1 then 'field: 0 -> id | a text value is needed (string_type)'
                when 2 then 'field: 0 -> symbol | a required field is absent (missing)'
                when 3 then 'field: 1 -> current_price | the text is no number (float_parsing)'
                when 4 then 'field: 0 -> market_cap_rank | the number has a fractional part (int_from_float)'
                when 5 then 'field: 0 -> last_updated | the text is no time or date (datetime_from_date_parsing)' || chr(10)
                            || 'field: 1 | an object with named fields is needed (model_type)'
                when 6 then 'field:  | a list is needed (list_type)' else '' end as errors
    from orders
""")
def validate_snapshot_errors(spark, sf_dir):
    """Snapshot lists with a fault of each kind, reported with its place."""
    kind = F.col("o_orderkey") % 8

    def text(c):
        return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))

    def coin(price):
        members = [
            F.concat(F.lit('"id":'), F.when(kind == 1, F.col("o_orderkey").cast("string")).otherwise(text(F.col("o_orderkey")))),
            F.when(kind != 2, F.concat(F.lit('"symbol":'), text(F.col("o_orderstatus")))),
            F.concat(F.lit('"name":'), text(F.col("o_orderpriority"))),
            F.concat(F.lit('"last_updated":"'), F.when(kind == 5, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit('"')),
            F.concat(F.lit('"current_price":'), price),
            F.concat(F.lit('"market_cap_rank":'), F.when(kind == 4, "1.5").when(kind == 7, "3.0").otherwise("3")),
        ]
        return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))

    price = text(F.col("o_totalprice"))
    second = F.when(kind == 3, coin(F.lit('"n/a"'))).when(kind == 5, F.lit("[]"))
    whole = F.concat(F.lit("["), F.concat_ws(",", coin(price), second), F.lit("]"))
    lists = table(spark, sf_dir, "orders").select("o_orderkey", F.when(kind == 6, coin(price)).otherwise(whole).alias("payload"))
    return report(validate(lists, "coins_markets"), "o_orderkey")


@query("""
    select user_id, case when user_id % 5 = 0 then 'valid' else 'invalid' end as status,
           case user_id % 5 when 1 then '' when 2 then n - 1 || ' -> 4' when 3 then '0 -> 0' when 4 then '' end as loc,
           case user_id % 5 when 1 then 'value_error' when 2 then 'float_parsing' when 3 then 'float_type' when 4 then 'list_type' end as type
    from (select user_id, count(distinct strftime(ts, '%Y-%m-%d')) as n from events group by user_id)
""")
def validate_ohlc_errors(spark, sf_dir):
    """Candle lists with short rows, text and nulls for numbers, and objects for lists."""
    kind = F.col("user_id") % 5
    value = F.col("value").cast("string")
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))
    lists = daily.groupBy("user_id").agg(F.collect_list(F.concat(F.lit("[1,2,3,4,"), value, F.lit("]"))).alias("rows"))
    rows = F.array_join("rows", ",")
    last = F.concat_ws(",", F.array_join(F.slice("rows", 1, F.size("rows") - 1), ","), F.lit('[1,2,3,4,"n/a"]'))
    last = F.when(F.size("rows") == 1, '[1,2,3,4,"n/a"]').otherwise(last)
    inside = F.when(kind == 1, F.concat(rows, F.lit(",[1,2,3,4]"))).when(kind == 2, last)
    inside = inside.when(kind == 3, F.concat(F.lit("[null,2,3,4,5],"), rows)).otherwise(rows)
    payload = F.when(kind == 4, '{"rows":[]}').otherwise(F.concat(F.lit("["), inside, F.lit("]")))
    checked = validate(lists.select("user_id", payload.alias("payload")), "ohlc")
    first = F.get("errors", 0)
    return checked.select("user_id", "status", first["loc"].alias("loc"), first["type"].alias("type"))


@query("""
    select 'raw/global/date=' || strftime(h, '%Y-%m-%d') || '/fetched_at=' || strftime(h, '%Y-%m-%dT%H-00-00Z.json') as s3_key,
           case when n % 3 = 0 then 'invalid' else 'valid' end as status,
           (select count(*) > 0 from (select date_trunc('hour', ts), count(*) as n from events group by 1) where n % 3 = 0) as raised
    from (select date_trunc('hour', ts) as h, count(*) as n from events group by 1)
""")
def strict_load(spark, sf_dir):
    """A strict load of partly invalid payloads raises and leaves all of them stored."""
    root = P.new_root(spark, "strict")
    hours = P.global_payloads(spark, sf_dir)
    n = F.get_json_object("payload", "$.data.active_cryptocurrencies").cast("long")
    broken = F.regexp_replace("payload", '"markets":[0-9]+', '"markets":"many"')
    payloads = hours.withColumn("payload", F.when(n % 3 == 0, broken).otherwise(F.col("payload")))
    raised = False
    try:
        load(payloads, root, "global")
    except ContractError:
        raised = True
    stored = validate_stored(spark, root, hours.select("kind", "fetched_at"), "global")
    return summarize(stored, "global").withColumn("raised", F.lit(raised))


@query("""
    select source as coin, case when lang in ('fr', 'de') then 'FAIL' else 'PASS' end as status,
           cast(case when lang = 'fr' then 1 when lang = 'de' then 2 else 0 end as bigint) as n_errors, count(*) as files
    from documents group by all
""")
def files_report(spark, sf_dir):
    """Documents stored as files in the folders of their coins, reported one by one, counted by result."""
    root = scratch_dir(spark, "files")
    lang = F.col("lang")
    document = F.concat(
        F.lit('{"id":"'), F.col("doc_id").cast("string"), F.lit('","symbol":'), F.when(lang == "de", F.lit("1")).otherwise(F.lit('"s"')),
        F.when(lang.isin("fr", "de"), F.lit("")).otherwise(F.lit(',"name":"n"')), F.lit("}"),
    )
    files = table(spark, sf_dir, "documents").select("source", document.alias("value"))
    local = local_path(spark, root)
    if local:
        store_local(files, local, "source={source}", end=" ")
    else:
        P.objects_writer(files).partitionBy("source").option("maxRecordsPerFile", 1).text(root, lineSep=" ")
    found = report_files(spark, root, "coins_metadata", "*.txt")
    return found.groupBy(F.split_part("coin", F.lit("="), F.lit(2)).alias("coin"), "status", "n_errors").agg(F.count(F.lit(1)).alias("files"))


@query("""
    select cast(user_id as varchar) as coin_id,
           'raw/coins/' || user_id || '/market_chart/date=2024-02-01/fetched_at=2024-02-01T00-00-00Z.json' as s3_key,
           case when count(*) filter (where value > 250) > 0 then 'invalid' else 'valid' end as status
    from events group by user_id
""")
def backfill_status(spark, sf_dir):
    """The status of every coin's backfill, landed and read back."""
    root = P.new_root(spark, "status")
    pair = F.array(F.col("t"), F.when(F.col("value") <= 250, F.col("value")))
    parts = P.chart_parts(spark, sf_dir, {"prices": pair, "market_caps": pair, "total_volumes": pair})
    return backfill_summary(read_batch(spark, land_raw(parts, root)))


@query("""
    select 'documents_labels' as "table", 'not_null' as test, 'doc_id' as "columns",
           count(*) filter (where d.doc_id is null) as failures,
           case when count(*) filter (where d.doc_id is null) = 0 then 'pass' else 'fail' end as status
    from documents d left join labels l on d.doc_id = l.doc_id
    union all
    select 'documents_labels', 'not_null', 'quality', count(*) filter (where quality is null),
           case when count(*) filter (where quality is null) = 0 then 'pass' else 'fail' end
    from documents d left join labels l on d.doc_id = l.doc_id
    union all
    select 'documents_labels', 'not_null', 'toxic', count(*) filter (where toxic is null),
           case when count(*) filter (where toxic is null) = 0 then 'pass' else 'fail' end
    from documents d left join labels l on d.doc_id = l.doc_id
""")
def dq_not_null(spark, sf_dir):
    """Not-null tests of one table in one pass."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.not_null(joined, "documents_labels", ["doc_id", "quality", "toxic"])


def _unique_sql(name: str, column: str, source: str) -> str:
    return f"""
    select '{name}' as "table", 'unique' as test, '{column}' as "columns", count(*) as failures,
           case when count(*) = 0 then 'pass' else 'fail' end as status
    from (select {column} from {source} where {column} is not null
          group by {column} having count(*) > 1)"""


@query(
    _unique_sql("events", "event_id", "events")
    + " union all " + _unique_sql("events", "user_id", "events")
    + " union all " + _unique_sql("orders", "o_custkey", "orders")
    + " union all " + _unique_sql("labels", "quality", "(select quality from documents left join labels using (doc_id))")
)
def dq_unique(spark, sf_dir):
    """Uniqueness of single columns; nulls are left out."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    results = [
        quality.run_tests(table(spark, sf_dir, "events"), "events", {"unique": ["event_id", "user_id"]}),
        quality.unique(table(spark, sf_dir, "orders"), "orders", "o_custkey"),
        quality.unique(labelled, "labels", "quality"),
    ]
    return reduce(DataFrame.unionByName, results)


def _combo_sql(name: str, columns: str, source: str) -> str:
    return f"""
    select '{name}' as "table", 'unique_combination_of_columns' as test, '{columns}' as "columns",
           count(*) as failures, case when count(*) = 0 then 'pass' else 'fail' end as status
    from (select {columns} from {source} group by {columns} having count(*) > 1)"""


@query(
    _combo_sql("lineitem", "l_orderkey,l_linenumber", "lineitem")
    + " union all " + _combo_sql("events", "user_id,ts", "events")
    + " union all " + _combo_sql("labels", "quality,toxic", "(select quality, toxic from documents left join labels using (doc_id))")
)
def dq_unique_combo(spark, sf_dir):
    """Uniqueness of column combinations; nulls count as equal."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    results = [
        quality.unique_combination(table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.unique_combination(table(spark, sf_dir, "events"), "events", ["user_id", "ts"]),
        quality.unique_combination(labelled, "labels", ["quality", "toxic"]),
    ]
    return reduce(DataFrame.unionByName, results)


@query("""
    select 'stg_coins_markets' as "table", 'not_null' as test, 'coin_id' as "columns",
           count(*) filter (where o_orderkey is null) as failures,
           case when count(o_orderkey) = count(*) then 'pass' else 'fail' end as status
    from orders
    union all
    select 'stg_coins_markets', 'not_null', 'fetched_at', count(*) filter (where o_orderdate is null),
           case when count(o_orderdate) = count(*) then 'pass' else 'fail' end
    from orders
    union all
    select 'stg_coins_markets', 'not_null', 'current_price', count(*) filter (where o_totalprice is null),
           case when count(o_totalprice) = count(*) then 'pass' else 'fail' end
    from orders
    union all
    select 'stg_coins_markets', 'unique_combination_of_columns', 'coin_id,fetched_at', count(*),
           case when count(*) = 0 then 'pass' else 'fail' end
    from (select o_orderkey, date_trunc('month', o_orderdate) from orders
          group by all having count(*) > 1)
""")
def dq_staging(spark, sf_dir):
    """The declared tests of a staged view, run on the view."""
    staged = stg_snapshots(decode_snapshots(P.unlanded(P.snapshots(spark, sf_dir))))
    return quality.run_tests(staged, "stg_coins_markets", STAGING_TESTS["stg_coins_markets"])


def _declared_sql(name: str, tests: dict) -> str:
    """The declared tests of a view, on the SQL that gives its rows; columns that no source has are null."""
    source = f"({VIEW_SQL[name]})"
    absent = ("total_market_cap_usd",)
    parts = [
        f"""select '{name}' as "table", 'not_null' as test, '{c}' as "columns",
            {"count(*)" if c in absent else f"count(*) filter (where {c} is null)"} as failures from {source}"""
        for c in tests.get("not_null", [])
    ]
    parts += [
        f"""select '{name}', 'unique_combination_of_columns', '{",".join(key)}', count(*)
            from (select {",".join(key)} from {source} group by all having count(*) > 1)"""
        for key in tests.get("unique_combination", [])
    ]
    return " union all ".join(parts)


@query(
    """select *, case when failures = 0 then 'pass' else 'fail' end as status from ("""
    + " union all ".join(_declared_sql(name, STAGING_TESTS[name]) for name in VIEW_SQL)
    + ")"
)
def dq_views(spark, sf_dir):
    """The declared tests of all four staged views, run on the views registered over one lake."""
    register_lake(spark, sf_dir)
    results = [quality.run_tests(spark.table(name), name, STAGING_TESTS[name]) for name in VIEW_SQL]
    return reduce(DataFrame.unionByName, results)


@query("""
    select id from (
        select c_nationkey as id from customer
        union all select s_nationkey from supplier
        union all select cast(quality as integer) from documents left join labels using (doc_id)
    ) where id = 1
""")
def union_filter(spark, sf_dir):
    """UNION ALL keeps duplicates and nulls; the equality filter drops nulls."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    ids = [
        table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("id")),
        table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("id")),
        labelled.select(F.col("quality").cast("int").alias("id")),
    ]
    return first_rows(reduce(DataFrame.unionByName, ids))
