import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickwell.operators import consolidate, quality
from tickwell.operators.landing import land_raw, read_raw
from tickwell.operators.staging import ohlc_rows, stg_chart_points
from tickwell.plans import layers, loads, marts
from tickwell.operators.contracts import ContractError
from tickwell.schemas import STAGING_TESTS
from tickwell.sources import scans
from tickwell.sources import watchlist as W
from tickwell.sources.requests import request_charts, with_parts
from tickwell.sources.scans import scan_charts, scan_ohlc
from tickwell.streaming.ingest import ingest_objects, stream_objects, stream_points


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_shuffles_grow_with_the_input(spark):
    from tickwell.session import bytes_below, size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, bytes_below(spark, "/root/testdata/sf0.001")) == int(before)
        assert size_shuffles(spark, 2 * 1024**4) == 8192
        assert size_shuffles(spark, 1000) == 8192
        assert size_shuffles(spark, 100 * 1024**4) == 409_600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# -------------------------------------------------------------------- data tests


def test_data_tests(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 1), ("b", None), ("b", None), (None, 2), (None, 3)], "k string, v int"
    )
    tests = {"not_null": ["k", "v"], "unique": ["k"], "unique_combination": [["k", "v"]]}
    assert rows(quality.run_tests(df, "t", tests), "test", "columns") == [
        ("t", "not_null", "k", 2, "fail"), ("t", "not_null", "v", 2, "fail"),
        ("t", "unique", "k", 2, "fail"), ("t", "unique_combination_of_columns", "k,v", 2, "fail"),
    ]


def test_example_models(spark):
    first = layers.literal_rows(spark)
    second = layers.first_rows(first)
    assert rows(quality.run_tests(first, "m1", STAGING_TESTS["my_first_dbt_model"]), "test") == [
        ("m1", "not_null", "id", 1, "fail"), ("m1", "unique", "id", 0, "pass")]
    assert {r[4] for r in rows(quality.run_tests(second, "m2", STAGING_TESTS["my_second_dbt_model"]))} == {"pass"}


def test_duplicate_snapshot_rows_are_found(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 1.0), ("b", 1, None)], "coin_id string, fetched_at int, current_price double")
    got = rows(quality.run_tests(df, "s", STAGING_TESTS["stg_coins_markets"]), "test", "columns")
    assert [(r[2], r[3]) for r in got] == [("coin_id", 0), ("current_price", 1), ("fetched_at", 0), ("coin_id,fetched_at", 1)]


# ----------------------------------------------------------------- consolidation


def test_latest_by_with_a_hot_key(spark):
    """One key holds a third of the rows; before the shuffle each task keeps one of them."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    latest = consolidate.latest_by(df, ["k"], ["at"])
    assert latest.count() == 20_001 and latest.filter("k = -1").first()["at"] == 29_997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_last_n_days(spark):
    df = spark.range(10).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id)").alias("ts"))
    as_of = datetime(2024, 1, 8)
    assert consolidate.last_n_days(df, "ts", as_of, 3).count() == 4
    assert consolidate.last_n_days(df, "ts", as_of, None).count() == 10


def test_top_by(spark):
    df = spark.createDataFrame([("x", 1, 5.0), ("x", 2, None), ("x", 3, 5.0), ("y", 4, 1.0)], "g string, id int, v double")
    assert [r[1] for r in rows(consolidate.top_by(df, "v", 3))] == [1, 3, 4]
    per = rows(consolidate.top_by(df, "v", 2, per=["g"]), "g", "rank")
    assert [(r[0], r[1], r[3]) for r in per] == [("x", 1, 1), ("x", 3, 2), ("y", 4, 1)]


def test_restrict_small_and_large_lists_agree(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("coin"))
    watch = spark.range(0, 1000, 7).select(F.col("id").cast("string"))
    small = consolidate.restrict_to(df, watch, "coin")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = rows(consolidate.restrict_to(df, watch, "coin"), "coin")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(small, "coin") == large and small.count() == 143


def test_lag_by_day_equals_a_plain_window(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).cast("string").alias("s"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id * 5 + id % 7)").alias("ts"),
        (F.col("id") * 1.5).alias("v"),
    ).filter("day(ts) not in (3, 4)")
    got = consolidate.lag_by_day(df, ["s"], "ts", ["v"])
    df.createOrReplaceTempView("lagged")
    plain = spark.sql("select s, ts, v, lag(v) over (partition by s order by ts) as prev_v from lagged")
    assert rows(got, "s", "ts") == rows(plain, "s", "ts")
    whole = consolidate.lag_by_day(df, [], "ts", ["v"])
    assert whole.filter("prev_v is null").count() == 1 and whole.count() == df.count()


# -------------------------------------------------------------------- watch list


def test_watch_lists(spark, tmp_path):
    ids = [c[0] for c in W.DEFAULT_COINS]
    default = W.default_watchlist(spark)
    assert rows(consolidate.ids_string(default)) == [(0, ",".join(ids))]
    assert rows(consolidate.ids_string(default, page_size=4), "page")[2] == (2, "cardano,shiba-inu")

    entries = [{"id": "b", "symbol": "x"}, "text", {"name": "no id"}, {"id": "a"}, 5, None]
    path = tmp_path / "coins.json"
    path.write_text(json.dumps({"coins": entries}, indent=2))
    assert [r.id for r in W.watchlist_json(spark, str(path)).orderBy("position").collect()] == ["b", "a"]
    path.write_text("{}")
    assert W.watchlist_json(spark, str(path)).count() == 0

    yaml = pytest.importorskip("yaml")
    path = tmp_path / "coins.yaml"
    path.write_text(yaml.safe_dump({"coins": entries}))
    assert [r.id for r in W.watchlist_yaml(spark, str(path)).orderBy("position").collect()] == ["b", "a"]
    path.write_text("")
    assert W.watchlist_yaml(spark, str(path)).count() == 0
    assert W.watchlist(spark.createDataFrame([("a",), (None,)], "id string")).count() == 1


# ------------------------------------------------------------------------- loads


def points(spark, n=60):
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 3).alias("coin"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id)").alias("ts"), F.col("id").cast("double").alias("v"),
    )


def values():
    return {name: F.col("v") for name in ("prices", "market_caps", "total_volumes")}


def test_backfill_then_incremental(spark, root):
    df = points(spark)
    as_of = datetime(2024, 3, 1)
    summary = loads.load_charts(df, root, as_of, None, "coin", "ts", "id", values())
    assert [(r[1], r[2]) for r in rows(summary, "s3_key")] == [(20, "valid")] * 3
    later = datetime(2024, 3, 2)
    changed = df.withColumn("v", F.col("v") + 1000)
    loads.load_charts(changed, root, later, 7, "coin", "ts", "id", values())
    staged = stg_chart_points(scan_charts(spark, root, "landed"))
    in_window = df.filter(F.col("ts") >= datetime(2024, 2, 24)).count()
    assert staged.count() == 60 + in_window  # the staged view keeps both fetches
    latest = marts.latest_points(staged)
    assert latest.count() == 60
    assert latest.filter("price_usd >= 1000").count() == in_window


def test_load_keeps_an_invalid_payload_and_raises(spark, root):
    bad = spark.createDataFrame(
        [("global", datetime(2024, 1, 1), '{"data":null}'), ("global", datetime(2024, 1, 2), '{"data":{}}')],
        "kind string, fetched_at timestamp_ntz, payload string",
    )
    with pytest.raises(ContractError):
        loads.load(bad, root, "global")
    assert read_raw(spark, root).count() == 2
    assert sorted(r.status for r in loads.load(bad, root, "global", strict=False).collect()) == ["invalid", "valid"]
    assert read_raw(spark, root).count() == 2
    checked = loads.validate_stored(spark, root, bad.select("kind", "fetched_at").filter("fetched_at < '2024-01-02'"), "global")
    assert [r.status for r in checked.collect()] == ["invalid"]


def test_long_charts_come_in_parts(spark, monkeypatch):
    from tickwell.sources import requests

    monkeypatch.setattr(requests, "CHART_PART", 16)
    df = points(spark).withColumn("coin", F.lit(1))
    payloads = request_charts(df, "coin", "ts", "id", values(), datetime(2024, 3, 1))
    assert payloads.count() == 4
    lengths = [len(json.loads(p.payload)["prices"]) for p in payloads.collect()]
    assert max(lengths) == 16 and sum(lengths) == 60


# ------------------------------------------------------------------------- marts


def test_marts_on_small_tables(spark):
    snap = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 0, 10), 1.0), ("a", datetime(2024, 1, 1, 0, 50), 2.0), ("a", datetime(2024, 1, 1, 1), 3.0)],
        "coin_id string, fetched_at timestamp_ntz, current_price double")
    assert [(r["hour"].hour, r["current_price"]) for r in marts.hourly_fact(snap).orderBy("hour").collect()] == [(0, 2.0), (1, 3.0)]

    pts = spark.createDataFrame([("a", 1000, 5.0), ("a", 2000, 9.0), ("a", 3000, 1.0), ("a", 90_000_000, 4.0)], "coin_id string, ts_ms long, price_usd double")
    assert rows(marts.daily_ohlc(pts), "day") == [
        ("a", date(1970, 1, 1), 5.0, 9.0, 1.0, 1.0, 3), ("a", date(1970, 1, 2), 4.0, 4.0, 4.0, 4.0, 1)]

    daily = spark.createDataFrame([("a", date(2024, 1, 1), 10.0), ("a", date(2024, 1, 2), 11.0), ("a", date(2024, 1, 4), 22.0)], "coin_id string, day date, close double")
    perf = marts.performance(daily, horizons=(1, 2)).orderBy("day").collect()
    assert [round(p.return_1d, 9) if p.return_1d is not None else None for p in perf] == [None, 0.1, None]
    assert [p.return_2d for p in perf] == [None, None, 1.0]
    assert [round(p.moving_average, 6) for p in perf] == [10.0, 10.5, 14.333333]


def test_coin_dim(spark):
    meta = spark.createDataFrame(
        [("a", '{"en":"old"}', None, "2009-01-03", datetime(2024, 1, 1), "f1"),
         ("a", '{"en":"new"}', '{"homepage":["","u"]}', "unknown", datetime(2024, 1, 2), "f2"),
         ("z", "{}", None, None, datetime(2024, 1, 2), "f3")],
        "id string, description string, links string, genesis_date string, fetched_at timestamp_ntz, filename string")
    watch = spark.createDataFrame([(0, "a", "A"), (1, "b", "B")], "position int, id string, name string")
    got = rows(marts.coin_dim(meta, watch).select("coin_id", "description_en", "homepages", "block_explorers", "genesis_date"), "coin_id")
    assert got == [("a", "new", ["u"], [], None), ("b", None, None, None, None)]


def test_bridge_long_and_candles(spark):
    meta = spark.createDataFrame([("a", {"": "", "solana": None, "ethereum": "0x", "x": ""})], "coin_id string, platforms map<string,string>")
    assert rows(marts.chain_bridge(meta, "coin_id")) == [("a", "ethereum", "0x")]
    data = spark.createDataFrame([(1, {"usd": 1.0, "eur": 2.0})], "fetched_at int, total_market_cap map<string,double>")
    assert rows(marts.currency_long(data, "fetched_at"), "currency") == [(1, "eur", 2.0), (1, "usd", 1.0)]
    candles = scan_ohlc(spark.createDataFrame([("a", "[[1700000000000,5,6,4,5.5]]"), ("b", "[]")], "coin_id string, payload string"))
    assert rows(ohlc_rows(candles, "coin_id")) == [("a", 1700000000000, 5.0, 6.0, 4.0, 5.5)]


def test_aligned_series(spark):
    payload = json.dumps({"prices": [[1, 5], [2, 6]], "market_caps": [[2, 60]], "total_volumes": [[3, 7]]})
    charts = spark.createDataFrame([("a", 1, payload), ("b", 1, '{"prices":null}')], "coin_id string, fetched_at int, payload string")
    assert rows(marts.aligned_series(charts), "ts_ms") == [
        ("a", 1, 1, 5.0, None, None), ("a", 1, 2, 6.0, 60.0, None), ("a", 1, 3, None, None, 7.0)]


def test_tables_and_layers(spark, root):
    path = layers.layer_path(root, "marts", "daily")
    assert path == f"{root}/marts/daily"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    for _ in range(2):
        layers.write_table(df, path, ["p"])
    assert rows(spark.read.parquet(path).select("v", "p"), "v") == [(1, "a"), (2, "b")]
    layers.write_table(df, layers.layer_path(root, "core", "plain"))
    assert spark.read.parquet(f"{root}/core/plain").count() == 2


# ------------------------------------------------------------------------- streams


def test_streams(spark, root, put, tmp_path):
    chart = json.dumps({"prices": [[1, 2], [3, 4]], "market_caps": [], "total_volumes": []}, indent=1)
    put("coins/a/market_chart", "2024-01-01T00:00:00", chart)
    put("global", "2024-01-01T00:00:00", '{"data":{}}')
    lake, out = tmp_path / "landed", str(tmp_path / "points")
    lake.mkdir()

    def run():
        stream_objects(spark, root, str(lake), str(tmp_path / "c1"), bytes_per_trigger=1)
        stream_points(spark, str(lake), out, str(tmp_path / "c2"))
        return spark.read.parquet(out).count(), read_raw(spark, str(lake)).count()

    assert run() == (2, 2)
    assert run() == (2, 2)  # nothing new, nothing repeated
    put("coins/b/market_chart", "2024-01-02T00:00:00", chart)
    assert run() == (4, 3)
    # Landing the same documents again in one batch changes nothing.
    from tickwell.sources.objects import payloads_from_objects

    land_raw(payloads_from_objects(spark, root), str(lake))
    assert read_raw(spark, str(lake)).count() == 3


def test_objects_old_and_replaced_are_ingested(spark, root, put, tmp_path):
    lake = tmp_path / "landed"
    lake.mkdir()
    first = put("coins/a/market_chart", "2024-01-01T00:00:00", "1")
    assert ingest_objects(spark, root, str(lake)).rows == 1
    assert ingest_objects(spark, root, str(lake)) is None
    old = put("global", "2024-01-03T00:00:00", "old")
    os.utime(old, (1e9, 1e9))  # restored from a backup: decades older than what was seen
    put("coins/a/market_chart", "2024-01-01T00:00:00", "2")
    os.utime(first, (2e9, 2e9))
    assert ingest_objects(spark, root, str(lake)).rows == 2
    assert sorted(r.payload for r in read_raw(spark, str(lake)).collect()) == ["2", "old"]


def store_fetch(root, coin, at, texts):
    """A fetch as a folder of files, its parts."""
    folder = f"{root}/raw/coins/{coin}/market_chart/date={at}/fetched_at={at}T00-00-00Z.json"
    os.makedirs(folder, exist_ok=True)
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    return folder


def test_a_fetch_of_several_files_is_replaced_whole(spark, root, tmp_path):
    lake = str(tmp_path / "landed")
    os.mkdir(lake)
    folder = store_fetch(root, "a", "2024-01-01", {"part-0": "1", "part-1": "2", "part-2": "3"})
    store_fetch(root, "b", "2024-01-01", {"part-0": "b"})

    def read():
        return sorted((r.coin_id, r.part, r.payload) for r in read_raw(spark, lake).collect())

    assert ingest_objects(spark, root, lake).rows == 4
    assert read() == [("a", 0, "1"), ("a", 1, "2"), ("a", 2, "3"), ("b", 0, "b")]
    with open(f"{folder}/part-1", "w") as f:
        f.write("two")
    os.utime(f"{folder}/part-1", (2e9, 2e9))
    assert ingest_objects(spark, root, lake).rows == 3
    assert read() == [("a", 0, "1"), ("a", 1, "two"), ("a", 2, "3"), ("b", 0, "b")]
    os.remove(f"{folder}/part-0")  # three files become two
    assert ingest_objects(spark, root, lake).rows == 2
    assert read() == [("a", 0, "two"), ("a", 1, "3"), ("b", 0, "b")]
    assert ingest_objects(spark, root, lake) is None
    store_fetch(root, "a", "2024-01-01", {"part-0": "1"})  # as it was at first, but for the times
    assert ingest_objects(spark, root, lake).rows == 3


def test_one_new_object_opens_one_folder(spark, root, put, tmp_path, monkeypatch):
    from tickwell.streaming import ingest

    lake = str(tmp_path / "landed")
    os.mkdir(lake)
    for i in range(1000):
        put(f"coins/c{i % 50}/market_chart", f"2024-01-{i // 50 + 1:02}T00:00:00", "{}")
    assert ingest_objects(spark, root, lake).rows == 1000
    put("coins/c7/market_chart", "2024-01-05T06:00:00", '{"new":1}')
    opened = []
    read = ingest.payloads_from_objects
    monkeypatch.setattr(ingest, "payloads_from_objects", lambda s, r, p, folders: (opened.extend(folders), read(s, r, p, folders))[1])
    assert ingest_objects(spark, root, lake).rows == 1
    assert [f.split("/raw/")[1] for f in opened] == ["coins/c7/market_chart/date=2024-01-05"]
    plan = read(spark, root, None, opened)._jdf.queryExecution().executedPlan().toString()
    assert "Location: InMemoryFileIndex(1 paths)" in plan


def test_very_many_changed_folders_are_read_by_days(spark, root, put, tmp_path, monkeypatch):
    from tickwell.streaming import ingest

    monkeypatch.setattr(ingest, "FOLDERS", 2)
    lake = str(tmp_path / "landed")
    os.mkdir(lake)
    for coin in "abcd":
        put(f"coins/{coin}/market_chart", "2024-01-01T00:00:00", coin)
    put("global", "2024-01-02T00:00:00", "g")
    assert ingest_objects(spark, root, lake).rows == 5
    put("coins/a/market_chart", "2024-01-01T05:00:00", "a2")
    assert ingest_objects(spark, root, lake).rows == 1
    assert sorted(r.payload for r in read_raw(spark, lake).collect()) == ["a", "a2", "b", "c", "d", "g"]


def test_object_scans_prune_dates(spark, root, put):
    for day in ("01", "02"):
        put("global", f"2024-01-{day}T00:00:00", '{"data":{"markets":1}}')
    scan = scans.scan_global(spark, root)
    plan = scan.filter("date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert scan.filter("date = date'2024-01-02'").count() == 1


def test_declared_tests_read_a_table_once(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3), (None, 4)], "a int, b int")
    tests = quality.run_tests(df.repartition(2), "t", {"not_null": ["a", "b"], "unique": ["a"]})
    assert tests._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    found = {(r.test, r.columns): r.failures for r in tests.collect()}
    assert found == {("not_null", "a"): 2, ("not_null", "b"): 1, ("unique", "a"): 1}


def test_parts_of_a_list_follow_its_items_not_their_ids(spark):
    ids = spark.range(4000).select((F.col("id") * 37).alias("id"), F.lit("2024-01-01").alias("at"))
    ids = ids.unionByName(spark.sql("select 5 as id, cast(null as string) as at"))
    parted = with_parts(ids, F.col("at").cast("timestamp_ntz"), F.col("id"), 256)
    sizes = [r["count"] for r in parted.groupBy("fetched_at", "part").count().collect()]
    assert sum(sizes) == 4001 and max(sizes) <= 256 and len(sizes) <= 4000 // 128 + 2
