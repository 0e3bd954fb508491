import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickwell.functions.scalars import drop_empty, item, json_first, json_text, to_bigint, upper_ticker
from tickwell.operators.landing import land_raw
from tickwell.operators.staging import stg_chart_points, stg_global, stg_metadata, stg_snapshots
from tickwell.plans.layers import register_views
from tickwell.sources import objects
from tickwell.sources.scans import scan_charts, scan_global, scan_metadata, scan_snapshots

AT = datetime(2031, 3, 9, 16, 45)
SNAPSHOT = [
    {"id": "harbour", "symbol": "hbr", "name": "Harbour Token", "current_price": 41.5, "market_cap_rank": 1.0,
     "total_volume": "5.5", "max_supply": None, "last_updated": "2031-03-09T00:00:00.000Z", "ath": 1},
    {"id": "lantern", "symbol": "ltn", "name": "Lantern", "current_price": None,
     "last_updated": "2031-03-09T01:00:00Z"},
]
METADATA = {
    "id": "harbour", "symbol": "hbr", "name": "Harbour Token", "categories": ["x", None], "platforms": {"": ""},
    "description": {"en": "Đào, \"coin\""}, "links": {"homepage": ["", "u"], "blockchain_site": []},
    "market_cap_rank": 1, "genesis_date": "2019-05-17", "last_updated": "2031-03-09T00:00:00Z", "odd": 1,
}
GLOBAL = {"data": {"active_cryptocurrencies": 10, "markets": 8, "total_market_cap": {"usd": 2.5, "eur": 2},
                   "total_volume": {"eur": 1}, "market_cap_percentage": {"btc": 55}}}
CHART = {"prices": [[1930000000000, 5], [1.7, "6.5"], [2.5, 7.0]], "market_caps": [], "total_volumes": None}


def fill(put):
    put("coins/markets", "2031-03-09T16:45:00", json.dumps(SNAPSHOT, indent=2))
    put("coins_metadata/hbr-folder", "2031-03-09T16:45:00", json.dumps(METADATA, ensure_ascii=False))
    put("global", "2031-03-09T16:45:00", json.dumps(GLOBAL))
    put("global", "2031-03-10T00:00:00", json.dumps([GLOBAL, GLOBAL]))
    for coin in ("harbour", "quay-coin"):
        for at in ("2031-03-09T16:45:00", "2031-03-10T00:00:00"):
            put(f"coins/{coin}/market_chart", at, json.dumps(CHART))


def test_views_over_objects(spark, root, put):
    fill(put)
    snap = [tuple(r) for r in stg_snapshots(scan_snapshots(spark, root)).collect()]
    assert [r[:5] for r in snap] == [
        ("harbour", "hbr", "Harbour Token", 41.5, None), ("lantern", "ltn", "Lantern", None, None)]
    assert snap[0][5:7] == (1, 5.5)
    assert snap[0][14:] == (datetime(2031, 3, 9), date(2031, 3, 9), AT)

    meta = stg_metadata(scan_metadata(spark, root)).first().asDict()
    assert meta == {
        "coin_id": "harbour", "symbol": "hbr", "name": "Harbour Token", "categories": '["x",null]',
        "platforms": '{"":""}', "description_en": "Đào, \"coin\"", "homepage_url": "",
        "block_explorer_url": None, "genesis_date": "2019-05-17", "market_cap_rank": 1,
        "api_last_updated": "2031-03-09T00:00:00Z", "snapshot_date": date(2031, 3, 9), "fetched_at": AT}

    world = sorted(tuple(r) for r in stg_global(scan_global(spark, root)).collect())
    assert len(world) == 3 and world[0] == (10, 2.5, 8, None, 55.0, date(2031, 3, 9), AT)

    points = stg_chart_points(scan_charts(spark, root))
    assert dict(points.dtypes) == {"coin_id": "string", "fetched_at": "timestamp_ntz",
                                   "snapshot_date": "date", "ts_ms": "bigint", "price_usd": "double"}
    got = sorted(tuple(r) for r in points.collect())
    assert len(got) == 12 and {(r[0], r[2]) for r in got} == {
        (c, date(2031, 3, d)) for c in ("harbour", "quay-coin") for d in (9, 10)}
    assert {r[3:] for r in got} == {(2, 6.5), (2, 7.0), (1930000000000, 5.0)}
    assert stg_chart_points(scan_charts(spark, root), "total_volumes").count() == 0
    assert scan_charts(spark, root, dates=["2031-03-10"]).count() == 2


def test_both_layouts_agree(spark, root, put, tmp_path):
    fill(put)
    landing = str(tmp_path / "landing")
    (tmp_path / "landing").mkdir()
    land_raw(objects.payloads_from_objects(spark, root), landing)
    for scan, stage in (
        (scan_snapshots, stg_snapshots), (scan_metadata, stg_metadata),
        (scan_global, stg_global), (scan_charts, stg_chart_points),
    ):
        a = sorted(map(str, stage(scan(spark, root)).collect()))
        b = sorted(map(str, stage(scan(spark, landing, "landed")).collect()))
        assert a == b and a


def test_registered_views(spark, root, put):
    fill(put)
    names = register_views(spark, root)
    assert set(names) >= {"stg_coins_markets", "stg_coin_metadata", "stg_global", "stg_market_chart"}
    assert spark.sql("select count(*) from stg_market_chart where price_usd > 6").first()[0] == 8
    assert [r.id for r in spark.sql("select id from my_first_dbt_model").collect()] == [1, None]
    assert [r.id for r in spark.sql("select id from my_second_dbt_model").collect()] == [1]


def test_file_without_fetch_time(spark, root, put):
    put("global", "2031-03-09T16:45:00", json.dumps(GLOBAL))
    with open(f"{root}/raw/global/date=2031-03-09/fetched_at=unknown.json", "w") as f:
        f.write(json.dumps(GLOBAL))
    assert stg_global(scan_global(spark, root, lenient=True), lenient=True).filter(
        "fetched_at is null").count() == 1
    with pytest.raises(Exception):
        stg_global(scan_global(spark, root)).collect()


def test_broken_payload_is_loud_unless_lenient(spark, root, put):
    put("coins/a/market_chart", "2031-03-09T16:45:00", '{"prices": [[1,')
    with pytest.raises(Exception):
        stg_chart_points(scan_charts(spark, root)).collect()
    assert stg_chart_points(scan_charts(spark, root), lenient=True).count() == 0


def test_provenance_and_crawl(spark, root, put):
    fill(put)
    docs = objects.scan_documents(spark, f"{root}/raw/coins_metadata").collect()
    assert [(d.coin, d.file) for d in docs] == [("hbr-folder", "fetched_at=2031-03-09T16-45-00Z.json")]
    assert json.loads(docs[0].payload) == METADATA
    names = sorted(r.filename for r in objects.object_global(spark, root, ["2031-03-09"]).collect())
    assert len(names) == 1 and names[0].endswith("raw/global/date=2031-03-09/fetched_at=2031-03-09T16-45-00Z.json")


def test_scalars(spark):
    row = spark.range(1).select(
        *[to_bigint(F.lit(x)).alias(f"r{i}") for i, x in enumerate((1.7, 2.5, 3.5, -2.5))],
        item(F.array(F.lit(1), F.lit(2)), 2).alias("second"),
        item(F.array(F.lit(1), F.lit(2)), 3).alias("beyond"),
        json_text(F.lit('{"a":null,"b":{"c":1},"d":true}'), "a").alias("null_text"),
        json_text(F.lit('{"a":null,"b":{"c":1},"d":true}'), "b").alias("object_text"),
        json_text(F.lit('{"a":null,"b":{"c":1},"d":true}'), "d").alias("true_text"),
        json_first(F.lit('{"h":[]}'), "h").alias("none"),
        json_first(F.lit('{"h":["","x"]}'), "h").alias("empty"),
        drop_empty(F.array(F.lit(""), F.lit("u"), F.lit(None).cast("string"))).alias("cleaned"),
        drop_empty(F.lit(None).cast("array<string>")).alias("no_list"),
        upper_ticker(F.lit("btc")).alias("ticker"),
    ).first()
    assert tuple(row) == (2, 2, 4, -2, 2, None, None, '{"c":1}', "true", None, "", ["u"], [], "BTC")
