import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickwell.functions import keys
from tickwell.operators import landing
from tickwell.operators.landing import land_raw, read_batch, read_landed, read_raw
from tickwell.session import create_root

SCHEMA = "kind string, coin_id string, fetched_at timestamp_ntz, payload string"


def at(hour, day=15):
    return datetime(2031, 3, day, hour)


def stored(spark, root):
    rows = read_raw(spark, root).select("kind", "coin_id", "fetched_at", "payload").collect()
    return sorted(tuple(r) for r in rows)


def test_raw_key(spark):
    rows = spark.createDataFrame(
        [("coins/markets",), ("/coins/harbour/market_chart/",)], "prefix string"
    )
    when = F.lit("2031-03-09 16:45:00").cast("timestamp_ntz")
    got = [r[0] for r in rows.select(keys.raw_key(F.col("prefix"), when)).collect()]
    assert got == [
        "raw/coins/markets/date=2031-03-09/fetched_at=2031-03-09T16-45-00Z.json",
        "raw/coins/harbour/market_chart/date=2031-03-09/fetched_at=2031-03-09T16-45-00Z.json",
    ]


def test_raw_key_converts_an_offset_to_utc(spark):
    when = F.lit("2031-03-09T03:00:00+07:00").cast("timestamp")
    key = spark.range(1).select(keys.raw_key(F.lit("global"), when)).first()[0]
    assert key == "raw/global/date=2031-03-08/fetched_at=2031-03-08T20-00-00Z.json"


def test_paths_read_back(spark):
    path = "s3://x/raw/coins/usd-coin/market_chart/date=2031-03-09/fetched_at=2031-03-09T16-45-00Z.json"
    df = spark.createDataFrame([(path,), ("s3://x/raw/global/date=2031-03-09/other.json",)], "p string")
    p = F.col("p")
    good, bad = df.select(
        keys.kind_of(p), keys.coin_of(p), keys.fetched_at_of(p, lenient=True), keys.chart_coin_of(p)
    ).collect()
    assert tuple(good) == ("market_chart", "usd-coin", datetime(2031, 3, 9, 16, 45), "usd-coin")
    assert tuple(bad) == ("global", "", None, "")
    with pytest.raises(Exception):
        df.select(keys.fetched_at_of(p)).collect()


def test_landing_keeps_the_text(spark, root):
    text = '[{"id":"harbour","price":3.75, "tên":"đồng \\u00e9 €"}]'
    df = spark.createDataFrame([("coins_markets", None, at(10), text)], SCHEMA)
    landed = land_raw(df, root)
    assert landed.rows == 1
    assert stored(spark, root) == [("coins_markets", "_all", at(10), text)]


def test_rerun_replaces_its_own_fetches_only(spark, root):
    first = [
        ("market_chart", "a", at(10), "1"),
        ("market_chart", "b", at(10), "1"),
        ("market_chart", "a", at(11), "1"),
        ("global", None, at(10), "1"),
    ]
    land_raw(spark.createDataFrame(first, SCHEMA), root)
    again = spark.createDataFrame([("market_chart", "a", at(10), "2")], SCHEMA)
    for _ in range(2):
        land_raw(again, root)
    assert stored(spark, root) == [
        ("global", "_all", at(10), "1"),
        ("market_chart", "a", at(10), "2"),
        ("market_chart", "a", at(11), "1"),
        ("market_chart", "b", at(10), "1"),
    ]
    land_raw(spark.createDataFrame([("market_chart", "a", at(12), "3")], SCHEMA), root)
    assert len(stored(spark, root)) == 5


def test_rerun_and_new_fetch_in_one_batch(spark, root):
    land_raw(spark.createDataFrame([("global", None, at(1), "1"), ("global", None, at(2), "1")], SCHEMA), root)
    both = [("global", None, at(1), "2"), ("global", None, at(1, day=16), "2")]
    land_raw(spark.createDataFrame(both, SCHEMA), root)
    assert [r[2:] for r in stored(spark, root)] == [(at(1), "2"), (at(2), "1"), (at(1, 16), "2")]


def test_all_parts_of_a_fetch_are_replaced(spark, root):
    schema = SCHEMA + ", part long"
    parts = [("market_chart", "a", at(1), str(i), i) for i in range(3)]
    land_raw(spark.createDataFrame(parts, schema), root)
    land_raw(spark.createDataFrame([("market_chart", "a", at(1), "x", 0)], schema), root)
    assert [r[3] for r in stored(spark, root)] == ["x"]


def test_order_by_settles_versions_inside_a_batch(spark, root):
    schema = SCHEMA + ", version int"
    rows = [("global", None, at(1), "old", 1), ("global", None, at(1), "new", 2)]
    land_raw(spark.createDataFrame(rows, schema), root, order_by="version")
    assert [r[3] for r in stored(spark, root)] == ["new"]


def test_batch_reads_back_exactly_its_rows(spark, root):
    land_raw(spark.createDataFrame([("global", None, at(1), "1")], SCHEMA), root)
    landed = land_raw(spark.createDataFrame([("global", None, at(2), "2")], SCHEMA), root)
    assert [r.payload for r in read_batch(spark, landed).collect()] == ["2"]
    assert read_batch(spark, land_raw(spark.createDataFrame([], SCHEMA), root)).count() == 0


def test_keyed_read_back(spark, root):
    rows = [("market_chart", c, at(h), f"{c}{h}") for c in "abc" for h in (1, 2)]
    land_raw(spark.createDataFrame(rows, SCHEMA), root)
    wanted = spark.createDataFrame(
        [("market_chart", "a", at(2)), ("market_chart", "c", at(1)), ("market_chart", "z", at(1))],
        "kind string, coin_id string, fetched_at timestamp_ntz",
    )
    assert sorted(r.payload for r in read_landed(spark, root, wanted).collect()) == ["a2", "c1"]


def test_missing_root_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("global", None, at(1), "1")], SCHEMA)
    with pytest.raises(FileNotFoundError):
        land_raw(df, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError):
        land_raw(df, "")
    with pytest.raises(ValueError):
        create_root(spark, "")


def test_odd_coin_ids_survive(spark, root):
    rows = [("market_chart", c, at(1), c) for c in ("1", "007", "a/b", "x y", "đồng", "k=v")]
    land_raw(spark.createDataFrame(rows, SCHEMA), root)
    assert all(r[1] == r[3] for r in stored(spark, root)) and len(stored(spark, root)) == 6


def test_runs_keep_each_others_data(spark, root, monkeypatch):
    """A run that lands another fetch of the same day between the steps of a rerun loses nothing."""
    land_raw(spark.createDataFrame([("market_chart", "a", at(1), "1")], SCHEMA), root)
    note, between = landing._note_replaced, spark.createDataFrame([("market_chart", "b", at(1), "b")], SCHEMA)

    def interrupted(session, landed):
        monkeypatch.setattr(landing, "_note_replaced", note)
        land_raw(between, root)
        note(session, landed)

    monkeypatch.setattr(landing, "_note_replaced", interrupted)
    land_raw(spark.createDataFrame([("market_chart", "a", at(1), "2")], SCHEMA), root)
    assert [r[3] for r in stored(spark, root)] == ["2", "b"]
    assert landing.read_versions(spark, root).count() == 3
    day = at(1).date()
    reader = read_raw(spark, root).select("payload")  # its files stay while it reads
    landing.compact(spark, root, (day, day))
    assert landing.read_versions(spark, root).count() == 5
    assert sorted(r[0] for r in reader.collect()) == ["2", "b"]
    assert [r[3] for r in stored(spark, root)] == ["2", "b"]
    assert landing.vacuum(spark, root) == 3
    assert landing.read_versions(spark, root).count() == 2
    land_raw(spark.createDataFrame([("market_chart", "b", at(1), "3")], SCHEMA), root)
    assert [r[3] for r in stored(spark, root)] == ["2", "3"]


def test_a_doubled_fetch_is_refused(spark, root):
    rows = [("global", None, at(1), "x"), ("global", None, at(1), "y")]
    with pytest.raises(ValueError):
        land_raw(spark.createDataFrame(rows, SCHEMA), root)
    assert stored(spark, root) == [] and not os.path.exists(f"{root}/runs")
    assert not [f for _, _, files in os.walk(f"{root}/raw") for f in files if f.startswith("part-")]


@pytest.mark.parametrize("step", ["_complete", "_note_replaced", "_mark"])
def test_a_run_lost_on_the_way_changes_nothing(spark, root, monkeypatch, step):
    rows = [("market_chart", c, at(1), "1") for c in "ab"]
    land_raw(spark.createDataFrame(rows, SCHEMA), root)

    def lost(*_):
        raise RuntimeError("lost")

    again = spark.createDataFrame([("market_chart", "a", at(1), "2"), ("market_chart", "c", at(2), "2")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(landing, step, lost)
        with pytest.raises(RuntimeError):
            land_raw(again, root)
    assert stored(spark, root) == sorted((*r[:1], *r[1:]) for r in rows)
    land_raw(again, root)
    assert [r[3] for r in stored(spark, root)] == ["2", "1", "2"]


def test_the_input_is_computed_once(spark, root):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([("global", None, at(h), "x") for h in range(9)], SCHEMA)
    land_raw(rows.mapInArrow(passed, SCHEMA), root)
    assert seen.value == 9


def test_a_late_record_reads_its_own_days_only(spark, root, monkeypatch):
    land_raw(spark.createDataFrame([("global", None, at(1, day=d), "1") for d in range(1, 29)], SCHEMA), root)
    opened = []
    read = landing._read_folders
    monkeypatch.setattr(landing, "_read_folders", lambda s, r, folders: (opened.append(folders), read(s, r, folders))[1])
    land_raw(spark.createDataFrame([("global", None, at(1, day=d), "2") for d in (2, 27)], SCHEMA), root)
    assert [len(folders) for folders in opened] == [2, 2]
    assert sorted(r[2].day for r in stored(spark, root) if r[3] == "2") == [2, 27]
