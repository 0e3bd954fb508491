import os

import pytest

import __spark_entry__ as entry_points
import oracle

from tickwell.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 or con.execute(f"select count(*) from ({SQL[name]})").fetchone()[0] == 0
    assert oracle.compare(df, con, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_in_the_jvm_without_cross_joins(spark, name):
    if name in ("stream_ingest", "stream_rerun", "stream_latest_points"):
        pytest.skip("reads a finished table")
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pruning(spark, root):
    from datetime import datetime

    from tickwell.operators.landing import land_raw
    from tickwell.sources.scans import scan_charts

    rows = [("market_chart", "a", datetime(2024, 1, d), "{}") for d in (1, 2)]
    land_raw(spark.createDataFrame(rows, "kind string, coin_id string, fetched_at timestamp_ntz, payload string"), root)
    plan = _plan(scan_charts(spark, root, "landed", dates=["2024-01-01"]))
    assert "PartitionFilters: [isnotnull(kind" in plan and "date#" in plan.split("PartitionFilters")[1][:200]
    last = _plan(QUERIES["last_seven_days"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-25T00:00)" in last
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in last


def test_payload_is_parsed_once(spark):
    plan = _plan(QUERIES["snapshot_summary"](spark, SF))
    assert plan.count("parseJson") == 2 and plan.count("octet_length") > 0  # the second one for documents beyond VARIANT
    # One decode as doubles, and one as text that runs only where doubles leave a hole.
    points = _plan(QUERIES["chart_volumes"](spark, SF))
    assert points.count("from_json") == 2 and "- Filter" not in points


def test_contracts_need_no_shuffle(spark, root):
    from tickwell.operators.contracts import conform, validate
    from tickwell.operators.landing import land_raw, read_batch
    from tickwell.queries import payloads

    landed = land_raw(payloads.charts(spark, SF), root)
    checked = validate(read_batch(spark, landed), "market_chart")
    assert "Exchange" not in _plan(checked) and "Exchange" not in _plan(conform(checked, "market_chart"))


def test_consolidation_combines_before_the_shuffle(spark):
    plan = _plan(QUERIES["latest_points"](spark, SF))
    assert "partial_max_by" in plan and "SortAggregate" not in plan
    for name in ("hourly_fact", "top_movers", "top_per_group"):
        plan = _plan(QUERIES[name](spark, SF))
        assert plan.index("Final") < plan.index("Partial") and "WindowGroupLimit" in plan


def test_grouping_by_the_bucket_key_needs_no_shuffle(spark):
    assert "Exchange" not in _plan(QUERIES["bucketed_layer"](spark, SF))


def test_several_keys_are_tested_in_one_scan(spark):
    plan = _plan(QUERIES["dq_unique"](spark, SF))
    assert plan.count("events.parquet") == 1 and "Expand" in plan


@pytest.mark.parametrize("name", ["metadata_objects", "charts_objects"])
def test_folders_of_coins_are_pruned(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "PartitionFilters: [isnotnull(date" in plan


@pytest.mark.parametrize("folder", ["coins/{id}/market_chart", "coins_metadata/{id}"])
def test_objects_of_coins_lie_under_their_keys_and_nothing_beside_them(spark, root, folder):
    from tickwell.queries import reruns

    at = "timestamp_ntz'2024-02-01 03:00:00' as fetched_at"
    documents = spark.range(40).selectExpr("cast(id as string) as coin_id", at, """concat('{"id":"', id, '"}') as payload""")
    reruns._store_by_coin(documents, root, folder)
    places, files = set(), []
    for place, _, names in os.walk(f"{root}/raw"):
        kept = [name for name in names if name.endswith(".txt")]
        places |= {os.path.relpath(place, f"{root}/raw") for _ in kept}
        files += names
    key = "date=2024-02-01/fetched_at=2024-02-01T03-00-00Z.json"
    assert places == {f"{folder.replace('{id}', str(coin))}/{key}" for coin in range(40)}
    assert len(files) == 40  # a checksum file beside each costs as much as the object


def test_reported_files_have_nothing_beside_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tickwell.queries.checked.scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    QUERIES["files_report"](spark, SF)
    names = [name for _, _, found in os.walk(tmp_path) for name in found]
    assert sum(name.endswith(".txt") for name in names) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert not [name for name in names if name.startswith(".part-")]
