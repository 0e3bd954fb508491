"""Documents stored as files: by the tasks themselves on a local disk, by Spark's writer elsewhere, with the same outcome."""

import os

import pytest

from tickwell.queries import payloads, reruns
from tickwell.session import create_root
from tickwell.sources import store

DOCUMENTS = [
    ("a", '{"id":"a"}'), ("a", '{"id":"a"}'), ("a", "second"), (None, "no coin"), ("", "empty coin"), ("b", None),
    ("x/y", "slash"), ("k=v", "equals"), ("50% off {a}", "é"), ("tab\t:'\"", "signs"), ("c", ""), ("d", "two\nlines"),
]


def _documents(spark):
    rows = spark.createDataFrame(DOCUMENTS, "coin_id string, payload string")
    return rows.selectExpr("coin_id", "timestamp_ntz'2024-02-01 03:00:00' as fetched_at", "payload")


def _files(root):
    found = []
    for place, _, names in os.walk(root):
        for name in names:
            with open(f"{place}/{name}", encoding="utf-8", newline="") as f:
                found.append((os.path.relpath(place, root), f.read()))
    return sorted(found)


def _refuse(*_):
    raise AssertionError("Hadoop starts processes for each file it makes on a local disk")


@pytest.mark.parametrize("folder", ["coins/{id}/market_chart", "coins_metadata/{id}"])
def test_tasks_store_what_the_writer_would_where_it_would(spark, tmp_path, monkeypatch, folder):
    ours, others = (create_root(spark, str(tmp_path / name)) for name in ("ours", "others"))
    with monkeypatch.context() as patched:
        patched.setattr(payloads, "objects_writer", _refuse)
        reruns._store_by_coin(_documents(spark), ours, folder)
    monkeypatch.setattr(reruns, "local_path", lambda *_: None)
    reruns._store_by_coin(_documents(spark), others, folder)
    assert len(_files(ours)) == len(DOCUMENTS) and _files(ours) == _files(others)


def test_coins_stored_beside_others(spark, root):
    for where in ("coin_id < 'b'", "coin_id in ('b', 'c')"):
        reruns._store_by_coin(_documents(spark).filter(where), root, "coins/{id}/market_chart")
    found = _files(f"{root}/raw/coins")
    assert {place.split("/")[0] for place, _ in found} == {"50%25 off %7Ba}", "__HIVE_DEFAULT_PARTITION__", "a", "b", "c"}
    with pytest.raises(OSError):
        reruns._store_by_coin(_documents(spark).filter("coin_id = 'b'"), root, "coins/{id}/market_chart")


def test_a_task_that_runs_again_stores_the_same_files(spark, tmp_path):
    documents = _documents(spark).withColumnRenamed("payload", "value")
    for rows in (documents, documents.coalesce(1), documents.coalesce(1).orderBy("value")):
        store.store_local(rows.coalesce(1), str(tmp_path / "files"), "{coin_id}")
        assert len(_files(tmp_path)) == len(DOCUMENTS)


def test_folders_are_named_as_spark_names_them(spark):
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    assert named.DEFAULT_PARTITION_NAME() == store.NO_VALUE
    signs = [chr(n) for n in range(1, 256)]
    assert {c for c in signs if named.escapePathName(c) != c} == set(store.ESCAPED)


def test_only_a_local_disk_is_written_directly(spark, tmp_path):
    assert store.local_path(spark, f"file://{tmp_path}") == store.local_path(spark, str(tmp_path)) == str(tmp_path)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    assert store.local_path(spark, "viewfs://store/in/lake") is None


def test_numbers_of_stored_lists_are_not_read_by_opening_the_file_anew(spark, root, put):
    from tickwell.operators.staging import stg_snapshots
    from tickwell.sources.scans import scan_snapshots

    item = '{"id":"%d","symbol":"s","name":"n","last_updated":"2024-01-31T00:00:00.000Z","current_price":%d.5,"market_cap_rank":%d,"total_volume":1.50}'
    path = put("coins/markets", "2024-02-01T00:00:00", "[" + ",".join(item % (n, n, n) for n in range(5000)) + "]")
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()

    def bytes_read():
        with open(f"/proc/{pid}/io") as counts:
            return int(counts.readline().split()[1])

    def rows():
        return stg_snapshots(scan_snapshots(spark, root)).selectExpr("count(*)", "sum(current_price)", "sum(market_cap_rank)", "sum(total_volume)").first()

    rows()
    before = bytes_read()
    assert tuple(rows()) == (5000, 5000 * 4999 / 2 + 2500, 5000 * 4999 / 2, 7500)
    assert bytes_read() - before < 5 * os.path.getsize(path)


def test_files_are_reported_without_the_writer(spark, monkeypatch):
    from tickwell.queries import QUERIES

    monkeypatch.setattr(payloads, "objects_writer", _refuse)
    counted = QUERIES["files_report"](spark, "/root/testdata/sf0.001").agg({"files": "sum"}).first()[0]
    assert counted == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_documents_are_read_as_they_are(spark, tmp_path):
    import gzip

    from tickwell.sources.objects import scan_documents

    given = {"a/1.json": b'{"id": "\xc3\xa9"}\r\n', "a/b/2.json": b"\xef\xbb\xbf{}", "c/3.json": b"\xff\xfe", "c d/4.json": b" ", "c/empty.json": b"", "c/5.json.gz": gzip.compress(b"[1]"), "c/6.txt": b"no"}
    for name, content in given.items():
        (tmp_path / "files" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "files" / name).write_bytes(content)

    def found(pattern):
        rows = scan_documents(spark, str(tmp_path / "files"), pattern).selectExpr("coin", "file", "hex(payload) as payload").collect()
        return sorted(map(tuple, rows))

    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(str(tmp_path / "files"), wholetext=True)
    assert sorted(r[2] for r in found("*.json")) == sorted(r[0] for r in text.selectExpr("hex(value)").collect())
    assert [r[:2] for r in found("*.json")] == [("a", "1.json"), ("a", "2.json"), ("c", "3.json"), ("c%20d", "4.json")]
    assert found("*.gz") == [("c", "5.json.gz", b"[1]".hex().upper())]
    assert "Scan text" not in scan_documents(spark, str(tmp_path / "files"))._jdf.queryExecution().executedPlan().toString()
