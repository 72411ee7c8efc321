"""Incremental load against an index of keys: late copies, repeated loads, rows without a key."""

import datetime as dt

from conftest import rows
from eventmart.streaming import key_index

SCHEMA = "event_id bigint, server_event_id string, received_at timestamp, body string"


def deliveries(spark, *found):
    start = dt.datetime(2024, 1, 1, 12)
    return spark.createDataFrame([(i, k, start + dt.timedelta(days=d), f"b{i}") for i, k, d in found], SCHEMA)


def loaded(spark, folder):
    return spark.read.schema(SCHEMA).parquet(f"{folder}/events")


def test_copies_of_earlier_loads_are_dropped_however_late(spark, tmp_path):
    folder = str(tmp_path)
    key_index.open_index(spark, folder)
    first = deliveries(spark, (1, "a", 0), (2, "a", 0), (3, "b", 0), (4, None, 0), (5, None, 0))
    late = deliveries(spark, (6, "a", 3), (7, "c", 3), (8, "b", 40), (9, "c", 3), (10, None, 3))
    key_index.load_batch(first, 0, folder, buckets=4)
    assert rows(loaded(spark, folder), "event_id") == [(1,), (3,), (4,), (5,)]
    for _ in range(2):  # a load that is repeated replaces what it wrote
        key_index.load_batch(late, 1, folder, buckets=4)
        assert rows(loaded(spark, folder), "event_id") == [(1,), (10,), (3,), (4,), (5,), (7,)]
    key_index.load_batch(first, 0, folder, buckets=4)  # and does not see later loads
    assert rows(loaded(spark, folder), "event_id") == [(1,), (10,), (3,), (4,), (5,), (7,)]
    assert rows(key_index.known_keys(spark, folder, 2), "key", "first_received_day") == [
        ("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 1)), ("c", dt.date(2024, 1, 4))]


def test_only_the_buckets_met_are_read(spark, tmp_path):
    folder = str(tmp_path)
    key_index.open_index(spark, folder)
    key_index.load_batch(deliveries(spark, *[(i, f"k{i}", 0) for i in range(64)]), 0, folder, buckets=8)
    some = key_index.known_keys(spark, folder, 1, [3])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    files = {r[0].rsplit("/", 2)[1] for r in some.selectExpr("input_file_name()").distinct().collect()}
    assert files == {"bucket=3"} and 0 < some.count() < 64


def test_loads_go_on_after_compaction(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    key_index.open_index(spark, old)
    for i in range(3):
        key_index.load_batch(deliveries(spark, (i, f"k{i}", i)), i, old, buckets=4)
    key_index.compact_keys(spark, old, 2, new)
    key_index.load_batch(deliveries(spark, (7, "k1", 9), (8, "k9", 9)), 3, new, buckets=4)
    assert rows(loaded(spark, new), "event_id") == [(8,)]


def test_empty_batch(spark, tmp_path):
    folder = str(tmp_path)
    key_index.open_index(spark, folder)
    key_index.load_batch(deliveries(spark, (1, "a", 0)).where("false"), 0, folder)
    assert loaded(spark, folder).count() == 0 and key_index.known_keys(spark, folder, 1).count() == 0
