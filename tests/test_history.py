import datetime as dt

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from eventmart.operators import history

EVER, NEVER = dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1)


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_level_history(spark, events, hot):
    people = spark.createDataFrame([("a", 9), ("b", 40), ("c", 11)], "character_id string, level int")
    e = events(dict(event_type="level_up", character_id="a", new_level=4, t=10), dict(event_type="level_up", character_id="a", new_level=5, t=20),
               dict(event_type="level_up", character_id="a", t=15), dict(event_type="other", character_id="b", new_level=3, t=1),
               dict(event_type="level_up", character_id="c", new_level=11, t=5), dict(event_type="level_up", character_id="c", new_level=12, t=5))
    got = history.level_history(e, people, hot=hot)
    assert rows(got, "character_id", "level", "valid_from", "valid_to", "bracket_min_level", "bracket_max_level") == sorted([
        ("a", 3, EVER, at(10), 1, 10), ("a", 4, at(10), at(20), 1, 10), ("a", 5, at(20), NEVER, 1, 10),
        ("b", 40, EVER, NEVER, 31, 40), ("c", 10, EVER, at(5), 1, 10), ("c", 11, at(5), at(5), 11, 20),
        ("c", 12, at(5), NEVER, 11, 20)], key=str)


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_custody_chain(events, hot):
    e = events(dict(event_type="item_looted", item_instance_id="i", character_id="a", t=0),
               dict(event_type="trade_completed", items_given=["i", "j"], character_id="a", counterpart_character_id="b", t=1),
               dict(event_type="trade_completed", items_given=[], character_id="b", counterpart_character_id="c", t=2),
               dict(event_type="trade_completed", items_given=["i"], character_id="b", counterpart_character_id="c", t=3),
               dict(event_type="item_equipped", item_instance_id="i", character_id="c", t=4),
               dict(event_type="auction_created", item_instance_id="i", character_id="c", t=5))
    got = history.custody_chain(history.item_moves(e), slice_seconds=2, hot=hot)
    assert rows(got, "item_instance_id", "custody_step", "giver", "holder_before", "holder_after") == sorted([
        ("i", 1, None, None, "a"), ("i", 2, "a", "a", "b"), ("i", 3, "b", "b", "c"), ("i", 4, "c", "c", None),
        ("j", 1, "a", None, "b")], key=str)


def test_moves_known_only_to_the_receiver(events):
    e = events(dict(event_type="trade_completed", trade_id="t1", items_given=["i"], items_received=[], character_id="a", counterpart_character_id="b", t=0),
               dict(event_type="trade_completed", trade_id="t1", items_given=[], items_received=["i"], character_id="b", counterpart_character_id="a", t=0),
               dict(event_type="trade_completed", trade_id="t2", items_given=[], items_received=["i"], character_id="c", counterpart_character_id="b", t=9))
    assert rows(history.item_moves(e), "event_id") == [(1,)]
    assert rows(history.item_moves(e, use_received=True), "event_id", "giver", "holder_after") == [(1, "a", "b"), (3, "b", "c")]


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_sessions(events, hot):
    e = events(dict(event_type="session_login", character_id="a", t=0, zone_id="z"), dict(event_type="session_logout", character_id="a", t=30),
               dict(event_type="session_login", character_id="a", t=40), dict(event_type="session_login", character_id="a", t=50),
               dict(event_type="session_logout", character_id="a", t=60), dict(event_type="session_logout", character_id="a", t=61),
               dict(event_type="session_login", character_id="a", t=70), dict(event_type="session_login", t=0))
    done = history.pair_sessions(e, slice_seconds=5, hot=hot)
    assert rows(done, "login_at", "duration_s", "login_zone_id") == [(at(0), 30.0, "z"), (at(50), 10.0, None)]
    kept = history.pair_sessions(e, keep_open=True, hot=hot)
    assert rows(kept.where("logout_missing"), "login_at", "logout_at") == [(at(40), at(50)), (at(70), None)]


def test_intervals_cover_all_time_without_overlap(spark, events):
    e = events(*[dict(event_type="level_up", character_id=f"c{i % 5}", new_level=i % 7 + 1, t=i * 37 % 100) for i in range(80)])
    people = spark.createDataFrame([(f"c{i}", 3) for i in range(8)], "character_id string, level int")
    h = history.level_history(e, people)
    spans = h.withColumn("s", F.unix_micros("valid_to") - F.unix_micros("valid_from"))
    total = rows(spans.groupBy("character_id").agg(F.sum("s").alias("s")), "s")
    assert total == [((NEVER - EVER) // dt.timedelta(microseconds=1),)] * 8
    assert spans.where("s < 0").count() == 0
