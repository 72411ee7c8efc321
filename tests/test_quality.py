from conftest import at, rows
from pyspark.sql import functions as F

from eventmart.functions.bodies import json_list_sum, parse_body, unpack
from eventmart.operators import quality
from eventmart.plans.staging import stg_events

DELIVERY = ("event_id bigint, server_event_id string, event_type string, schema_version int, game_version string, "
            "event_ts timestamp, received_at timestamp, server_id string, shard_seq bigint, source_batch_id string, "
            "source_file string, body string")


def deliveries(spark, *parts):
    """(event_id, server_event_id, server_id, shard_seq, seconds, body) -> deliveries received 0.7 s later."""
    return spark.createDataFrame(
        [(e, s, "level_up", 1, "2.0", at(t), at(t + 0.7), srv, seq, "b", "f", body) for e, s, srv, seq, t, body in parts],
        DELIVERY)


def corrections(spark, *parts):
    df = spark.createDataFrame(list(parts), "server_id string, from_shard_seq bigint, to_shard_seq bigint")
    return df.withColumn("add_to_event_ts", F.expr("INTERVAL '5' HOUR"))


def test_first_delivery_is_kept_and_counted(spark):
    d = deliveries(spark, (7, "a", "x", 1, 0, "{}"), (3, "a", "x", 1, 0, "{}"), (5, "b", "x", 2, 0, "{}"))
    assert rows(quality.dedup_first(d), "event_id", "server_event_id", "delivery_count") == [(3, "a", 2), (5, "b", 1)]


def test_clock_correction_ranges_are_inclusive(spark):
    d = deliveries(spark, (1, "a", "x", 9, 0, ""), (2, "b", "x", 10, 0, ""), (3, "c", "y", 10, 0, ""),
                   (4, "d", "z", 5, 0, ""), (5, "e", "z", 6, 0, ""))
    fixed = quality.clock_correct(d, corrections(spark, ("x", 10, None), ("z", 1, 5)))
    got = {r.event_id: (r.ts_corrected, r.event_ts_utc == at(5 * 3600)) for r in fixed.collect()}
    assert got == {1: (False, False), 2: (True, True), 3: (False, False), 4: (True, True), 5: (False, False)}


def test_overlapping_corrections_are_found(spark):
    ok = corrections(spark, ("x", 1, 5), ("x", 6, None), ("y", 1, None))
    bad = corrections(spark, ("x", 1, 6), ("x", 6, None), ("y", 1, None), ("y", 9, 12))
    assert quality.overlapping_corrections(ok).count() == 0
    assert rows(quality.overlapping_corrections(bad), "server_id", "from_shard_seq") == [("x", 1), ("y", 1)]


def test_seq_gaps_list_every_missing_number(spark, events):
    e = events(*[dict(server_id="x", shard_seq=s, t=s) for s in (1, 2, 5, 6, 9)], dict(server_id="y", shard_seq=4, t=0),
               dict(server_id="z", shard_seq=1, t=0), dict(server_id="z", shard_seq=100, t=1))
    want = [("x", 3, 2, 5), ("x", 4, 2, 5), ("x", 7, 6, 9), ("x", 8, 6, 9), *[("z", n, 1, 100) for n in range(2, 100)]]
    for hot, bucket, block in ((2_000_000, 1_000_000, 10_000), (1, 3, 7), (0, 1, 1)):
        got = quality.seq_gaps(e, bucket=bucket, hot=hot, block=block)
        assert rows(got, "server_id", "missing_seq", "prev_seq", "next_seq") == sorted(want, key=str)


def test_repair_of_integers(spark):
    raw = [-1144, 2148090652, 0, 2147483647, 2147483648, None, -1]
    df = quality.repair_columns(spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, price bigint"), ["price"])
    got = [(r.price, r.price_raw, r.numeric_repair) for r in df.orderBy("i").collect()]
    label = ["bitflip_recovered", "overflow_nulled", None, None, "overflow_nulled", None, "bitflip_recovered"]
    assert got == list(zip([1143, None, 0, 2147483647, None, None, 0], raw, label))


def test_body_missing_and_fields(spark):
    bodies = {1: None, 2: "null", 3: "[]", 4: '{"character_id": "chr', 5: "{}", 6: ' {"character_id": "c", "zone_id": "zone_unknown"}',
              7: '{"xp_amount": "12", "new_level": 0, "items_given": ["a", "b"], "ready": true}', 8: '"text"', 9: ""}
    d = spark.createDataFrame(list(bodies.items()), "event_id bigint, body string").withColumn("event_type", F.lit("x"))
    parsed = parse_body(d)
    out = {r.event_id: r for r in parsed.select("event_id", "body_missing", *unpack(parsed)).collect()}
    assert [i for i in bodies if out[i].body_missing] == [1, 2, 3, 4, 8, 9]
    assert (out[6].character_id, out[6].zone_id) == ("c", None)
    assert (out[7].xp_amount, out[7].new_level, out[7].items_given, out[7].amulet_ready) == (12, None, ["a", "b"], True)
    assert out[4].character_id is None


def test_json_list_sum(spark):
    values = ['[{"total":5},{"total":7}]', "[]", '[{"total":null},{"total":3}]', '[{"x":1}]', None, '[{"total":"12"},{"total":7}]', '[{"total":"many"},{"total":1}]']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(json_list_sum(F.col("v"))).collect()] == [12, None, 3, None, None, 19, 1]


def test_recover_attribute_takes_the_smallest_event(events):
    loot = events(dict(event_id=9, item_instance_id="i"), dict(event_id=8, item_instance_id="j"),
                  dict(event_id=7, item_instance_id="i", item_template_id="own"))
    drops = events(dict(event_id=2, item_instance_id="i", item_template_id="b"),
                   dict(event_id=1, item_instance_id="i"), dict(event_id=3, item_instance_id="i", item_template_id="a"))
    got = quality.recover_attribute(loot, drops, "item_instance_id", "item_template_id")
    assert rows(got, "event_id", "item_template_id") == [(7, "own"), (8, None), (9, "b")]


def test_orphans_skip_null_references(spark, events):
    people = spark.createDataFrame([("a",)], "character_id string")
    got = quality.orphans(events(dict(character_id="a"), dict(character_id="b"), dict()), "character_id", people, "character_id")
    assert rows(got, "event_id") == [(2,)]


def test_summary_and_shard_quality_add_up(spark):
    body = '{"character_id": "a", "new_level": 3, "zone_id": "zone_unknown"}'
    d = deliveries(spark, (1, "a", "x", 1, 0, body), (2, "a", "x", 1, 0, body), (3, "b", "x", 2, 1, None),
                   (4, "c", "x", 5, 2, '{"character_id": "nobody", "new_level": 0}'), (5, "d", "x", 6, 3, '{"xp_amount": -8}'),
                   (6, "e", "y", 1, 4, '{"character_id": "a", "price": 2147483648, "new_level": 2}'))
    kept = stg_events(d, corrections(spark, ("y", 1, None)))
    people = spark.createDataFrame([("a",)], "character_id string")
    got = {r.check_id: r.affected_rows for r in quality.dq_summary(d, kept, people).collect()}
    assert got == {"DQ-1": 1, "DQ-2": 2, "DQ-3": 1, "DQ-4a": 1, "DQ-4b": 1, "DQ-5a": 2, "DQ-5b": 1, "DQ-6a": 1,
                   "DQ-6b": 1, "DQ-7": 2}
    shard = {r.server_id: r for r in quality.shard_quality(d, kept).collect()}
    assert (shard["x"].rows, shard["x"].unique_events, shard["x"].extra_rows, shard["x"].gaps, shard["x"].lost_events) == (5, 4, 1, 1, 2)
    assert shard["y"].gaps == 0 and round(shard["x"].typical_delay_ms) == 700
    assert sum(r.rows - r.extra_rows for r in shard.values()) == kept.count()


def test_repair_proof(spark, events):
    ref = spark.createDataFrame([("c", 10)], "creature_id string, xp_reward bigint")
    e = events(dict(creature_id="c", xp_amount=10), dict(creature_id="c", xp_amount=10), dict(creature_id="c", xp_amount=9),
               dict(creature_id="c")).withColumn("xp_amount_raw", F.when(F.col("event_id") == 2, -11).otherwise(F.col("xp_amount")))
    assert rows(quality.repair_proof(e, ref, "creature_id", "xp_amount", "xp_reward")) == [(3, 2, 1, 1)]


def test_skew_by_hour_proposes_whole_quarters(spark):
    d = deliveries(spark, (1, "a", "x", 1, 0, ""), (2, "b", "y", 1, 0, ""))
    late = d.withColumn("event_ts", F.when(F.col("server_id") == "y", F.col("event_ts") - F.expr("INTERVAL 5 HOURS")).otherwise(F.col("event_ts")))
    got = rows(quality.skew_by_hour(late), "server_id", "alarm", "proposed_add_s")
    assert got == [("x", False, None), ("y", True, 18000)]
