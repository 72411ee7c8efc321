"""Landing, warehouse, streams, and the registered queries against their statements."""

import random
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from eventmart.plans import findings
from eventmart.plans.warehouse import EXPORTED, MODELS, REPORTS, Warehouse
from eventmart.sources import landing
from eventmart.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


def test_landing_partitions_reconciles_and_keeps_empty_tables(spark, tmp_path):
    d = spark.createDataFrame([(1, at(0), "a"), (2, None, "b"), (3, at(86_400), None)], "event_id bigint, received_at timestamp, body string")
    manifest = landing.land_all({"events": d, "none": d.where("1 = 0")}, str(tmp_path), {"events": "received_at"})
    assert rows(manifest) == [("events", 3, 3, True), ("none", 0, 0, True)]
    landing.require_reconciled(manifest)
    kept = landing.read_landed(spark, f"{tmp_path}/events", keep_date=True)
    assert rows(kept.groupBy("received_date").count()) == [("2026-08-20", 1), ("2026-08-21", 1), ("unknown", 1)]
    assert landing.read_landed(spark, f"{tmp_path}/events").columns == d.columns
    assert spark.read.parquet(f"{tmp_path}/none").schema == d.schema
    with pytest.raises(RuntimeError, match="events"):
        landing.require_reconciled(spark.createDataFrame([("events", 3, 2, False)], landing.MANIFEST))


def test_source_types_fall_back_to_text(spark):
    df = spark.createDataFrame([(1, "2.5", '{"a": 1}')], "id int, n string, odd string")
    got = landing.typed_as_source(df, {"id": "bigint", "n": "numeric", "odd": "point"})
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "decimal(38,10)", "string"]


def test_lowered_types(spark, tmp_path):
    df = spark.sql("SELECT array(1L, 2L) AS ids, TIMESTAMP '2026-01-01 00:00:00' AS t, CAST(1.5 AS DECIMAL(38,10)) AS d, CAST(7 AS DECIMAL(38,0)) AS big")
    low = landing.lower_types(df)
    assert [f.dataType.simpleString() for f in low.schema] == ["string", "timestamp_ntz", "double", "bigint"]
    assert low.first().ids == "1, 2"
    assert landing.write_csv(df, f"{tmp_path}/csv") == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").first().ids == "1, 2"


def test_warehouse_builds_every_model_report_and_export(spark, tmp_path):
    world = entry.World(spark, FOLDER)
    house = Warehouse(spark, world.raw_tables(), f"{tmp_path}/house", entry.WINDOW)
    built = {r.model: r.row_count for r in house.build().collect()}
    assert list(built) and set(built) == {m for models in MODELS.values() for m in models}
    assert built["stg_events"] == world.raw_events.select("server_event_id").distinct().count()
    assert built["cheat_rule_results"] == 13 and built["dim_date"] == 30 and built["rule_r13"] > 0
    assert built["cheat_violations"] == sum(n for m, n in built.items() if m.startswith("rule_"))
    written = {r.model: r.row_count for r in house.write_reports(f"{tmp_path}/reports").collect()}
    assert set(written) == set(REPORTS) and written["deaths_boss_vs_player"] == 4
    out = {r.model: r.row_count for r in house.export(f"{tmp_path}/bi").collect()}
    assert set(out) == set(EXPORTED) and len(out) == 19
    again = Warehouse(spark, world.raw_tables(), f"{tmp_path}/house", entry.WINDOW).open("fct_sessions", "cheat_offenders")
    assert again["cheat_offenders"].count() == built["cheat_offenders"]


def stream_of(spark, df, folder):
    df.write.parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def test_streamed_transfers_equal_the_batch_rule(spark, events, tmp_path):
    from eventmart.operators import history
    from eventmart.plans import rules

    rng = random.Random(5)
    moves = [dict(event_type="trade_completed", items_given=[f"i{rng.randrange(6)}"], character_id=f"c{rng.randrange(4)}",
                  counterpart_character_id=f"c{rng.randrange(4)}", t=t) for t in range(120)]
    last = dict(event_type="item_looted", item_instance_id="z", character_id="c0", t=100_000)  # closes what came before
    flat = history.item_moves(events(*moves, last))
    batch = rules.item_duplication(history.custody_chain(flat))
    got = jobs.run_to_table(jobs.duplicate_transfer_stream(stream_of(spark, flat, f"{tmp_path}/in")), f"{tmp_path}/out")
    assert got.count() > 5
    assert rows(got.select("character_id", F.array("first_event_id", "event_id"))) == rows(batch, "character_id", "evidence_event_ids")


def test_streamed_transfers_over_many_batches(spark, events, tmp_path):
    """Rows out of order by less than the lateness, one file a batch; old hand-overs are forgotten, and so is their state."""
    from eventmart.operators import history
    from eventmart.plans import rules

    rng = random.Random(6)
    times = sorted(rng.sample(range(0, 6 * 86_400, 60), 400))
    moves = [dict(event_type="trade_completed", items_given=[f"i{rng.randrange(5)}"], character_id=rng.choice(["c0", "c1", "c2", "c3", None]),
                  counterpart_character_id=rng.choice(["c0", "c1", "c2", None]), t=t) for t in times]
    last = dict(event_type="item_looted", item_instance_id="z", character_id="c0", t=40 * 86_400)
    flat = history.item_moves(events(*moves, last)).cache()
    for k in range(8):
        part = flat.where((F.col("event_id") > 50 * k) & (F.col("event_id") <= 50 * k + 50))
        part.coalesce(1).orderBy(F.xxhash64("event_id")).write.mode("append").parquet(f"{tmp_path}/in")
    flat.where("item_instance_id = 'z'").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = jobs.run_to_table(jobs.duplicate_transfer_stream(stream, remember_days=1), f"{tmp_path}/out")
    at_ = {r.event_id: r.event_ts_utc for r in flat.collect()}
    batch = rules.item_duplication(history.custody_chain(flat)).select("character_id", F.col("evidence_event_ids").alias("e")).collect()
    near = sorted((r.character_id, *r.e) for r in batch if (at_[r.e[1]] - at_[r.e[0]]).total_seconds() <= 86_400)
    assert 5 < len(near) < len(batch)
    assert sorted((r.character_id, r.first_event_id, r.event_id) for r in got.collect()) == near
    for name in ("waiting", "given", "holder"):  # only the row that closed the stream is left
        state = spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/out/checkpoint")
        assert state.count() <= (name == "waiting"), name


def test_streamed_monitors_equal_the_batch(spark, tmp_path):
    from eventmart.operators.quality import lost_events, loss_by_hour, skew_by_hour

    data = [(f"s{i}", "x" if i % 3 else "y", i, at(i * 60 - (18_000 if i > 150 else 0)), at(i * 60 + 1)) for i in range(400) if i % 41]
    d = spark.createDataFrame(data, "server_event_id string, server_id string, shard_seq bigint, event_ts timestamp, received_at timestamp")
    closed = F.col("hour_start") < F.lit(at(400 * 60 - 3 * 3600))
    source = d.unionByName(d.where("shard_seq % 10 = 0"))  # redelivered with the same receive time
    for i, (stream, batch) in enumerate([(jobs.skew_stream, skew_by_hour), (jobs.loss_stream, loss_by_hour)]):
        out = jobs.run_to_table(stream(stream_of(spark, source.coalesce(1), f"{tmp_path}/in{i}")), f"{tmp_path}/out{i}")
        out = lost_events(out) if batch is loss_by_hour else out
        assert rows(out.where(closed)) == rows(batch(d).where(closed)) and out.where(closed).count() >= 6


def test_alerts_are_reported_once(spark, tmp_path):
    schema = "rule_id string, character_id string, detail string, evidence_event_ids array<bigint>"
    one = spark.createDataFrame([("R01", "a", "d", [1]), ("R01", "a", "d", [1]), ("R02", "a", "d", [2])], schema)
    two = spark.createDataFrame([("R02", "a", "d", [2]), ("R03", "b", "d", [3])], schema)
    source = f"{tmp_path}/in"
    one.write.parquet(source)
    for batch in (None, two):
        if batch is not None:
            batch.write.mode("append").parquet(source)
        out = jobs.run_alerts(spark.readStream.schema(schema).parquet(source), f"{tmp_path}/alerts")
    assert rows(out, "rule_id", "evidence_event_ids") == [("R01", [1]), ("R02", [2]), ("R03", [3])]
    jobs.write_new_alerts(two, 1, f"{tmp_path}/alerts/table")  # a repeated batch changes nothing
    assert spark.read.parquet(f"{tmp_path}/alerts/table").count() == 3


def test_alerts_look_up_the_days_of_a_batch(spark, tmp_path):
    schema = "rule_id string, detail string, evidence_event_ids array<bigint>, occurred_at timestamp"
    day = [datetime(2026, 1, d, 23, 30) for d in (1, 2, 3)]
    first = [("R01", "d", [1], day[0]), ("R01", "d", [2], day[1]), ("R01", "d", [3], None)]
    again = [first[1], first[2], ("R02", "d", [4], day[2])]
    source = f"{tmp_path}/in"
    for batch in (first, again):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        out = jobs.run_alerts(spark.readStream.schema(schema).parquet(source), f"{tmp_path}/alerts")
    assert rows(out, "rule_id", "evidence_event_ids") == [("R01", [1]), ("R01", [2]), ("R01", [3]), ("R02", [4])]


def test_alerts_of_one_severity(spark, tmp_path):
    schema = "rule_id string, detail string, evidence_event_ids array<bigint>, occurred_at timestamp"
    every = [r[0] for r in findings.RULE_CATALOGUE]
    late = [datetime(1990, 1, 1), datetime(2026, 1, 2)]
    source = f"{tmp_path}/in"
    for batch in range(2):  # a late finding beside a new one; both days were reported before
        found = [(r, "d", [i], late[i % 2]) for i, r in enumerate(every)]
        spark.createDataFrame(found, schema).write.mode("append").parquet(source)
        out = jobs.run_alerts(spark.readStream.schema(schema).parquet(source), f"{tmp_path}/alerts", "high")
    assert rows(out, "rule_id") == [(r[0],) for r in sorted(findings.RULE_CATALOGUE) if r[3] == "high"]
    empty = spark.createDataFrame([], schema)
    jobs.write_new_alerts(empty, 9, f"{tmp_path}/alerts/table")
    assert spark.read.parquet(f"{tmp_path}/alerts/table").count() == out.count()


def test_discovered_tables_become_views(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b.parquet")
    landing.land_table(spark.range(2).withColumn("ts", F.timestamp_seconds("id")), f"{tmp_path}/a", "ts")
    spark.range(9).write.parquet(f"{tmp_path}/_hidden")
    assert list(landing.discover(spark, str(tmp_path))) == ["a", "b"]
    assert landing.register_views(spark, str(tmp_path), "v_") == ["v_a", "v_b"]
    assert rows(spark.sql("SELECT * FROM v_a"), "id") == [(0,), (1,)] and spark.table("v_a").columns == ["id", "ts"]
    found = landing.discovered_columns(spark, str(tmp_path)).where("table_name = 'b'")
    assert rows(found, "position", "column_name", "data_type") == [(1, "id", "bigint")]


KEYS = ["discovered_tables", "land_events", "reconcile_landing", "dedup_first", "stg_events", "seq_gaps", "dq_summary", "level_history", "asof_left",
        "custody_chain", "r01_burst", "r03_stacking", "r10_illegal_pair", "violations", "encounter_participation", "peer_percentile",
        "flow_statement", "scalar_json", "scalar_time", "chain_complete", "concurrent_members", "stream_dedup"]


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_its_statement(spark, key):
    db = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = entry.queries()[key](spark, FOLDER).toPandas()
    assert check.compare(got, db.execute(entry.oracle_sql()[key]).df()) == "" and len(got)


def test_registry_is_complete():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(entry.REGISTRY) - set(oracles) == {"stream_skew", "stream_gaps", "stream_alerts"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
