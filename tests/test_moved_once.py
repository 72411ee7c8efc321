"""Steps that are alike move, sort and read their rows once, and say the same as before."""

import re
import time

import pytest
from conftest import at, rows

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.operators import history
from eventmart.operators.ordered import measure_hot_keys
from eventmart.operators.quantiles import exact_quantile
from eventmart.plans import facts, findings, reports, rules
from eventmart.session import DROP_SHUFFLES
from eventmart.sources.landing import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def moves(events):
    def give(who, to, t, item="i"):
        return dict(event_type="trade_completed", items_given=[item], character_id=who, counterpart_character_id=to, t=t)

    return history.item_moves(events(give("a", "b", 0), give("a", "c", 5), give("c", "d", 6), give("a", "b", 7), give("d", "a", 8, "j"),
                                     dict(event_type="item_looted", item_instance_id="i", character_id="z", t=6.5)))


def test_custody_is_sorted_once_by_item(moves, tmp_path):
    cold = measure_hot_keys(moves, ["item_instance_id"], f"{tmp_path}/hot")
    chain = history.custody_chain(moves, hot=cold)
    assert len(re.findall(r"\bSort \[", plan(chain))) == len(re.findall(r"Exchange hashpartitioning", plan(chain))) == 1
    for hot in (0, 2_000_000):
        assert rows(history.custody_chain(moves, slice_seconds=2, hot=hot), *chain.columns) == rows(chain)


def test_last_given_needs_no_further_move(moves, tmp_path):
    cold = measure_hot_keys(moves, ["item_instance_id"], f"{tmp_path}/hot")
    chain = history.custody_chain(moves, hot=cold)
    kept = history.with_last_given(chain, hot=cold)
    assert plan(kept).count("Exchange hashpartitioning") == 1
    found = rows(rules.item_duplication(kept, hot=cold), "character_id", "evidence_event_ids", "detail")
    assert found and found == rows(rules.item_duplication(chain, hot=cold), "character_id", "evidence_event_ids", "detail")
    assert kept.where("giver IS NULL AND last_given IS NOT NULL").isEmpty()


def test_trade_sides_are_moved_once_by_trade(events, spark):
    people = spark.createDataFrame([("a", "red"), ("b", "blue")], "character_id string, faction string")
    side = dict(event_type="trade_completed", trade_id="t", zone_id="z", t=0)
    out = rules.illegal_trade(events(side | dict(character_id="a"), side | dict(character_id="b")), people)
    assert plan(out).count("Exchange hashpartitioning(trade_id") == 1
    assert rows(out, "character_id", "evidence_event_ids") == [("a", [1, 2])]


def test_findings_are_counted_before_their_actor_is_looked_up(spark):
    schema = ("rule_id string, character_id string, occurred_at timestamp, encounter_id string, detail string, evidence_event_ids array<bigint>, "
              "evidence_server_event_ids array<string>, evidence_part int, evidence_first bigint")
    given = [("R03", "a"), ("R03", "a"), ("R01", "b"), ("R04", "twice"), ("R05", "twice"), ("R05", "ghost"), ("R05", None)]
    found = [spark.createDataFrame([(r, c, None, None, "d", [i], [f"s{i}"], part, i) for i, (r, c) in enumerate(given) for part in (0, 1)], schema)
             .withColumn("occurred_at", F.timestamp_seconds("evidence_first"))]
    people = spark.createDataFrame([("a", "x", "red", "m"), ("b", "x", None, "m"), ("twice", "x", "red", "m"), ("twice", "x", "red", "m"),
                                    ("twice", "y", "red", "m")], "character_id string, account_id string, faction string, class_id string")
    cat = findings.rule_catalogue(spark)
    tally, each = findings.tallied(found, cat, people), findings.described(found, cat, people)
    assert tally.count() == 10 and each.count() == 22
    assert rows(findings.offenders(tally)) == rows(findings.offenders(each))
    assert rows(findings.rule_results(cat, tally)) == rows(findings.rule_results(cat, each))
    got = {(o.character_id, o.account_id): (o.violations, o.distinct_rules, o.high_severity) for o in findings.offenders(tally).collect()}
    assert got == {("a", "x"): (2, 1, 0), ("b", "x"): (1, 1, 1), ("twice", "x"): (4, 2, 0), ("twice", "y"): (2, 2, 0)}


def test_stored_findings_hold_no_key(spark, events):
    people = spark.createDataFrame([("a", "x", "red", "m")], "character_id string, account_id string, faction string, class_id string")
    hit = dict(event_type="pve_damage_dealt", character_id="a", encounter_id="e", damage=1, t=0)
    given = [rules.burst_damage(events(hit, hit))], findings.rule_catalogue(spark), people
    out = findings.violations(*given)
    files = [f for f in out.inputFiles() if "findings-" in f]
    assert files and "violation_key" not in spark.read.parquet(*files).columns
    assert out.first().violation_key == findings.described(*given).first().violation_key


def test_quantiles_read_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = spark.range(300).selectExpr("id % 3 AS k", "cast(id % 50 AS double) AS v").mapInArrow(count, "k bigint, v double")
    out = rows(exact_quantile(given, ["k"], F.col("v"), "m", small=4, bins=3))
    assert out == [(0, 24.0), (1, 24.0), (2, 24.0)] and seen.value == 300


def test_fights_add_up_no_text_before_they_are_moved(spark, events, tmp_path):
    fight = dict(encounter_id="e", character_id="a")
    log = events(dict(event_type="encounter_started", encounter_kind="pve", creature_id=None, t=0, **fight),
                 dict(event_type="encounter_started", encounter_kind=None, creature_id="k", t=1, **fight),
                 dict(event_type="encounter_ended", outcome="victory", t=9, **fight),
                 dict(event_type="pve_damage_dealt", damage=4, t=2, **fight), dict(event_type="pve_damage_dealt", damage=5, t=3, **fight),
                 dict(event_type="pve_damage_dealt", damage=5, t=3, encounter_id="f", character_id="a"))
    log = log.withColumn("opponent_character_ids", F.lit(None).cast("array<string>"))
    creatures = spark.createDataFrame([("k", "boss")], "creature_id string, rank string")
    levels = spark.createDataFrame([("a", 7, 1)], "character_id string, level int, bracket_min_level int").withColumn(
        "valid_from", F.lit("2000-01-01").cast("timestamp"))
    cold = measure_hot_keys(log, ["character_id"], f"{tmp_path}/hot")
    done = facts.encounter_participation(log, creatures, levels, hot=cold)
    kills = facts.fct_creature_kills(done)
    for df in (done, kills):
        assert not re.search(r"Exchange hashpartitioning\(encounter_id[^\n]*\n[^\n]*SortAggregate", plan(df))
    names = ["encounter_kind", "creature_id", "creature_rank", "outcome", "duration_s", "damage_done", "level_at_start"]
    assert rows(done, *names) == [("pve", "k", "boss", "victory", 9.0, 9, 7)]
    assert rows(kills, "creature_id", "participants", "fight_duration_s") == [("k", 1, 9.0)]
    assert rows(facts.encounter_participation(log, creatures, levels, hot=0), *names) == rows(done, *names)


def test_the_chain_alone_is_not_stored(spark, monkeypatch):
    import __spark_entry__ as entry

    w = entry.World(spark, "/root/testdata/sf0.001")
    stored = []
    monkeypatch.setattr(entry.World, "stored", lambda self, name, build, partition_by=None: stored.append(name) or build())
    chain = entry.REGISTRY["custody_chain"](w)
    assert not stored and rows(chain) == rows(entry.plain(w.custody(), *chain.columns)) and stored == ["custody"]


def _finding_rows(spark, given):
    schema = ("rule_id string, character_id string, occurred_at timestamp, encounter_id string, detail string, evidence_event_ids array<bigint>, "
              "evidence_server_event_ids array<string>, evidence_part int, evidence_first bigint")
    return spark.createDataFrame([(r, c, None if t is None else at(t), None, f"d{i}", [i], [f"s{i}"], part, i)
                                  for r, c, t, i, part in given], schema)


def test_violations_are_moved_once_and_without_what_their_rule_and_actor_add(spark, tmp_path):
    found = _finding_rows(spark, [("R01", "a", 5, 1, 0), ("R01", "a", 5, 1, 1), ("R03", "a", 5, 2, 0), ("R03", "a", 5, 3, 0), ("R03", "twice", 5, 4, 0),
                                  ("R03", "twice", 5, 5, 0), ("R01", "twice", 9, 6, 0), ("R01", "twice", 9, 6, 1), ("R04", None, 9, 7, 0),
                                  ("R04", "ghost", None, 8, 0), ("R04", None, None, 9, 0), ("R99", "a", 1, 10, 0), ("R05", "a", 90_000, 11, 0)])
    found.write.parquet(f"{tmp_path}/f")
    people = spark.createDataFrame([("a", "x", "red", "m"), ("twice", "y", "red", "m"), ("twice", "z", None, "m"), (None, "n", "red", "m")],
                                   "character_id string, account_id string, faction string, class_id string")
    cat = findings.rule_catalogue(spark)
    out = findings.violations([spark.read.parquet(f"{tmp_path}/f")], cat, people, stored=True)
    moves = [m for m in re.findall(r"Exchange hashpartitioning[^\n]*\n[^\n]*", plan(out)) if "detail" in m]
    assert len(re.findall(r"Exchange hashpartitioning\(_fine", plan(out))) == 1
    assert not any("rule_name" in m or "violation_key" in m for m in moves)
    assert not [f for f in out.inputFiles() if "findings-" in f]
    order = ["occurred_at", "rule_id", "character_id", "evidence_first", "evidence_part", "detail"]
    every = findings.described([found], cat, people).withColumn("violation_id", F.sum(F.when(F.col("evidence_part") == 0, 1).otherwise(0)).over(
        W.orderBy(*order, "account_id").rowsBetween(W.unboundedPreceding, 0)))
    names = ["violation_key", "rule_name", "occurred_at", "character_id", "faction", "detail", "evidence_part", "character_known"]
    assert rows(out, *names) == rows(every, *names) and out.count() == 16
    assert rows(out, "violation_id", "detail", "evidence_part") == rows(every, "violation_id", "detail", "evidence_part")
    whole = out.where("evidence_part = 0")
    assert sorted(r[0] for r in whole.select("violation_id").collect()) == list(range(1, 14)) == sorted(
        r[0] for r in findings.violations([found], cat, people).where("evidence_part = 0").select("violation_id").collect())


def test_bound_items_are_read_from_the_chain_stored_with_their_first_equip(spark, events, tmp_path):
    def give(who, to, t, item):
        return dict(event_type="trade_completed", items_given=[item], item_instance_id=item, character_id=who, counterpart_character_id=to, t=t)

    log = events(give("a", "b", 0, "i"), give("b", "c", 9, "i"), give("c", "d", 12, "j"), give("a", "b", 13, "free"),
                 *[dict(event_type="item_equipped", item_instance_id=i, character_id="b", t=t) for i, t in (("i", 7), ("i", 5), ("j", 20))])
    moves = history.item_moves(log)
    chain = history.custody_chain(moves, hot=measure_hot_keys(moves, ["item_instance_id"], f"{tmp_path}/hot"))
    kept = rules.with_first_equip(chain, log)
    assert kept.count() == 4 and len(re.findall(r"Exchange hashpartitioning\(item_instance_id", plan(kept))) <= 2
    kept.write.parquet(f"{tmp_path}/kept")
    out = rules.bound_item_moved(spark.read.parquet(f"{tmp_path}/kept"), log)
    assert "Exchange" not in plan(out)
    assert rows(out, "character_id", "evidence_event_ids", "detail") == rows(
        rules.bound_item_moved(chain, log), "character_id", "evidence_event_ids", "detail") != []


@pytest.fixture()
def small_world(spark, tmp_path):
    """A folder of sample tables with a few rows, opened as the entry does."""
    import __spark_entry__ as entry

    tables = {
        "events": (", ".join(f"({i}, timestamp_seconds({1_704_067_200 + 600 * (i // 3)}), {i % 3 + 1}, '{k}', {i}.5, 'k={i % 4 + 1}')"
                             for i, k in enumerate(["signup", "click", "view", "click", "purchase", "error", "click"] * 20, start=1)),
                   "event_id, ts, user_id, event_type, value, props"),
        "supplier": (", ".join(f"({i}, 'S{i}', {i % 25}, 1.5)" for i in range(1, 6)), "s_suppkey, s_name, s_nationkey, s_acctbal"),
        "customer": (", ".join(f"({i}, 'C{i}', {i % 25}, 1.5)" for i in range(40)), "c_custkey, c_name, c_nationkey, c_acctbal"),
        "part": (", ".join(f"({i}, 'P{i}', {i % 50 + 1}, 9.5D)" for i in range(1, 12)), "p_partkey, p_name, p_size, p_retailprice"),
        "nation": (", ".join(f"({i}, 'N{i}', {i % 5})" for i in range(25)), "n_nationkey, n_name, n_regionkey"),
        "region": (", ".join(f"({i}, 'R{i}')" for i in range(5)), "r_regionkey, r_name"),
        "orders": (", ".join(f"({i}, {i % 5 + 1}, 10.5, timestamp'2024-01-0{i % 9 + 1}')" for i in range(1, 60)),
                   "o_orderkey, o_custkey, o_totalprice, o_orderdate"),
        "lineitem": (", ".join(f"({i // 4}, {i % 4 + 1}, {i % 10 + 1}, {20 + i // 4 % 20}, {i * 7 % 50 + 1}, '{'R' if i % 3 == 0 else 'N'}', "
                               f"'{'FO'[i % 2]}', timestamp'2024-01-{i % 27 + 1:02d}')" for i in range(4, 900)),
                     "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate")}
    for name, (given, columns) in tables.items():
        spark.sql(f"SELECT * FROM VALUES {given} AS t({columns})").write.parquet(f"{tmp_path}/world/{name}.parquet")
    return entry.World(spark, f"{tmp_path}/world")


def test_awards_are_judged_without_storing_all_events(small_world, monkeypatch):
    import __spark_entry__ as entry

    w, stored = small_world, []
    monkeypatch.setattr(entry, "_stored", {})
    monkeypatch.setattr(entry.World, "stored", lambda self, name, build, partition_by=None: stored.append(name) or build().localCheckpoint())
    short = rows(w.r("R13"))
    assert stored == ["award_log"] and short
    assert short == rows(rules.wrong_amount(w.stg(), w.creatures))


def test_files_of_a_shuffle_go_when_the_stored_table_is_written(spark, tmp_path):
    def moved():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before, setting = moved(), spark.conf.get(DROP_SHUFFLES, "false")
    given = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    table, n = materialize(given, f"{tmp_path}/t")
    until = time.time() + 20
    while moved() - before and time.time() < until:
        time.sleep(0.2)
    assert not moved() - before
    assert n == table.count() == given.count() == 7
    assert spark.conf.get(DROP_SHUFFLES, "false") == setting


def test_fights_are_narrowed_before_their_levels_are_looked_up(spark, events):
    def fight(enc, who, outcome, t, damage=3):
        given = dict(encounter_id=enc, character_id=who)
        return [dict(event_type="encounter_started", encounter_kind="pve", zone_id="z", creature_id="k", t=t, **given),
                dict(event_type="encounter_ended", outcome=outcome, t=t + 9, **given),
                *([dict(event_type="pve_damage_dealt", damage=damage, t=t, **given)] if damage else [])]

    log = events(*fight("e", "a", "victory", 0), *fight("f", "a", "defeat", 50), *fight("g", "a", "victory", 99), *fight("h", "a", "victory", 99, None),
                 *fight("e", "b", "victory", 0)).withColumn("opponent_character_ids", F.lit(None).cast("array<string>"))
    creatures = spark.createDataFrame([("k", "boss"), ("k", "boss")], "creature_id string, rank string")  # listed twice
    levels = spark.createDataFrame([("a", at(-9), 7, 1), ("a", at(60), 12, 11)], "character_id string, valid_from timestamp, level int, bracket_min_level int")
    names = reports.WON_COLUMNS
    for hot in (0, 2_000_000):
        whole = facts.encounter_participation(log, creatures, levels, hot=hot)
        some = facts.encounter_participation(log, creatures, levels, hot=hot, columns=names, only=reports.won_fight())
        assert some.columns == names
        assert rows(some) == rows(whole.where(reports.won_fight()).select(*names)) and some.count() == 6
        stored = [f for f in some.inputFiles() if "/fights-" in f]
        assert stored and set(spark.read.parquet(*stored).columns) == {"character_id", "started_at", "outcome", "duration_s", "damage_done"}


def test_the_report_on_won_fights_stores_no_more_than_it_reads(small_world, monkeypatch):
    import __spark_entry__ as entry

    w, stored, plain_store = small_world, [], entry.World.stored
    monkeypatch.setattr(entry, "_stored", {})
    monkeypatch.setattr(entry.World, "stored", lambda self, name, build, partition_by=None: (
        stored.append(name), plain_store(self, name, build, partition_by))[1])
    short = rows(entry.REGISTRY["rate_percentile"](w))
    assert short and set(stored) == {"levels", "damage", "custody_to_count", "award_log", "won_fights", "offenders", "people"}
    tally = rows(w.tallied())
    entry._stored.clear()
    given = findings.tallied([w.rule(r) for r in entry.RULE_KEYS], findings.rule_catalogue(w.spark), w.characters)
    assert rows(given) == tally and {"custody", "R10"} <= set(stored)
    assert rows(entry.plain(reports.dps_percentile(w.fights(), w.people(), min_fights=5))) == short
    assert {r[0] for r in tally} >= {"R02", "R09", "R13"}


def test_hot_keys_are_counted_by_bucket_first(spark, tmp_path):
    given = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE 'k' || id END AS k", "id % 2 AS side")
    for i, (keys, limit, want) in enumerate([(["k"], 1500, [("hot",), (None,)]), (["k", "side"], 999, [("hot", 0), ("hot", 1), (None, 0), (None, 1)]),
                                             (["k"], 2000, []), (["k"], 0, None)]):
        for buckets in (65_536, 2):
            got = measure_hot_keys(given, keys, f"{tmp_path}/{i}-{buckets}", limit, buckets)
            assert got.count == got.table.count() == (2002 if want is None else len(want))
            assert want is None or rows(got.table) == sorted(want, key=str)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    keys = spark.range(0, 4000, 1, 4).selectExpr("'k' || id AS k").mapInArrow(count, "k string")
    assert measure_hot_keys(keys, ["k"], f"{tmp_path}/none", 1000).count == 0 and seen.value == 4000  # no second reading where nothing is hot
