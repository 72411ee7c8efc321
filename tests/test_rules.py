import datetime as dt

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from eventmart.operators import history
from eventmart.plans import findings, rules


def fired(df, *names):
    return rows(df, *(names or ("evidence_event_ids",)))


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([("a", "acc_a", "red", "mage", 5), ("b", "acc_b", "red", "mage", 5), ("c", "acc_c", "blue", "rogue", 5)],
                                 "character_id string, account_id string, faction string, class_id string, level int")


def hit(who, fight, t, damage=10, kind="pvp_damage_dealt", **more):
    return dict(event_type=kind, character_id=who, encounter_id=fight, t=t, damage=damage, target_character_id="x", **more)


def test_r01_needs_one_instant_of_one_fight(events):
    hits = events(hit("a", "f", 0), hit("a", "f", 0), hit("a", "f", 0.000001), hit("a", "g", 0), hit("b", "f", 0))
    out = rules.burst_damage(hits)
    assert fired(out, "character_id", "detail", "evidence_event_ids", "evidence_part") == [
        ("a", "2 hits at the same instant, 20 damage on x", [1, 2], 0)]


def test_r01_monstrous_burst_keeps_all_evidence_in_parts(events):
    out = rules.burst_damage(events(*[hit("a", None, 0) for _ in range(300)]), part_rows=40).collect()
    assert sorted(i for r in out for i in r.evidence_event_ids) == list(range(1, 301))
    assert len(out) > 1 and max(len(r.evidence_event_ids) for r in out) < 120
    assert {r.detail for r in out} == {"300 hits at the same instant, 3000 damage on x"}
    assert [r.evidence_part for r in out].count(0) == 1 and {r.evidence_first for r in out} == {1}
    assert 1 in next(r.evidence_event_ids for r in out if r.evidence_part == 0)


def test_r02_second_transfer_without_holding(events):
    def trade(giver, taker, t):
        return dict(event_type="trade_completed", items_given=["i"], character_id=giver, counterpart_character_id=taker, t=t)

    def run(*moves):
        custody = history.custody_chain(history.item_moves(events(*moves)))
        return fired(rules.item_duplication(custody, slice_seconds=1, hot=0))

    assert run(trade("a", "b", 0), trade("a", "c", 5)) == [([1, 2],)]
    assert run(trade("a", "b", 0), trade("b", "a", 3), trade("a", "c", 5)) == []
    assert run(trade("a", "b", 0)) == []


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_r03_boundaries(events, hot):
    def run(*steps):
        e = events(*[dict(event_type=k, character_id="a", slot=s, item_instance_id="i", t=t) for k, s, t in steps])
        return fired(rules.equip_stacking(e, slice_seconds=1, hot=hot))

    on, off = "item_equipped", "item_unequipped"
    assert run((on, "h", 0.2), (on, "h", 1.199)) == [([1, 2],)]
    assert run((on, "h", 0.2), (on, "h", 1.2)) == []
    assert run((on, "h", 0), (off, "h", 0.2), (on, "h", 0.5)) == []
    assert run((on, None, 0), (on, None, 0.5)) == []
    assert run((on, "h", 0), (on, "g", 0.5)) == []


def test_r03_detail(events):
    e = events(*[dict(event_type="item_equipped", character_id="a", slot="h", item_instance_id="i", t=t) for t in (0, 0.25)])
    assert fired(rules.equip_stacking(e), "detail") == [("Equipped i in h 0.25 s after the previous equip, without unequipping",)]


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_r04_walking_speed(spark, events, hot):
    roads = spark.createDataFrame([("p", "q", 3038)], "zone_a_id string, zone_b_id string, min_distance_m int")

    def run(*steps):
        e = events(*[dict(event_type=k, character_id="a", zone_id=z, server_id="x", shard_seq=i, t=t) for i, (k, z, t) in enumerate(steps)])
        return fired(rules.speed_hack(e, roads, slice_seconds=100, hot=hot), "detail")

    walk = "zone_entered"
    assert run((walk, "p", 0), (walk, "q", 433)) == [("Walked p -> q in 433.0 s; minimum is 434.0 s (3038 m at 7 m/s)",)]
    assert run((walk, "p", 0), (walk, "q", 434)) == []
    assert run((walk, "p", 0), ("location_changed", "r", 10), (walk, "q", 50)) == []
    assert run((walk, "q", 0), (walk, "p", 5)) == []
    assert run((walk, "p", 0), ("session_login", "p", 5), (walk, "q", 5)) == []


def test_r05_requirement_against_level_at_that_time(spark, events, people):
    tpl = spark.createDataFrame([("t7", "Axe", 7), ("t6", "Bow", 6)], "item_template_id string, name string, level_requirement int")
    e = events(dict(event_type="item_equipped", character_id="a", item_instance_id="i", item_template_id="t7", t=0),
               dict(event_type="item_equipped", character_id="a", item_instance_id="i", t=1),
               dict(event_type="item_equipped", character_id="a", item_instance_id="j", item_template_id="t6", t=2),
               dict(event_type="item_equipped", character_id="a", item_instance_id="k", t=3),
               dict(event_type="level_up", character_id="b", new_level=7, t=5),
               dict(event_type="item_equipped", character_id="b", item_instance_id="i", t=5))
    levels = history.level_history(e, people)
    out = rules.gear_above_level(e, tpl, levels)
    assert fired(out, "evidence_event_ids", "detail") == [([1], "Equipped Axe (requires level 7) at level 5"),
                                                         ([2], "Equipped Axe (requires level 7) at level 5")]


def test_r06_bound_is_halved_where_no_critical_hit_is_possible(spark, events, people):
    abilities = spark.createDataFrame([("x", 100, 10)], "ability_id string, base_damage int, damage_per_level int")
    caps = spark.createDataFrame([(1, 10, 100)], "bracket_min_level int, bracket_max_level int, max_gear_score int")
    # (100 + 10 * 5 + 50) * 1.1 * 2 = 440
    e = events(hit("a", "f", 0, 440, ability_id="x"), hit("a", "f", 1, 441, ability_id="x"),
               hit("a", "f", 2, 220, "pve_damage_dealt", ability_id="x"), hit("a", "f", 3, 221, "pve_damage_dealt", ability_id="x"),
               hit("a", "f", 4, 999), hit("ghost", "f", 5, 999, ability_id="x"))
    hits = rules.damage_hits(e, people, abilities, history.level_history(e, people), caps)
    assert hits.count() == 4
    assert fired(rules.hit_above_max(hits), "evidence_event_ids", "detail") == [
        ([2], "Hit for 441, maximum possible 440"), ([4], "Hit for 221, maximum possible 440")]


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_r07_cooldowns(spark, events, hot):
    abilities = spark.createDataFrame([("x", 10), ("y", None)], "ability_id string, cooldown_s int")

    def run(*uses):
        e = events(*[dict(event_type="ability_used", character_id="a", ability_id=b, t=t) for b, t in uses])
        return fired(rules.ability_cooldown(e, abilities, slice_seconds=1, hot=hot))

    assert run(("x", 0), ("y", 1.498)) == [([2],)]
    assert run(("x", 0), ("y", 1.4995)) == []
    assert run(("x", 0), ("y", 5), ("x", 9.998)) == [([3],)]
    assert run(("x", 0), ("x", 9.9995)) == []
    assert run(("y", 0), ("y", 5)) == []
    assert run((None, 0), (None, 1)) == [([2],)]


@pytest.mark.parametrize("hot", [0, 2_000_000])
def test_r08_reuse(events, hot):
    def run(gap):
        e = events(*[dict(event_type="amulet_used", character_id="a", t=t) for t in (0, gap)])
        return fired(rules.reuse_within(e, slice_seconds=60, hot=hot), "detail")

    assert run(3599) == [("Amulet used 60.0 min after the previous use",)]
    assert run(3600) == []


def test_r09_bound_before_the_move(events):
    def run(*steps):
        e = events(*[dict(event_type=k, item_instance_id="i", items_given=["i"], character_id="a", counterpart_character_id="b", t=t)
                     for k, t in steps])
        return fired(rules.bound_item_moved(history.custody_chain(history.item_moves(e)), e))

    assert run(("item_equipped", 0), ("item_equipped", 1), ("trade_completed", 2)) == [([1, 3],)]
    assert run(("trade_completed", 0), ("item_equipped", 1)) == []
    assert run(("item_equipped", 1), ("trade_completed", 1)) == []
    assert run(("item_equipped", 0), ("item_sold", 1)) == []


def trade_side(who, zone, trade="t"):
    return dict(event_type="trade_completed", trade_id=trade, character_id=who, zone_id=zone, t=0)


def test_r10_pairs(events, people):
    def run(*sides):
        return fired(rules.illegal_trade(events(*sides), people), "character_id", "evidence_event_ids")

    assert run(trade_side("a", "z"), trade_side("b", "z")) == []
    assert run(trade_side("c", "z"), trade_side("a", "z")) == [("a", [2, 1])]
    assert run(trade_side("a", "z"), trade_side("b", "y")) == [("a", [1, 2])]
    assert run(trade_side("a", "z"), trade_side("b", None)) == []
    assert run(trade_side("a", "z")) == []
    three = [trade_side("a", "z"), trade_side("b", "z"), trade_side("c", "z")]
    assert run(*three) == [("a", [1, 3]), ("b", [2, 3])]  # whoever is the smaller side of an illegal pair is named


@pytest.mark.parametrize("n", [2, 3, 16, 17, 200])
def test_r10_any_number_of_sides(spark, events, n):
    who = [(f"p{i:03}", "acc", ["red", "blue", None][i * i % 3 if n > 2 else i], "m") for i in range(n)]
    zone = [["y", "z", None][(i // 2) % 3] for i in range(n)]
    people = spark.createDataFrame(who, "character_id string, account_id string, faction string, class_id string")
    out = rules.illegal_trade(events(*[trade_side(w[0], z) for w, z in zip(who, zone)]), people)

    def differ(i, j):
        return any(x[i] is not None and x[j] is not None and x[i] != x[j] for x in ([w[2] for w in who], zone))

    pairs = [(j, i) for i in range(n) for j in range(i) if differ(j, i)]
    least, most = {}, {}
    for j, i in pairs:
        least[i], most[j] = min(j, least.get(i, n)), max(i, most.get(j, 0))
    want = {(j, i) for i, j in least.items()} | set(most.items())
    found = out.collect()
    assert sorted(tuple(r.evidence_event_ids) for r in found) == sorted((j + 1, i + 1) for j, i in want)
    assert {r.character_id for r in found} == {who[j][0] for j, _ in pairs}  # every actor of any illegal pair


def test_r11_transports(spark, events, people):
    lines = spark.createDataFrame([("open", "Boat", None, "z", "1"), ("red", "Cart", "red", "z", "2")],
                                  "transport_id string, name string, faction string, from_zone_id string, available_from_version string")
    versions = spark.createDataFrame([("1", at(-999)), ("2", at(100))], "version string, released_at timestamp")

    def run(who, line, zone, t):
        e = events(dict(event_type="transport_boarded", character_id=who, transport_id=line, zone_id=zone, t=t))
        return rules.transport_misuse(e, lines, people, versions).count()

    assert (run("c", "red", "z", 200), run("a", "red", "y", 200), run("a", "red", "z", 99)) == (1, 1, 1)
    assert (run("c", "open", "z", 0), run("a", "red", "z", 100), run("a", "red", None, 200)) == (0, 0, 0)


def test_r12_and_r13(spark, events):
    zones = spark.createDataFrame([("h", "hub"), ("w", "wild")], "zone_id string, zone_type string")
    e = events(*[dict(event_type="encounter_started", zone_id=z, encounter_kind="pvp", t=0) for z in ("h", "w", None)])
    assert fired(rules.combat_in_hub(e, zones), "evidence_event_ids", "detail") == [([1], "pvp fight started in h")]
    ref = spark.createDataFrame([("c", "Rat", 7)], "creature_id string, name string, xp_reward bigint")
    xp = events(*[dict(event_type="xp_gained", creature_id=c, xp_amount=x, t=0) for c, x in (("c", 7), ("c", 8), ("c", None), ("u", 1))])
    assert fired(rules.wrong_amount(xp, ref), "evidence_event_ids", "detail") == [([2], "Received 8 XP from Rat, which grants 7")]


def found(spark, *specs):
    schema = ("rule_id string, character_id string, occurred_at timestamp, encounter_id string, detail string, "
              "evidence_event_ids array<bigint>, evidence_server_event_ids array<string>, evidence_part int, evidence_first bigint")
    return spark.createDataFrame([(r, c, at(t), None, "d", [i], [f"s{i}"], part, i - part) for i, (r, c, t, part) in enumerate(specs)], schema)


def test_violations_offenders_results(spark, people):
    f = found(spark, ("R03", "a", 5, 0), ("R04", "a", 4, 0), ("R05", "a", 3, 0), ("R03", "b", 2, 0), ("R04", "b", 2, 0),
              ("R01", "c", 1, 0), ("R01", "c", 1, 1), ("R01", "ghost", 0, 0), ("R03", None, 9, 0))
    cat = findings.rule_catalogue(spark)
    v = findings.violations([f], cat, people)
    assert [r.violation_id for r in v.orderBy("occurred_at", "rule_id", "character_id", "evidence_event_ids").collect()] == [1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert rows(v.where("NOT character_known"), "character_id") == [("ghost",), (None,)]
    assert v.select("violation_key").distinct().count() == 8
    assert rows(findings.evidence(v).where("violation_id = 2"), "evidence_part", "place", "event_id", "server_event_id") == [(0, 0, 5, "s5"), (1, 0, 6, "s6")]
    assert rows(findings.offenders(v)) == rows(findings.offenders(findings.described([f], cat, people)))
    o = {r.character_id: r for r in findings.offenders(v).collect()}
    assert set(o) == {"a", "b", "c"}
    assert [(o[c].confirmed_cheater, o[c].distinct_rules, o[c].violations) for c in "abc"] == [(True, 3, 3), (False, 2, 2), (True, 1, 1)]
    assert o["a"].rules_broken == ["Equip stacking", "Gear above level", "Speed hack"]
    res = {r.rule_id: (r.violations, r.characters) for r in findings.rule_results(cat, v).collect()}
    assert len(res) == 13 and res["R01"] == (2, 2) and res["R03"] == (3, 2) and res["R13"] == (0, 0)
    assert sum(n for n, _ in res.values()) == 8


def test_a_burst_is_one_violation_of_any_size(spark, events, people):
    """Ids and keys don't depend on how many rows the evidence of a burst is stored in."""
    hits = events(*[hit("a", None, 5) for _ in range(100)], hit("a", "f", 5), hit("a", "f", 5), hit("b", "g", 1), hit("b", "g", 1))
    cat = findings.rule_catalogue(spark)
    plain, cut = (findings.violations([rules.burst_damage(hits, part_rows=n)], cat, people) for n in (50_000, 7))
    assert plain.count() == 3 and cut.count() > 10
    names = ["violation_id", "violation_key", "character_id", "detail"]
    assert rows(plain.select(*names)) == rows(cut.select(*names).distinct())
    assert rows(findings.evidence(plain), "violation_id", "event_id") == rows(findings.evidence(cut), "violation_id", "event_id")


def test_lineage_finds_the_delivered_rows(spark, people):
    raw = spark.createDataFrame([(0, "s0", "x", 1, "b", "f", "e", at(0), "{}"), (5, "s5", "x", 2, "b", "f", "e", at(0), "{}")],
                                "event_id bigint, server_event_id string, server_id string, shard_seq bigint, source_batch_id string, "
                                "source_file string, event_type string, event_ts timestamp, body string")
    v = findings.violations([found(spark, ("R01", "a", 0, 0))], findings.rule_catalogue(spark), people)
    assert rows(findings.violation_lineage(v, raw, 1), "violation_id", "event_id", "shard_seq") == [(1, 0, 1)]
    assert findings.violation_lineage(v, raw, 2).count() == 0
    assert isinstance(v.first().occurred_at, dt.datetime) and v.where(F.col("severity") == "high").count() == 1
