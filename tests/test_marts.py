import datetime as dt

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from eventmart.operators import history
from eventmart.plans import checks, dims, facts, reports


@pytest.fixture()
def creatures(spark):
    return spark.createDataFrame([("crt_1", "Rat", "normal"), ("crt_2", "Dragon", "boss")], "creature_id string, name string, rank string")


@pytest.fixture()
def templates(spark):
    return spark.createDataFrame([("t1", "Axe", "rare", 30, "hand", "gear"), ("t2", "Ore", "common", 5, None, "material")],
                                 "item_template_id string, name string, rarity string, item_level int, slot string, item_kind string")


def test_dim_date(spark):
    d = dims.calendar(spark, "2026-08-10", "2026-09-11", "2026-08-26 09:41:00")
    first = d.orderBy("date_day").first()
    assert d.count() == 32 and d.where("is_weekend").count() == 8 and d.where("is_patch_2_1").count() == 16
    assert (first.date_key, first.day_name, first.iso_day_of_week, first.week_start) == (20260810, "Monday", 1, dt.date(2026, 8, 10))


def test_dim_character_keeps_unflagged(spark):
    people = spark.createDataFrame([("a", "A", "acc", "red", "m", 10, 1, 2), ("b", "B", "acc", "red", "m", 11, 1, 2), ("x", "X", "none", "red", "m", 1, 1, 1)],
                                   "character_id string, name string, account_id string, faction string, class_id string, level int, xp bigint, gold bigint")
    for c in ("zone_id", "sub_zone_id", "created_at", "last_login_at", "last_logout_at"):
        people = people.withColumn(c, F.lit(None).cast("string"))
    accounts = spark.createDataFrame([("acc", at(0))], "account_id string, created_at timestamp")
    classes = spark.createDataFrame([("m", "Mage", "cloth", 0.1)], "class_id string, name string, armor_type string, crit_chance double")
    off = spark.createDataFrame([("a", True)], "character_id string, confirmed_cheater boolean")
    got = dims.dim_character(people, accounts, classes, off)
    assert rows(got, "character_id", "current_bracket_min_level", "is_confirmed_cheater") == [("a", 1, True), ("b", 11, False)]
    assert rows(reports.population(got), "bracket_min_level", "level_bracket", "characters") == [(1, "1-10", 1), (11, "11-20", 1)]


def test_allowed_classes_are_null_without_any(spark, templates):
    allowed = spark.createDataFrame([("t1", "z"), ("t1", "a")], "item_template_id string, class_id string")
    assert rows(dims.dim_item_template(templates, allowed), "item_template_id", "allowed_classes") == [("t1", ["a", "z"]), ("t2", None)]


def test_participation(spark, events, creatures):
    def e(kind, t, who="a", **kw):
        return dict(event_type=kind, encounter_id="f", character_id=who, t=t, **kw)

    log = events(e("encounter_started", 0, encounter_kind="pve"), e("encounter_started", 1, encounter_kind="pvp", creature_id="crt_2", party_id="p"),
                 e("encounter_ended", 9, outcome="victory"), e("pve_damage_dealt", 2, damage=5), e("pve_damage_received", 2, damage=3),
                 e("encounter_started", 0, "b"), e("encounter_damage_summary", 1, "b", summary_damage_done='[{"total":4},{"total":1}]'),
                 e("encounter_damage_summary", 2, "b", summary_damage_done='[{"total":2}]'), e("pve_damage_dealt", 3, "b", damage=100),
                 e("pve_damage_dealt", 1, "c", damage=8), e("encounter_started", 0, None))
    people = spark.createDataFrame([("a", 12)], "character_id string, level int")
    got = facts.encounter_participation(log, creatures, history.level_history(log, people))
    names = ["character_id", "encounter_kind", "creature_rank", "in_party", "duration_s", "damage_done", "damage_received", "level_at_start"]
    assert rows(got, *names) == [("a", "pve", "boss", True, 9.0, 5, 3, 12), ("b", None, None, False, None, 7, None, None)]
    kills = facts.fct_creature_kills(got)
    assert rows(kills, "encounter_id", "participants", "creature_rank") == [("f", 1, "boss")]
    assert rows(reports.kills_by_day(kills), "creatures_killed", "normal", "boss") == [(1, 0, 1)]


def test_deaths_and_their_shares(events, creatures):
    d = facts.fct_deaths(events(*[dict(event_type="character_died", character_id="v", killer_type=k, killer_id=i, t=0) for k, i in (
        ("character", "chr_9"), (None, "chr_9"), ("creature", "crt_1"), (None, "crt_1"), (None, None))]), creatures)
    assert [r[0] for r in d.orderBy("event_id").select("killer_category").collect()] == ["player", "player", "creature", "unknown", "unknown"]
    assert [tuple(r) for r in reports.deaths_by_killer(d).collect()] == [("boss", 0, 0.0), ("player", 2, 40.0), ("creature", 1, 20.0), ("unknown", 2, 40.0)]
    assert rows(reports.deaths_by_day(d), "players_killed", "distinct_victims") == [(5, 1)]


def test_loot_and_pivot(events, templates):
    e = events(dict(event_type="item_dropped", item_instance_id="i", item_template_id="t1", creature_id="crt_1", t=0),
               dict(event_type="item_looted", item_instance_id="i", t=1), dict(event_type="item_looted", item_instance_id="j", t=1),
               dict(event_type="item_looted", item_instance_id="k", item_template_id="t2", t=90_000))
    loot = facts.fct_loot(e, templates)
    assert rows(loot, "event_id", "item_template_id", "rarity", "creature_id") == [(2, "t1", "rare", "crt_1"), (3, None, None, None), (4, "t2", "common", None)]
    pivot = reports.looted_by_rarity(loot)
    assert rows(pivot, "common", "rare", "epic", "unknown") == [(0, 1, 0, 1), (1, 0, 0, 0)]


MONEY = [dict(event_type="gold_credited", character_id="a", gold_amount=10, t=0), dict(event_type="gold_credited", character_id="a", t=0),
         dict(event_type="item_sold", character_id="a", price=7, item_template_id="t1", item_instance_id="i", t=1),
         dict(event_type="item_sold", character_id="a", price=2, item_instance_id="j", t=1),
         dict(event_type="trade_completed", trade_id="t", character_id="a", gold_given=5, gold_received=0, t=2),
         dict(event_type="trade_completed", trade_id="t", character_id="b", gold_given=0, gold_received=5, t=2),
         dict(event_type="trade_completed", trade_id="u", character_id="a", gold_given=0, gold_received=0, t=2),
         dict(event_type="auction_purchased", character_id="b", price=100, t=3),
         dict(event_type="auction_sold", character_id="a", buyer_character_id="b", price=100, auction_cut=5, t=3)]


def test_ledger_and_flow(events, templates):
    e = events(*MONEY)
    ledger = facts.fct_gold_ledger(e, templates)
    assert rows(ledger, "movement", "flow_type", "amount", "character_id", "item_rarity") == sorted([
        ("creature_drop", "source", 10, "a", None), ("creature_drop", "source", None, "a", None), ("merchant_sale", "source", 7, "a", "rare"),
        ("merchant_sale", "source", 2, "a", None), ("trade", "transfer", -5, "a", None), ("trade", "transfer", 5, "b", None),
        ("auction_purchase", "transfer", -100, "b", None), ("auction_sale", "transfer", 95, "a", None),
        ("auction_house_cut", "sink", -5, None, None)], key=str)
    flow = {(r.flow_type, r.line): r.gold for r in reports.gold_flow(ledger).collect()}
    assert flow[("total", "net")] == flow[("total", "gold_in")] + flow[("total", "gold_out")] == 14
    assert flow[("source", "merchant_sale_unknown")] == 2 and len(flow) == 7
    nothing = reports.gold_flow(ledger.where("1 = 0"))
    assert rows(nothing) == [("total", "gold_in", None), ("total", "gold_out", None), ("total", "net", None)]


def test_lost_template_of_a_sale_can_be_recovered(events, templates):
    drops = events(dict(event_id=1, event_type="item_dropped", item_instance_id="j", item_template_id="t2"))
    got = facts.fct_gold_ledger(events(*MONEY), templates, drops).where("movement = 'merchant_sale'")
    assert rows(got, "amount", "item_rarity") == [(2, "common"), (7, "rare")]


def test_transactions(events, templates):
    t = facts.fct_transactions(events(*MONEY))
    assert rows(t, "transaction_type", "character_id", "counterpart_character_id", "gold_amount", "one_sided") == sorted([
        ("merchant_sale", "a", None, 7, False), ("merchant_sale", "a", None, 2, False), ("trade", "a", "b", 5, False),
        ("trade", "a", "a", 0, True), ("auction_sale", "a", "b", 100, False)], key=str)
    window = reports.transactions_in_window(t, F.lit(at(1)), F.lit(at(3))).collect()
    assert [tuple(r) for r in window] == [("merchant_sale", 2, 9), ("trade", 2, 5), (None, 4, 14)]
    assert [tuple(r) for r in reports.sold_by_rarity(t, templates).collect()] == [("rare", 1, 7), ("unknown", 1, 2)]


def test_activity_exact_and_sketched(spark, events):
    zones = spark.createDataFrame([("s", "z", "Sub", "Zone")], "sub_zone_id string, zone_id string, sub_zone_name string, zone_name string")
    e = events(*[dict(event_type="x", sub_zone_id=s, character_id=c, t=t) for s, c, t in
                 (("s", "a", 0), ("s", "a", 1), ("s", "b", 2), ("s", None, 3), ("s", "a", 3600), ("u", "a", 0), (None, "a", 0))])
    for approximate in (False, True):
        got = facts.fct_subzone_activity(e, zones, approximate)
        assert rows(got, "activity_hour", "events", "active_characters") == [(at(0), 4, 2), (at(3600), 1, 1)]
    heat = reports.heatmap(facts.fct_subzone_activity(e, zones), zones)
    assert rows(heat, "hour_utc", "events", "avg_active_characters") == [(12, 4, 2.0), (13, 1, 1.0)]


def test_gear_score_is_capped(spark, templates):
    people = spark.createDataFrame([("a", "m", 5, 1), ("b", "m", 15, 11)], "character_id string, class_id string, current_level int, current_bracket_min_level int")
    worn = spark.createDataFrame([("a", "t1", True), ("a", "t1", True), ("a", "t1", False), ("a", "t2", True), (None, "t1", True)],
                                 "character_id string, item_template_id string, is_equipped boolean")
    caps = spark.createDataFrame([(1, 10, 50), (11, 20, 90)], "bracket_min_level int, bracket_max_level int, max_gear_score int")
    got = facts.fct_character_gear(people, worn, templates, caps)
    assert rows(got, "character_id", "equipped_items", "raw_gear_score", "gear_score", "bracket_cap") == [("a", 2, 60, 50, 50), ("b", 0, 0, 0, 90)]


def test_daily_and_weekly(spark):
    days = dims.calendar(spark, "2026-08-20", "2026-08-28", "2026-08-26")
    s = spark.createDataFrame([("a", at(0), at(0).date(), 1800.0), ("a", at(9), at(0).date(), 1800.0), ("b", at(9), at(0).date(), 360.0)],
                              "character_id string, login_at timestamp, session_date date, duration_s double")
    got = reports.daily_active(days, s).collect()
    assert len(got) == 8 and tuple(got[0])[2:] == (2, 3, 1.1) and tuple(got[1])[2:] == (0, 0, None)
    week = {r.day_name: r for r in reports.weekly_pattern(days, s).collect()}
    assert (week["Thursday"].days_observed, week["Thursday"].avg_active_players, week["Thursday"].avg_sessions) == (2, 1.0, 2.0)
    partial = reports.weekly_pattern(days, s, F.lit("2026-08-27").cast("date"))
    assert {r.day_name: r.days_observed for r in partial.collect()}["Thursday"] == 1


def test_dps_leaves_out_offenders_and_rare_fighters(spark):
    people = spark.createDataFrame([(c, "Mage", c == "cheat") for c in ("a", "b", "c", "cheat")], "character_id string, class_name string, is_confirmed_cheater boolean")
    fights = spark.createDataFrame([(c, 1, "victory", 10.0, d) for c, d in (("a", 100), ("a", 100), ("b", 50), ("b", 50), ("cheat", 9999), ("cheat", 9999), ("c", 5))]
                                   + [("a", 1, "defeat", 10.0, 1), ("a", 1, "victory", 0.0, 1), ("a", 1, "victory", 5.0, None)],
                                   "character_id string, bracket_min_level int, outcome string, duration_s double, damage_done bigint")
    got = reports.dps_percentile(fights, people, min_fights=2)
    assert rows(got, "character_id", "dps", "fights", "peer_count", "dps_percentile", "player_message") == [
        ("a", 10.0, 2, 1, 100.0, "Your damage per second is higher than 100% of other Mages between levels 1 and 10."),
        ("b", 5.0, 2, 1, 0.0, "Your damage per second is higher than 0% of other Mages between levels 1 and 10.")]


def test_player_360(spark):
    people = spark.createDataFrame([("a", "A", "Mage", False), ("b", "B", "Mage", False), ("x", "X", "Mage", True)],
                                   "character_id string, character_name string, class_name string, is_confirmed_cheater boolean")
    gear = spark.createDataFrame([("a", "m", 61, 70, 5), ("b", "m", 61, 70, 9), ("x", "m", 61, 70, 7)],
                                 "character_id string, class_id string, bracket_min_level int, current_level int, gear_score int")
    s = spark.createDataFrame([("a", at(0).date(), 7200.0), ("a", at(0).date(), 1800.0)], "character_id string, session_date date, duration_s double")
    xp = spark.createDataFrame([("a", 100), ("b", 5)], "character_id string, xp_amount bigint")
    got = {r.character_id: r for r in reports.player_360(gear, people, s, xp).collect()}
    assert (got["a"].total_hours_played, got["a"].days_played, got["a"].avg_xp_per_day_played, got["a"].peer_count) == (2.5, 1, 100.0, 1)
    assert (got["b"].gear_percentile, got["x"].gear_percentile, got["x"].peer_count, got["b"].avg_xp_per_day_played) == (100.0, 50.0, 2, None)
    assert got["b"].player_message == "Your gear is better than 100% of other Mages between levels 61 and 70."
    assert reports.player_360(gear, people, s, xp, "a").count() == 1


def test_chain_is_excused_by_a_lost_event(spark, events):
    e = events(*[dict(event_type=k, character_id=c, server_id="x", t=t) for k, c, t in
                 (("use", "a", 0), ("cool", "a", 1), ("go", "a", 2), ("use", "b", 10), ("go", "b", 11), ("use", "c", 20), ("go", "c", 21))])
    gaps = spark.createDataFrame([("x", at(10.2), at(10.8))], "server_id string, prev_event_ts timestamp, next_event_ts timestamp")
    for hot in (0, 2_000_000):
        got = checks.chain_completeness(e, ["use", "cool", "go"], gaps, hot=hot)
        assert rows(got, "character_id", "complete", "excused") == [("a", True, False), ("b", False, True), ("c", False, False)]


def test_thresholds_pairs_balances(spark, events):
    levels = spark.createDataFrame([(1, 0), (2, 100), (3, 300)], "level int, xp_required bigint")
    e = events(*[dict(new_level=lv, xp_total=x) for lv, x in ((2, 100), (2, 299), (2, 300), (2, 99), (3, 9999), (None, 1))])
    assert rows(checks.threshold_mismatch(e, levels), "event_id") == [(3,), (4,)]
    pairs = spark.createDataFrame([("m", "x")], "c string, a string")
    used = spark.createDataFrame([("m", "x"), ("m", "y"), (None, "x")], "c string, a string")
    assert rows(checks.not_allowed(used, pairs, ["c", "a"])) == [("m", "y")]
    money = spark.createDataFrame([("a", at(i), i, m, b) for i, (m, b) in enumerate([(5, 5), (5, 10), (5, 16), (1, 17)])],
                                  "who string, ts timestamp, id int, m bigint, b bigint")
    assert rows(checks.balance_breaks(money, "who", "ts", "id", "m", "b", hot=0, slice_seconds=1), "id", "difference") == [(2, 1)]


def test_members_at_once(spark):
    stays = spark.createDataFrame([("p", "a", at(0), at(10)), ("p", "b", at(10), at(20)), ("p", "c", at(5), None), ("q", "a", at(0), at(0))],
                                  "g string, m string, s timestamp, e timestamp")
    for hot in (0, 2_000_000):
        got = checks.concurrent_members(stays, "g", "m", "s", "e", slice_seconds=3, hot=hot)
        assert rows(got, "g", "max_members") == [("p", 2), ("q", 0)] or rows(got, "g", "max_members") == [("p", 2), ("q", 1)]


def test_drop_rates_respect_versions(spark):
    versions = spark.createDataFrame([("1", at(0)), ("2", at(100))], "version string, released_at timestamp")
    entries = spark.createDataFrame([("old", "c", "t", 0.5, "1", "2"), ("new", "c", "t", 0.1, "2", None), ("gold", "c", None, 0.1, "1", None)],
                                    "loot_entry_id string, creature_id string, item_template_id string, drop_chance double, valid_from_version string, valid_to_version string")
    kills = spark.createDataFrame([("c", "1")] * 4 + [("c", "2")] * 10, "creature_id string, game_version string")
    drops = spark.createDataFrame([("c", "t", "1")] * 2, "creature_id string, item_template_id string, game_version string")
    assert rows(checks.drop_rates(kills, drops, entries, versions), "loot_entry_id", "kills", "drops", "observed", "expected") == [
        ("new", 10, 0, 0.0, 0.1), ("old", 4, 2, 0.5, 0.5)]


def test_clusters_and_parties(spark):
    acc = spark.createDataFrame([(f"a{i}", "x", at(t)) for i, t in enumerate([0, 60, 150, 9999, 10_000])], "id string, k string, made timestamp")
    for hot in (0, 2_000_000):
        c = checks.creation_clusters(acc, ["k"], "made", 100, "id", slice_seconds=50, hot=hot)
        assert rows(checks.cluster_sizes(c, ["k"], "made", 2), "size", "first_at") == [(2, at(9999)), (3, at(0))]
    joined = spark.createDataFrame([("a0", "p"), ("a1", "p"), ("a2", "p"), ("a0", "q"), ("a3", "q")], "id string, party string")
    assert rows(checks.always_together(c, joined, ["k", "cluster"], "id", "party"), "cluster", "parties", "full_parties") == [(1, 2, 1), (2, 1, 0)]


def test_small_checks(spark, events):
    e = events(dict(event_type="session_logout", character_id="a", zone_id="z", t=0), dict(event_type="session_login", character_id="a", zone_id="y", t=1),
               dict(event_type="session_logout", character_id="a", zone_id="y", t=2), dict(event_type="session_login", character_id="a", zone_id="y", t=3))
    assert rows(checks.moved_while_away(e), "event_id", "logout_zone_id") == [(2, "z")]
    items = events(dict(event_type="item_dropped", item_instance_id="i", t=0), dict(event_type="item_looted", item_instance_id="i", t=1),
                   dict(event_type="item_looted", item_instance_id="j", t=0), dict(event_type="item_dropped", item_instance_id="j", t=1),
                   dict(event_type="item_looted", item_instance_id="k", t=0))
    assert rows(checks.no_origin(items, "item_instance_id", F.col("event_type") == "item_dropped"), "item_instance_id", "origin_at") == [("j", at(1)), ("k", None)]
    speed = spark.createDataFrame([("c", float(s)) for s in (10, 100, 100, 110)], "creature_id string, s double")
    assert rows(checks.fight_speed(speed, "creature_id", "s"), "fastest_s", "typical_s", "outlier") == [(10.0, 100.0, True)]
    flow = spark.createDataFrame([("a", "b", 5), ("b", "a", 2), ("a", "a", 9)], "g string, r string, n bigint")
    assert rows(checks.pair_net_flow(flow, "g", "r", F.col("n"))) == [("a", "b", 2, 5, 2, 3)]
    use = events(*[dict(event_type="x", t=t) for t in (0, 1, 86_400, 200_000, 200_001, 200_002)])
    got = checks.before_after(use, ["event_type"], "event_ts_utc", F.lit(at(150_000)))
    assert rows(got, "uses_before", "days_before", "uses_after", "days_after", "change_pct") == [(3, 2, 3, 1, 100.0)]
