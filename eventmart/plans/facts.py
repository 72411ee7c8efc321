"""Facts of the star schema, each with its grain in the docstring."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.bodies import json_list_sum
from eventmart.functions.columns import day, seconds_between
from eventmart.operators.asof import asof_join, bracket_join
from eventmart.operators.history import pair_sessions
from eventmart.operators.ordered import HOT_ROWS, Hot, all_cold
from eventmart.operators.quality import first_known
from eventmart.session import shared_folder
from eventmart.sources.landing import materialize

DEALT = ("pve_damage_dealt", "pvp_damage_dealt")
RECEIVED = ("pve_damage_received", "pvp_damage_received")


def fct_sessions(events: DataFrame, keep_open: bool = False, hot: Hot = HOT_ROWS) -> DataFrame:
    """One row per play session: a login and the logout that follows it."""
    return pair_sessions(events, keep_open=keep_open, hot=hot)


def encounter_participation(events: DataFrame, creatures: DataFrame, levels: DataFrame, hot: Hot = HOT_ROWS,
                            columns: Sequence[str] | None = None, only: Column | None = None) -> DataFrame:
    """One row per character and encounter.

    `columns` are those wanted (all by default), `only` is a condition on any but the level's: what no reader asks for is
    neither moved nor stored nor given a level.

    Damage of a fight's many hits is a hash aggregation. Times, counts and descriptive columns (of
    the smallest event id that has one) come from its few start and end events, which are moved as they
    are: text is not added up before a shuffle without a sort. Both are partitioned alike, so joining
    them moves nothing. Damage comes from the fight's summary if there is one, else from its hits.
    With hot characters fights are stored before their levels are looked up, which reads them twice.
    """
    kind = F.col("event_type")
    start, end = kind == "encounter_started", kind == "encounter_ended"
    summary = kind == "encounter_damage_summary"
    hit_done, hit_taken = kind.isin(*DEALT), kind.isin(*RECEIVED)
    by = ["encounter_id", "character_id"]
    rows = events.where((start | end | summary | hit_done | hit_taken)
                        & F.col("encounter_id").isNotNull() & F.col("character_id").isNotNull())

    def first(column: str, when: Column) -> Column:
        return F.min_by(column, F.when(when & F.col(column).isNotNull(), F.col("event_id"))).alias(column)

    numbers = rows.where(summary | hit_done | hit_taken).select(
        *by, F.when(summary, json_list_sum(F.col("summary_damage_done"))).alias("_done"),
        F.when(summary, json_list_sum(F.col("summary_damage_received"))).alias("_taken"),
        F.when(hit_done, F.col("damage")).alias("_hit"), F.when(hit_taken, F.col("damage")).alias("_got"))
    measured = numbers.groupBy(*by).agg(
        F.sum("_done").alias("_sum_done"), F.sum("_taken").alias("_sum_taken"), F.sum("_hit").alias("_hit_done"),
        F.sum("_got").alias("_hit_taken"))
    described = rows.where(start | end).repartition(*by).groupBy(*by).agg(
        F.count_if(start).alias("_starts"), F.min(F.when(start, F.col("event_ts_utc"))).alias("started_at"),
        F.max(F.when(end, F.col("event_ts_utc"))).alias("ended_at"),
        *[first(c, start) for c in ("encounter_kind", "creature_id", "opponent_character_ids", "party_id",
                                    "zone_id", "sub_zone_id")], first("outcome", end)).where(F.col("_starts") > 0)
    fights = described.join(measured, by, "left").drop("_starts")
    ranked = fights.join(creatures.select("creature_id", F.col("rank").alias("creature_rank")), "creature_id", "left")
    known = ranked.select(
        "encounter_id", "character_id", "encounter_kind", "creature_id", "creature_rank", "opponent_character_ids",
        "party_id", F.col("party_id").isNotNull().alias("in_party"), "zone_id", "sub_zone_id", "started_at",
        "ended_at", day("started_at").alias("encounter_date"),
        seconds_between("ended_at", "started_at").alias("duration_s"), "outcome",
        F.coalesce("_sum_done", "_hit_done").alias("damage_done"),
        F.coalesce("_sum_taken", "_hit_taken").alias("damage_received"))
    if only is not None:
        known = known.where(only)
    wanted = list(columns or [*known.columns, "level_at_start", "bracket_min_level"])
    known = known.select(*dict.fromkeys(["character_id", "started_at", *[c for c in wanted if c in known.columns]]))
    if not all_cold(hot, ["character_id"]):
        spark = events.sparkSession
        known, _ = materialize(known, f"{shared_folder(spark)}/fights-{uuid.uuid4().hex}")
    placed = asof_join(known, levels, ["character_id"], "started_at", "valid_from", ["level", "bracket_min_level"],
                       how="left", tie="level", hot=hot)
    return placed.withColumnRenamed("level", "level_at_start").select(*wanted)


def fct_deaths(events: DataFrame, creatures: DataFrame) -> DataFrame:
    """One row per death; a killer whose type was lost is a player if its id says so."""
    ranks = creatures.select(F.col("creature_id").alias("_creature"), "rank")
    died = events.where(F.col("event_type") == "character_died").join(ranks, F.col("killer_id") == F.col("_creature"), "left")
    by_player = (F.col("killer_type") == "character") | (F.col("killer_type").isNull()
                                                         & F.col("killer_id").startswith("chr_"))
    category = (F.when(by_player, "player").when(F.col("rank") == "boss", "boss")
                 .when(F.col("killer_type") == "creature", "creature").otherwise("unknown"))
    return died.select("event_id", "server_event_id", F.col("event_ts_utc").alias("died_at"),
                       day("event_ts_utc").alias("death_date"), "character_id", "encounter_id", "zone_id",
                       "sub_zone_id", "killer_type", "killer_id", category.alias("killer_category"))


def fct_creature_kills(participation: DataFrame) -> DataFrame:
    """One row per creature killed: a fight against it that at least one participant won."""
    won = participation.where((F.col("encounter_kind") == "pve") & (F.col("outcome") == "victory"))

    def first(column: str) -> Column:
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.col("character_id"))).alias(column)

    ended = F.max("ended_at")
    # moved as they are: a fight's few participants lie apart, and text is not added up before a shuffle without a sort
    return won.repartition("encounter_id").groupBy("encounter_id").agg(
        *[first(c) for c in ("creature_id", "creature_rank", "zone_id", "sub_zone_id")],
        ended.alias("killed_at"), ended.cast("date").alias("kill_date"), F.count("*").alias("participants"),
        F.max("duration_s").alias("fight_duration_s"))


def fct_loot(events: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per item looted; a template lost from the event comes from the drop."""
    drops = first_known(events.where(F.col("event_type") == "item_dropped"), "item_instance_id",
                        ["item_template_id", "creature_id"])
    drops = drops.select(F.col("item_instance_id").alias("_item"), F.col("item_template_id").alias("_template"),
                         F.col("creature_id").alias("_creature"))
    looted = events.where(F.col("event_type") == "item_looted")
    full = looted.join(drops, F.col("item_instance_id") == F.col("_item"), "left")
    full = full.select("event_id", "server_event_id", F.col("event_ts_utc").alias("looted_at"),
                       day("event_ts_utc").alias("loot_date"), "character_id", "encounter_id",
                       F.col("_creature").alias("creature_id"), "zone_id", "sub_zone_id", "item_instance_id",
                       F.coalesce("item_template_id", "_template").alias("item_template_id"))
    return full.join(templates.select("item_template_id", "rarity", "item_level", "slot"), "item_template_id", "left")


def fct_gold_ledger(events: DataFrame, templates: DataFrame, drops: DataFrame | None = None) -> DataFrame:
    """One row per signed gold movement (+ in, - out) and whether it is a source, sink or transfer.

    One scan of the log: every event becomes the list of its movements, which is exploded. A sale
    whose template was lost has no rarity, unless `drops` is given to recover it.
    """
    kind = F.col("event_type")
    rows = events.where(kind.isin("gold_credited", "item_sold", "trade_completed", "auction_purchased", "auction_sold"))
    sold_template = F.when(kind == "item_sold", F.col("item_template_id"))
    if drops is not None:
        known = first_known(drops.where(F.col("item_template_id").isNotNull()), "item_instance_id", ["item_template_id"])
        known = known.select(F.col("item_instance_id").alias("_item"), F.col("item_template_id").alias("_known"))
        rows = rows.join(known, (kind == "item_sold") & (F.col("item_instance_id") == F.col("_item")), "left")
        sold_template = F.when(kind == "item_sold", F.coalesce("item_template_id", "_known"))
    rarity = templates.select(F.col("item_template_id").alias("_template"), F.col("rarity").alias("item_rarity"))
    rows = rows.withColumn("_sold", sold_template).join(rarity, F.col("_sold") == F.col("_template"), "left")

    def movement(when: Column, name: str, flow: str, amount: Column, who: Column | None = None) -> Column:
        who = F.col("character_id") if who is None else who
        return F.when(when, F.struct(F.lit(name).alias("movement"), F.lit(flow).alias("flow_type"),
                                     amount.alias("amount"), who.alias("character_id")))

    moved = (F.col("gold_received") != 0) | (F.col("gold_given") != 0)
    movements = F.array(
        movement(kind == "gold_credited", "creature_drop", "source", F.col("gold_amount")),
        movement(kind == "item_sold", "merchant_sale", "source", F.col("price")),
        movement((kind == "trade_completed") & moved, "trade", "transfer", F.col("gold_received") - F.col("gold_given")),
        movement(kind == "auction_purchased", "auction_purchase", "transfer", -F.col("price")),
        movement(kind == "auction_sold", "auction_sale", "transfer", F.col("price") - F.col("auction_cut")),
        movement(kind == "auction_sold", "auction_house_cut", "sink", -F.col("auction_cut"), F.lit(None).cast("string")))
    flat = rows.select("event_id", "event_ts_utc", day("event_ts_utc").alias("ledger_date"), "item_rarity",
                       F.explode(F.array_compact(movements)).alias("m"))
    return flat.select("event_id", "event_ts_utc", "ledger_date", "m.character_id", "m.movement", "m.flow_type",
                       "m.amount", "item_rarity")


def fct_transactions(events: DataFrame) -> DataFrame:
    """One row per merchant sale, player trade or auction sale; the two sides of a trade are one row.

    A trade with one lost side names itself as counterpart; `one_sided` says so.
    """
    sale, auction = F.col("event_type") == "item_sold", F.col("event_type") == "auction_sold"
    singles = events.where(sale | auction).select(
        F.when(sale, "merchant_sale").otherwise("auction_sale").alias("transaction_type"), "event_id",
        F.col("event_ts_utc").alias("transacted_at"), "character_id",
        F.when(auction, F.col("buyer_character_id")).alias("counterpart_character_id"), "item_instance_id",
        "item_template_id", F.col("price").alias("gold_amount"),
        F.when(sale, F.col("merchant_id")).otherwise(F.col("zone_id")).alias("venue"), F.lit(False).alias("one_sided"))
    trades = events.where((F.col("event_type") == "trade_completed") & F.col("trade_id").isNotNull())
    no_text = F.lit(None).cast("string")
    merged = trades.groupBy("trade_id").agg(
        F.min("event_id").alias("event_id"), F.min("event_ts_utc").alias("transacted_at"),
        F.min("character_id").alias("character_id"), F.max("character_id").alias("counterpart_character_id"),
        F.sum("gold_given").alias("gold_amount"),
        F.min_by("zone_id", F.when(F.col("zone_id").isNotNull(), F.col("event_id"))).alias("venue"),
        (F.min("character_id") == F.max("character_id")).alias("one_sided")).select(
        F.lit("trade").alias("transaction_type"), "event_id", "transacted_at", "character_id",
        "counterpart_character_id", no_text.alias("item_instance_id"), no_text.alias("item_template_id"),
        "gold_amount", "venue", "one_sided")
    return singles.unionByName(merged).withColumn("transaction_date", day("transacted_at"))


def fct_xp(events: DataFrame) -> DataFrame:
    """One row per award."""
    return events.where(F.col("event_type") == "xp_gained").select(
        "event_id", "event_ts_utc", day("event_ts_utc").alias("xp_date"), "character_id", "encounter_id",
        "creature_id", "zone_id", "xp_amount", "xp_total")


def fct_subzone_activity(events: DataFrame, zones: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per sub-zone and hour: events and distinct characters present.

    Distinct characters are counted by two aggregations, the first per character, so a crowded
    sub-zone is no hot task. `approximate` uses a sketch instead.
    """
    hour = F.date_trunc("hour", "event_ts_utc")
    rows = events.where(F.col("sub_zone_id").isNotNull()).select(
        hour.alias("activity_hour"), "sub_zone_id", "character_id")
    if approximate:
        active = rows.groupBy("activity_hour", "sub_zone_id").agg(
            F.count("*").alias("events"), F.approx_count_distinct("character_id").alias("active_characters"))
    else:
        active = (rows.groupBy("activity_hour", "sub_zone_id", "character_id").agg(F.count("*").alias("n"))
                      .groupBy("activity_hour", "sub_zone_id")
                      .agg(F.sum("n").alias("events"), F.count("character_id").alias("active_characters")))
    return active.join(zones.select("sub_zone_id", "zone_id"), "sub_zone_id").select(
        "activity_hour", day("activity_hour").alias("activity_date"), "sub_zone_id", "zone_id", "events",
        "active_characters")


def fct_character_gear(dim_character: DataFrame, instances: DataFrame, templates: DataFrame,
                       caps: DataFrame) -> DataFrame:
    """One row per character: the gear worn and its score, capped for the character's bracket."""
    gear = templates.where(F.col("item_kind") == "gear").select("item_template_id", "item_level")
    worn = instances.where(F.col("is_equipped") & F.col("character_id").isNotNull()).select("character_id", "item_template_id")
    per_template = worn.groupBy("character_id", "item_template_id").agg(F.count("*").alias("n"))
    eq = per_template.join(gear, "item_template_id").groupBy("character_id").agg(
        F.sum(F.col("n") * F.col("item_level")).alias("raw"), F.sum("n").alias("worn"))
    base = dim_character.select("character_id", "class_id", "current_level",
                                F.col("current_bracket_min_level").alias("_bracket")).join(eq, "character_id", "left")
    raw = F.coalesce("raw", F.lit(0))
    return bracket_join(base, caps, "current_level", "bracket_min_level", "bracket_max_level").select(
        "character_id", "class_id", "current_level", F.col("_bracket").alias("bracket_min_level"),
        F.coalesce("worn", F.lit(0)).alias("equipped_items"), raw.alias("raw_gear_score"),
        F.least(raw, F.col("max_gear_score")).alias("gear_score"), F.col("max_gear_score").alias("bracket_cap"))
