"""Detection rules: event frames in, findings with their evidence out.

All rules return the columns of FINDING. Thresholds are parameters. A NULL place, group or amount
never flags anybody (three-valued logic is kept on purpose), and the first row of a history has
no gap and never flags. Every order ends with the event id, so ties are decided the same way on
every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.functions.columns import col, seconds_between, stamp, text_of, time_slice
from eventmart.operators.asof import asof_join, bracket_join
from eventmart.operators.history import with_last_given
from eventmart.operators.ordered import HOT_ROWS, Hot, with_previous
from eventmart.operators.quality import first_known

FINDING = ["rule_id", "character_id", "occurred_at", "encounter_id", "detail",
           "evidence_event_ids", "evidence_server_event_ids", "evidence_part", "evidence_first"]
HOUR = 3600


def finding(df: DataFrame, rule: str, detail: Column, event_ids: Column, server_ids: Column,
            character: str | Column = "character_id", at: str | Column = "event_ts_utc",
            encounter: str | Column | None = None, part: Column | None = None, first: Column | None = None) -> DataFrame:
    """One row per finding. `part` and `first` (the smallest event id) are for one whose evidence is spread over several rows."""
    no_text = F.lit(None).cast("string")
    return df.select(
        F.lit(rule).alias("rule_id"), col(character).alias("character_id"), col(at).alias("occurred_at"),
        (no_text if encounter is None else col(encounter)).alias("encounter_id"), detail.alias("detail"),
        event_ids.alias("evidence_event_ids"), server_ids.alias("evidence_server_event_ids"),
        (F.lit(0) if part is None else part).cast("int").alias("evidence_part"),
        (F.element_at(event_ids, 1) if first is None else first).alias("evidence_first"))


def own_evidence() -> tuple[Column, Column]:
    return F.array("event_id"), F.array("server_event_id")


def pair_evidence(prev: str) -> tuple[Column, Column]:
    return (F.array(f"{prev}.event_id", "event_id"), F.array(f"{prev}.server_event_id", "server_event_id"))


def damage_hits(events: DataFrame, characters: DataFrame, abilities: DataFrame, levels: DataFrame,
                caps: DataFrame, hot: Hot = HOT_ROWS) -> DataFrame:
    """Every hit with the attacker's level at that moment and the largest damage the rules allow.

    The bound uses the bracket's gear-score cap, so it is generous. Hits without a known actor,
    ability, level or amount cannot be judged and are left out.
    """
    # 10 % variance, double damage on a critical hit, half the gear score counts.
    variance, critical, gear_share = 1.1, 2.0, 0.5
    dealt = events.where(F.col("event_type").isin("pve_damage_dealt", "pvp_damage_dealt")
                         & F.col("damage").isNotNull()).select(
        "event_id", "server_event_id", "event_type", "event_ts_utc", "encounter_id", "character_id", "ability_id",
        "attack_type", "damage", "is_critical", "target_creature_id", "target_character_id")
    known = dealt.join(characters.select("character_id", "class_id"), "character_id")
    known = known.join(abilities.select("ability_id", "base_damage", "damage_per_level"), "ability_id")
    placed = asof_join(known, levels, ["character_id"], "event_ts_utc", "valid_from", ["level"],
                       tie="level", hot=hot)
    capped = bracket_join(placed, caps, "level", "bracket_min_level", "bracket_max_level")
    base = F.col("base_damage") + F.col("damage_per_level") * F.col("level")
    bound = (base.cast("double") + F.lit(gear_share) * F.col("max_gear_score")) * variance * critical
    return (capped.withColumn("ability_base_at_level", base).withColumn("max_possible_hit", bound)
                  .withColumnRenamed("max_gear_score", "gear_score_cap")
                  .drop("base_damage", "damage_per_level", "bracket_min_level", "bracket_max_level"))


def unjudged_hits(events: DataFrame, characters: DataFrame, abilities: DataFrame) -> DataFrame:
    """How many hits the combat rules cannot see, by reason.

    Hits are counted per actor and ability before the lookups, so a busy actor is one row of them.
    """
    dealt = events.where(F.col("event_type").isin("pve_damage_dealt", "pvp_damage_dealt"))
    per = dealt.groupBy("character_id", "ability_id", F.col("damage").isNull().alias("_no_damage")).agg(
        F.count("*").alias("n"))
    actors = characters.select(F.col("character_id").alias("_actor"))
    known = abilities.select(F.col("ability_id").alias("_ability"))
    full = (per.join(actors, F.col("character_id") == F.col("_actor"), "left")
               .join(known, F.col("ability_id") == F.col("_ability"), "left"))
    reason = (F.when(F.col("_no_damage"), "no damage").when(F.col("_actor").isNull(), "unknown actor")
               .when(F.col("_ability").isNull(), "unknown ability"))
    return full.select(reason.alias("reason"), "n").where(F.col("reason").isNotNull()).groupBy("reason").agg(
        F.sum("n").alias("hits"))


def burst_damage(hits: DataFrame, part_rows: int = 50_000) -> DataFrame:
    """Several hits of one character in one encounter at one instant.

    Bursts are found with a hash aggregate; only their hits come back for the evidence. A burst is one finding
    of any size: its id lists are stored in pieces of about `part_rows` ids (`evidence_part` 0, 1, ...; piece 0 has the
    first event), all with the totals and the first event of the whole burst, by which it is numbered and named.
    """
    key = ["character_id", "encounter_id", "event_ts_utc"]
    target = F.coalesce("target_character_id", "target_creature_id")
    named = F.when(target.isNotNull(), F.col("event_id"))
    bursts = (hits.groupBy(*key)
                  .agg(F.count("*").alias("n"), F.sum("damage").alias("total"), F.min("event_id").alias("first"),
                       F.min_by(target, named).alias("target")).where(F.col("n") > 1))
    # equality keeps the join hashable; a NULL key matches nothing, so NULLs become one marker value
    marked = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")).alias(f"_m_{k}") for k in key]
    own = hits.select("event_id", "server_event_id", *marked)
    whole = bursts.select("*", *marked, F.ceil(F.col("n") / part_rows).alias("_parts"))
    members = own.join(whole, [f"_m_{k}" for k in key]).withColumn(
        "_part", F.when(F.col("event_id") == F.col("first"), 0).otherwise(F.pmod(F.xxhash64("event_id"), F.col("_parts"))).cast("int"))
    pair = F.array_sort(F.collect_list(F.struct("event_id", "server_event_id")))
    lists = members.groupBy(*[f"_m_{k}" for k in key], "_part").agg(
        pair.alias("_e"), *[F.any_value(c).alias(c) for c in [*key, "n", "total", "target", "first"]])
    detail = text_of(F.col("n"), " hits at the same instant, ", F.col("total"), " damage on ", F.col("target"))
    return finding(lists, "R01", detail, F.col("_e.event_id"), F.col("_e.server_event_id"),
                   encounter="encounter_id", part=F.col("_part"), first=F.col("first"))


def item_duplication(custody: DataFrame, slice_seconds: int = 86_400, hot: Hot = HOT_ROWS) -> DataFrame:
    """Somebody hands over an item that is held by another and that they gave away before.

    "Gave it before" is the previous row of the same item and giver, so no self join is needed; a chain that was stored
    with it (`history.with_last_given`) is only filtered.
    """
    given = custody.where(F.col("giver").isNotNull())
    again = given if "last_given" in given.columns else with_last_given(given, slice_seconds, hot)
    bad = again.where(F.col("last_given").isNotNull() & (F.col("holder_before") != F.col("giver")))
    detail = text_of("Gave ", F.col("item_instance_id"), " (", F.col("event_type"), ") while ",
                     F.col("holder_before"), " held it; first given away at ", stamp("last_given.ts"))
    return finding(bad, "R02", detail, *pair_evidence("last_given"), character="giver")


def equip_stacking(events: DataFrame, max_seconds: float = 1.0, slice_seconds: int = HOUR,
                   hot: Hot = HOT_ROWS) -> DataFrame:
    """A second equip of a slot soon after the first, with nothing taken off between."""
    rows = events.where(F.col("event_type").isin("item_equipped", "item_unequipped")
                        & F.col("character_id").isNotNull() & F.col("slot").isNotNull()).select(
        "event_id", "server_event_id", "event_type", "event_ts_utc", "character_id", "slot", "item_instance_id")
    values = {k: F.col(k) for k in ("event_type", "event_ts_utc", "event_id", "server_event_id")}
    seq = with_previous(rows, ["character_id", "slot"], ["event_ts_utc", "event_id"], values, "_prev",
                        time_slice("event_ts_utc", slice_seconds), hot)
    gap = seconds_between("event_ts_utc", "_prev.event_ts_utc")
    bad = seq.where((F.col("event_type") == "item_equipped") & (F.col("_prev.event_type") == "item_equipped")
                    & (gap < max_seconds))
    detail = text_of("Equipped ", F.col("item_instance_id"), " in ", F.col("slot"), " ", F.round(gap, 3),
                     " s after the previous equip, without unequipping")
    return finding(bad, "R03", detail, *pair_evidence("_prev"))


def speed_hack(events: DataFrame, adjacency: DataFrame, metres_per_second: float = 7.0,
               slice_seconds: int = HOUR, hot: Hot = HOT_ROWS) -> DataFrame:
    """Two consecutive zone entries on foot, faster than the walking speed allows.

    A relocation or login between the entries breaks the chain. At one instant a zone entry comes
    last; after that shard order decides, and then the event id.
    """
    on_foot = "zone_entered"
    rows = events.where(F.col("event_type").isin(on_foot, "location_changed", "session_login")
                        & F.col("character_id").isNotNull() & F.col("zone_id").isNotNull()).select(
        "event_id", "server_event_id", "event_type", "event_ts_utc", "character_id", "zone_id", "server_id",
        "shard_seq")
    values = {k: F.col(k) for k in ("event_type", "zone_id", "event_ts_utc", "event_id", "server_event_id")}
    order = ["event_ts_utc", F.col("event_type") == on_foot, "server_id", "shard_seq", "event_id"]
    seq = with_previous(rows, ["character_id"], order, values, "_prev",
                        time_slice("event_ts_utc", slice_seconds), hot)
    walked = seq.where((F.col("event_type") == on_foot) & (F.col("_prev.event_type") == on_foot))
    edge = adjacency.select(F.col("zone_a_id").alias("_a"), F.col("zone_b_id").alias("_b"), "min_distance_m")
    near = walked.join(edge, (F.col("_prev.zone_id") == F.col("_a")) & (F.col("zone_id") == F.col("_b")))
    took = seconds_between("event_ts_utc", "_prev.event_ts_utc")
    least = F.col("min_distance_m") / F.lit(metres_per_second)
    detail = text_of("Walked ", F.col("_prev.zone_id"), " -> ", F.col("zone_id"), " in ", F.round(took),
                     " s; minimum is ", F.round(least), " s (", F.col("min_distance_m"), " m at ",
                     f"{metres_per_second:g} m/s)")
    return finding(near.where(took < least), "R04", detail, *pair_evidence("_prev"))


def gear_above_level(events: DataFrame, templates: DataFrame, levels: DataFrame, min_excess: int = 2,
                     hot: Hot = HOT_ROWS) -> DataFrame:
    """An equipped item requires clearly more than the level held at that moment.

    A template lost from the equip event is recovered from any other event of the item.
    """
    named = first_known(events.where(F.col("item_template_id").isNotNull()), "item_instance_id",
                        ["item_template_id"]).select("item_instance_id", F.col("item_template_id").alias("_known"))
    equips = events.where(F.col("event_type") == "item_equipped").select(
        "event_id", "server_event_id", "event_ts_utc", "character_id", "item_instance_id", "item_template_id")
    full = equips.join(named, "item_instance_id").withColumn(
        "item_template_id", F.coalesce("item_template_id", "_known")).drop("_known")
    needs = templates.select("item_template_id", F.col("name").alias("item_name"), "level_requirement")
    placed = asof_join(full.join(needs, "item_template_id"), levels, ["character_id"], "event_ts_utc",
                       "valid_from", ["level"], tie="level", hot=hot)
    bad = placed.where(F.col("level_requirement") - F.col("level") >= min_excess)
    detail = text_of("Equipped ", F.col("item_name"), " (requires level ", F.col("level_requirement"),
                     ") at level ", F.col("level"))
    return finding(bad, "R05", detail, *own_evidence())


def hit_above_max(hits: DataFrame) -> DataFrame:
    """One hit above the legal maximum; targets that cannot be hit critically get half of it."""
    bound = F.when(F.col("event_type") == "pve_damage_dealt", F.col("max_possible_hit") / 2).otherwise(
        F.col("max_possible_hit"))
    detail = text_of("Hit for ", F.col("damage"), ", maximum possible ",
                     F.round("max_possible_hit").cast("bigint"))
    return finding(hits.where(F.col("damage") > bound), "R06", detail, *own_evidence(), encounter="encounter_id")


def ability_cooldown(events: DataFrame, abilities: DataFrame, global_seconds: float = 1.5,
                     tolerance: float = 0.001, slice_seconds: int = HOUR, hot: Hot = HOT_ROWS) -> DataFrame:
    """An ability used within the global cooldown, or within its own."""
    used = events.where((F.col("event_type") == "ability_used") & F.col("character_id").isNotNull()).select(
        "event_id", "server_event_id", "event_ts_utc", "character_id", "ability_id", "encounter_id")
    piece = time_slice("event_ts_utc", slice_seconds)
    when, order = {"ts": F.col("event_ts_utc")}, ["event_ts_utc", "event_id"]
    after_any = with_previous(used, ["character_id"], order, when, "_any", piece, hot)
    known = after_any.where(F.col("ability_id").isNotNull())
    after_same = with_previous(known, ["character_id", "ability_id"], order, when, "_same", piece, hot)
    own = abilities.select("ability_id", "cooldown_s")
    unnamed = after_any.where(F.col("ability_id").isNull())  # only the global cooldown can judge these
    judged = after_same.join(own, "ability_id", "left").unionByName(unnamed, allowMissingColumns=True)
    gap_any = seconds_between("event_ts_utc", "_any.ts")
    gap_same = seconds_between("event_ts_utc", "_same.ts")
    bad = judged.where((gap_any < global_seconds - tolerance)
                       | (F.col("cooldown_s").isNotNull() & (gap_same < F.col("cooldown_s") - tolerance)))
    detail = text_of(F.col("ability_id"), " used ", F.round(F.least(gap_any, gap_same), 2),
                     " s after the previous use")
    return finding(bad, "R07", detail, *own_evidence(), encounter="encounter_id")


def reuse_within(events: DataFrame, seconds: int = 3600, event_type: str = "amulet_used", what: str = "Amulet",
                 rule: str = "R08", slice_seconds: int = HOUR, hot: Hot = HOT_ROWS) -> DataFrame:
    """The amulet used again inside its cooldown."""
    used = events.where((F.col("event_type") == event_type) & F.col("character_id").isNotNull()).select(
        "event_id", "server_event_id", "event_ts_utc", "character_id")
    values = {"ts": F.col("event_ts_utc"), "event_id": F.col("event_id"), "server_event_id": F.col("server_event_id")}
    seq = with_previous(used, ["character_id"], ["event_ts_utc", "event_id"], values, "_prev",
                        time_slice("event_ts_utc", slice_seconds), hot)
    gap = seconds_between("event_ts_utc", "_prev.ts")
    detail = text_of(f"{what} used ", F.round(gap / 60, 1), " min after the previous use")
    return finding(seq.where(gap < seconds), rule, detail, *pair_evidence("_prev"))


def with_first_equip(custody: DataFrame, events: DataFrame) -> DataFrame:
    """Add `first_equip`: the earliest equip of the item, which binds it (NULL if there is none).

    On a chain that is not stored yet its rows already lie by item, so they are not moved for it.
    """
    first = F.struct("event_ts_utc", "event_id", "server_event_id")
    bound = (events.where((F.col("event_type") == "item_equipped") & F.col("item_instance_id").isNotNull())
                   .groupBy("item_instance_id").agg(F.min(first).alias("first_equip")))
    return custody.join(bound, "item_instance_id", "left")


def bound_item_moved(custody: DataFrame, events: DataFrame,
                     moving: Sequence[str] = ("trade_completed", "auction_created")) -> DataFrame:
    """An item traded or auctioned after it had been equipped (which binds it).

    The earliest equip of all is the earliest before the move, if any is before it, so one
    aggregate per item replaces a lookup per move; a chain that was stored with it (`with_first_equip`) is only filtered.
    """
    moved = custody.where(F.col("event_type").isin(*moving))
    moved = moved if "first_equip" in custody.columns else with_first_equip(moved, events)
    bad = moved.where(F.col("first_equip.event_ts_utc") < F.col("event_ts_utc"))
    detail = text_of(F.col("item_instance_id"), " moved by ", F.col("event_type"), " after being equipped on ",
                     stamp("first_equip.event_ts_utc"))
    return finding(bad, "R09", detail, *pair_evidence("first_equip"), character="giver")


def illegal_trade(events: DataFrame, characters: DataFrame) -> DataFrame:
    """A trade between characters of different factions, or in different zones.

    A pair names its smaller side (by character id) as the actor. Each side is reported against the smallest side before it
    whose faction or zone differs, and against the largest such side after it: every actor of any illegal pair is named, with
    two rows a side at most; for the usual two sides that is the pair. An unknown faction or zone differs from nothing. Linear for
    any number of sides: the smallest (largest) side with a known faction, and the smallest (largest) whose faction is another
    one, hold every side's partner; likewise for zones. All steps are by trade, so the sides are moved once.
    """
    side = events.where((F.col("event_type") == "trade_completed") & F.col("trade_id").isNotNull()
                        & F.col("character_id").isNotNull()).select(
        "trade_id", "character_id", "event_id", "server_event_id", "event_ts_utc", "zone_id")
    me = F.struct("character_id", "event_id", "server_event_id", "event_ts_utc", "zone_id", "faction")
    sides = side.join(characters.select("character_id", "faction"), "character_id").repartition("trade_id").select("trade_id", me.alias("me"))
    kinds, ends = ("faction", "zone_id"), {"low": (F.min, F.least), "high": (F.max, F.greatest)}
    whole = W.partitionBy("trade_id")
    sides = sides.select("*", F.count("*").over(whole).alias("_n"), *[
        pick(F.when(F.col(f"me.{k}").isNotNull(), F.col("me"))).over(whole).alias(f"one_{e}_{k}") for e, (pick, _) in ends.items() for k in kinds]).where("_n > 1")
    sides = sides.select("*", *[
        pick(F.when(F.col(f"me.{k}") != F.col(f"one_{e}_{k}.{k}"), F.col("me"))).over(whole).alias(f"two_{e}_{k}") for e, (pick, _) in ends.items() for k in kinds])

    def partner(e: str) -> Column:
        of_kind = [F.when(F.col(f"me.{k}") != F.col(f"one_{e}_{k}.{k}"), F.col(f"one_{e}_{k}"))
                    .when(F.col(f"me.{k}") == F.col(f"one_{e}_{k}.{k}"), F.col(f"two_{e}_{k}")) for k in kinds]
        return ends[e][1](*of_kind)

    pairs = F.array(F.struct(partner("low").alias("a"), F.col("me").alias("b")), F.struct(F.col("me").alias("a"), partner("high").alias("b")))
    bad = sides.select("trade_id", F.explode(pairs).alias("p")).select("trade_id", "p.a", "p.b")
    bad = bad.where(F.col("a.character_id") < F.col("b.character_id")).dropDuplicates(["trade_id", "a", "b"])
    detail = text_of("Trade ", F.col("trade_id"), " with ", F.col("b.character_id"), ": factions ",
                     F.col("a.faction"), "/", F.col("b.faction"), ", zones ", F.col("a.zone_id"), "/",
                     F.col("b.zone_id"))
    return finding(bad, "R10", detail, F.array("a.event_id", "b.event_id"),
                   F.array("a.server_event_id", "b.server_event_id"),
                   character="a.character_id", at="a.event_ts_utc")


def transport_misuse(events: DataFrame, transports: DataFrame, characters: DataFrame,
                     versions: DataFrame) -> DataFrame:
    """A transport boarded by the wrong faction, from the wrong zone, or before its release."""
    boarded = events.where(F.col("event_type") == "transport_boarded").select(
        "event_id", "server_event_id", "event_ts_utc", "character_id", "transport_id", "zone_id")
    routes = transports.select("transport_id", F.col("name").alias("transport_name"),
                               F.col("faction").alias("only_faction"), "from_zone_id",
                               F.col("available_from_version").alias("version"))
    full = (boarded.join(routes, "transport_id").join(characters.select("character_id", "faction"), "character_id")
                   .join(versions.select("version", "released_at"), "version"))
    wrong_faction = F.col("only_faction").isNotNull() & (F.col("only_faction") != F.col("faction"))
    bad = full.where(wrong_faction | (F.col("zone_id") != F.col("from_zone_id"))
                     | (F.col("event_ts_utc") < F.col("released_at")))
    detail = text_of("Boarded ", F.col("transport_name"), " as ", F.col("faction"), " from ", F.col("zone_id"))
    return finding(bad, "R11", detail, *own_evidence())


def combat_in_hub(events: DataFrame, zones: DataFrame, forbidden: str = "hub") -> DataFrame:
    """A fight started where none is allowed."""
    started = events.where(F.col("event_type") == "encounter_started")
    hubs = zones.where(F.col("zone_type") == forbidden).select("zone_id")
    detail = text_of(F.col("encounter_kind"), " fight started in ", F.col("zone_id"))
    return finding(started.join(hubs, "zone_id"), "R12", detail, *own_evidence(), encounter="encounter_id")


def wrong_amount(events: DataFrame, reference: DataFrame, event_type: str = "xp_gained",
                 amount: str = "xp_amount", key: str = "creature_id", expected: str = "xp_reward",
                 unit: str = "XP", rule: str = "R13") -> DataFrame:
    """An award that differs from what its source grants (unknown amounts are skipped).

    The same shape checks any fixed amount per source: gold per kill, merchant price per item.
    """
    got = events.where((F.col("event_type") == event_type) & F.col(amount).isNotNull()).select(
        "event_id", "server_event_id", "event_ts_utc", "character_id", "encounter_id", key, amount)
    fixed = reference.select(key, F.col("name").alias("_name"), F.col(expected).alias("_expected"))
    bad = got.join(fixed, key).where(F.col(amount) != F.col("_expected"))
    detail = text_of("Received ", F.col(amount), f" {unit} from ", F.col("_name"), ", which grants ",
                     F.col("_expected"))
    return finding(bad, rule, detail, *own_evidence(), encounter="encounter_id")
