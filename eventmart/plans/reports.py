"""Reports over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import ratio, text_of
from eventmart.operators.ordered import HOT_ROWS, Hot
from eventmart.operators.peers import peer_standing, percentile, share_of_total

# Rarities from most common to rarest; where a death may come from, in report order.
RARITIES = ["common", "uncommon", "rare", "epic", "legendary", "unknown"]
KILLERS = ["boss", "player", "creature", "unknown"]


def daily_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions, distinct players and played seconds per day, by two aggregations (no hot day)."""
    per_player = sessions.groupBy("session_date", "character_id").agg(
        F.count("login_at").alias("n"), F.sum("duration_s").alias("s"))
    return per_player.groupBy("session_date").agg(
        F.count("character_id").alias("players"), F.sum("n").alias("sessions"), F.sum("s").alias("seconds"))


def daily_active(dates: DataFrame, sessions: DataFrame) -> DataFrame:
    """Players, sessions and hours per day; days without sessions show 0."""
    days = daily_sessions(sessions)
    return (dates.join(days, F.col("date_day") == F.col("session_date"), "left")
                 .select("date_day", "day_name", F.coalesce("players", F.lit(0)).alias("daily_active_players"),
                         F.coalesce("sessions", F.lit(0)).alias("sessions"),
                         F.round(F.col("seconds") / 3600, 1).alias("hours_played")).orderBy("date_day"))


def weekly_pattern(dates: DataFrame, sessions: DataFrame, before: Column | None = None) -> DataFrame:
    """Average players and sessions by weekday; `before` leaves out a partial last day."""
    days = dates if before is None else dates.where(F.col("date_day") < before)
    daily = days.join(daily_sessions(sessions), F.col("date_day") == F.col("session_date"), "left")
    players, count = F.coalesce("players", F.lit(0)), F.coalesce("sessions", F.lit(0))
    return (daily.groupBy("iso_day_of_week", "day_name")
                 .agg(F.count("*").alias("days_observed"), F.round(F.avg(players)).alias("avg_active_players"),
                      F.round(F.avg(count)).alias("avg_sessions")).orderBy("iso_day_of_week"))


def bracket_label(low: str) -> Column:
    return text_of(F.col(low), "-", F.col(low) + 9)


def population(characters: DataFrame) -> DataFrame:
    low = F.col("current_bracket_min_level").alias("bracket_min_level")
    return (characters.groupBy("faction", "class_name", low).agg(F.count("*").alias("characters"))
                      .withColumn("level_bracket", bracket_label("bracket_min_level"))
                      .orderBy("faction", "class_name", "bracket_min_level"))


def kills_by_day(kills: DataFrame, ranks: Sequence[str] = ("normal", "elite", "boss")) -> DataFrame:
    return (kills.groupBy("kill_date").agg(
        F.count("*").alias("creatures_killed"),
        *[F.count_if(F.col("creature_rank") == r).alias(r) for r in ranks]).orderBy("kill_date"))


def deaths_by_day(deaths: DataFrame) -> DataFrame:
    per_victim = deaths.groupBy("death_date", "character_id").agg(F.count("*").alias("n"))
    return (per_victim.groupBy("death_date").agg(F.sum("n").alias("players_killed"),
                                                 F.count("character_id").alias("distinct_victims"))
                      .orderBy("death_date"))


def looted_by_rarity(loot: DataFrame, rarities: Sequence[str] = RARITIES) -> DataFrame:
    """Items looted per day, one column per rarity, 0 where none."""
    rarity = F.coalesce("rarity", F.lit("unknown")).alias("rarity")
    return (loot.select("loot_date", rarity).groupBy("loot_date").pivot("rarity", list(rarities))
                .agg(F.count(F.lit(1))).fillna(0, list(rarities)).orderBy("loot_date"))


def heatmap(activity: DataFrame, zones: DataFrame) -> DataFrame:
    """Activity by sub-zone and hour of day, over the whole window."""
    named = zones.select("sub_zone_id", "zone_name", "sub_zone_name")
    hours = activity.groupBy("sub_zone_id", F.hour("activity_hour").alias("hour_utc")).agg(
        F.sum("events").alias("e"), F.sum("active_characters").alias("a"), F.count("active_characters").alias("n"))
    return (hours.join(named, "sub_zone_id").groupBy("zone_name", "sub_zone_name", "hour_utc")
                 .agg(F.sum("e").alias("events"),
                      F.round(F.sum("a") / F.sum("n"), 1).alias("avg_active_characters"))
                 .orderBy("zone_name", "sub_zone_name", "hour_utc"))


def deaths_by_killer(deaths: DataFrame, categories: Sequence[str] = KILLERS) -> DataFrame:
    """Deaths and their share per killer category; every category is listed, also with no deaths."""
    listed = deaths.sparkSession.createDataFrame([(c, i) for i, c in enumerate(categories)],
                                                 "killer_category string, position int")
    counts = deaths.groupBy("killer_category").agg(F.count("event_id").alias("deaths"))
    full = listed.join(counts, "killer_category", "left").fillna(0, ["deaths"])
    return share_of_total(full, "deaths", "pct").orderBy("position").select("killer_category", "deaths", "pct")


def gear_message(what: str, pct: Column) -> Column:
    return text_of(what, F.coalesce(pct, F.lit(0.0)).cast("int"), "% of other ", F.col("class_name"),
                   "s between levels ", F.col("bracket_min_level"), " and ", F.col("bracket_min_level") + 9, ".")


def player_360(gear: DataFrame, characters: DataFrame, sessions: DataFrame, xp: DataFrame,
               character_id: str | None = None, hot: Hot = HOT_ROWS) -> DataFrame:
    """Time played, XP per day and standing of the gear score among peers (class and bracket).

    Confirmed offenders are nobody's peer, but see their own standing. All characters unless one
    is asked for.
    """
    who = characters.select("character_id", "character_name", "class_name", "is_confirmed_cheater")
    ranked = peer_standing(gear.join(who, "character_id"), ["class_id", "bracket_min_level"], "gear_score",
                           ~F.col("is_confirmed_cheater"), slice_width=10.0, hot=hot)
    if character_id is not None:
        ranked = ranked.where(F.col("character_id") == character_id)
    per_day = sessions.groupBy("character_id", "session_date").agg(F.sum("duration_s").alias("s"))
    played = per_day.groupBy("character_id").agg((F.sum("s") / 3600).alias("hours"),
                                                 F.count("session_date").alias("days"))
    earned = xp.groupBy("character_id").agg(F.sum("xp_amount").alias("xp_earned"))
    full = ranked.join(played, "character_id", "left").join(earned, "character_id", "left")
    return full.select(
        "character_id", "character_name", "class_name", "current_level",
        F.round(F.coalesce("hours", F.lit(0.0)), 1).alias("total_hours_played"),
        F.coalesce("days", F.lit(0)).alias("days_played"),
        F.round(ratio(F.coalesce("xp_earned", F.lit(0)), F.col("days"))).alias("avg_xp_per_day_played"),
        "gear_score", "peer_count", percentile().alias("gear_percentile"),
        gear_message("Your gear is better than ", percentile()).alias("player_message"))


# what `dps_percentile` reads of the fights
WON_COLUMNS = ["character_id", "bracket_min_level", "outcome", "duration_s", "damage_done"]


def won_fight() -> Column:
    return (F.col("outcome") == "victory") & (F.col("duration_s") > 0) & F.col("damage_done").isNotNull()


def dps_percentile(participation: DataFrame, characters: DataFrame, min_fights: int = 10,
                   slice_width: float = 10.0, hot: Hot = HOT_ROWS) -> DataFrame:
    """Damage per second in won fights and its standing among peers at the level fought at.

    Confirmed offenders and characters with too few fights are left out altogether.
    """
    honest = characters.where(~F.col("is_confirmed_cheater")).select("character_id", "class_name")
    per = participation.where(won_fight()).groupBy("character_id", "bracket_min_level").agg(
        F.sum("damage_done").alias("d"), F.sum("duration_s").alias("s"), F.count("*").alias("fights"))
    dps = per.where(F.col("fights") >= min_fights).join(honest, "character_id").withColumn(
        "dps", ratio(F.col("d"), F.col("s")))
    ranked = peer_standing(dps, ["class_name", "bracket_min_level"], "dps", F.lit(True), slice_width, hot)
    return ranked.select(
        "character_id", "class_name", bracket_label("bracket_min_level").alias("level_bracket"),
        F.round("dps", 1).alias("dps"), "fights", "peer_count", percentile().alias("dps_percentile"),
        gear_message("Your damage per second is higher than ", percentile()).alias("player_message"))


def transactions_in_window(transactions: DataFrame, start: Column, end: Column) -> DataFrame:
    """Transactions and gold per type in [start, end), the grand total last (type NULL)."""
    inside = transactions.where((F.col("transacted_at") >= start) & (F.col("transacted_at") < end))
    return (inside.rollup("transaction_type")
                  .agg(F.count("*").alias("transactions"), F.sum("gold_amount").alias("gold_value"))
                  .orderBy(F.asc_nulls_last("transaction_type")))


def sold_by_rarity(transactions: DataFrame, templates: DataFrame, rarities: Sequence[str] = RARITIES) -> DataFrame:
    """Items sold to merchants by rarity, rarest last.

    Sales are first summed per template (map-side combine), so a best-seller is no hot join key.
    """
    per = (transactions.where(F.col("transaction_type") == "merchant_sale").groupBy("item_template_id")
                       .agg(F.count("*").alias("n"), F.sum("gold_amount").alias("g")))
    rarity = F.coalesce("rarity", F.lit("unknown"))
    position = F.coalesce(*[F.when(F.col("rarity") == r, i) for i, r in enumerate(rarities)], F.lit(len(rarities)))
    return (per.join(templates.select("item_template_id", "rarity"), "item_template_id", "left")
               .groupBy(rarity.alias("rarity")).agg(F.sum("n").alias("items_sold"), F.sum("g").alias("gold_paid"))
               .orderBy(position))


def gold_flow(ledger: DataFrame) -> DataFrame:
    """Gold entering and leaving the economy by line, with totals in, out and net.

    Lines and totals come from one aggregation: the ledger is reduced to its lines once, each line
    is repeated under the totals it belongs to, and the few rows are summed.
    """
    line = F.when(F.col("movement") == "merchant_sale",
                  F.concat(F.lit("merchant_sale_"), F.coalesce("item_rarity", F.lit("unknown")))
                  ).otherwise(F.col("movement"))
    lines = (ledger.where(F.col("flow_type").isin("source", "sink"))
                   .groupBy("flow_type", line.alias("line")).agg(F.sum("amount").alias("gold")))
    total = F.lit("total")
    side = F.when(F.col("flow_type") == "source", "gold_in").otherwise("gold_out")
    entries = F.array(F.struct(F.col("flow_type").alias("flow_type"), F.col("line").alias("line")),
                      F.struct(total.alias("flow_type"), side.alias("line")),
                      F.struct(total.alias("flow_type"), F.lit("net").alias("line")))
    listed = ledger.sparkSession.createDataFrame(
        [("total", "gold_in"), ("total", "gold_out"), ("total", "net")], "flow_type string, line string")
    summed = lines.select(F.explode(entries).alias("e"), "gold").select("e.flow_type", "e.line", "gold")
    # the totals are listed even when nothing flowed
    return (summed.unionByName(listed.withColumn("gold", F.lit(None).cast("bigint"))).groupBy("flow_type", "line")
                  .agg(F.sum("gold").alias("gold")).orderBy(F.desc("flow_type"), F.desc("gold")))


def offender_report(offenders: DataFrame, characters: DataFrame) -> DataFrame:
    who = characters.select("character_id", "character_name", "class_name")
    return (offenders.where("confirmed_cheater").join(who, "character_id")
                     .select("character_id", "account_id", "character_name", "class_name", "violations",
                             "rules_broken", "first_violation_at", "last_violation_at")
                     .orderBy(F.desc("violations"), "character_id"))
