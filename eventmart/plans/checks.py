"""Further checks of the game's rules and of the data, in the shape of ordinary table work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import ratio, seconds_between, time_slice
from eventmart.operators.asof import asof_join
from eventmart.operators.ordered import HOT_ROWS, Hot, running_sum, with_following, with_next, with_previous
from eventmart.operators.quality import first_known
from eventmart.operators.quantiles import with_quantile

DAY = 86_400


def chain_completeness(events: DataFrame, chain: Sequence[str], gaps: DataFrame | None = None,
                       max_seconds: float | None = None, slice_seconds: int = DAY,
                       hot: Hot = HOT_ROWS) -> DataFrame:
    """Every event that opens a chain, and whether the rest of the chain follows it directly.

    `max_seconds` also limits the time from first to last link. A broken chain is `excused` when
    its shard lost an event between the opening and the last link looked at (`gaps`, one row per
    hole): delivery may have broken it. All links are looked up in one pass, whatever the length of the chain.
    """
    rows = events.where(F.col("event_type").isin(*chain) & F.col("character_id").isNotNull()).select(
        "event_id", "server_event_id", "event_type", "event_ts_utc", "character_id", "server_id")
    order = ["event_ts_utc", "event_id"]
    piece = time_slice("event_ts_utc", slice_seconds)
    values = {"type": F.col("event_type"), "ts": F.col("event_ts_utc")}
    linked = with_following(rows, ["character_id"], order, values, len(chain) - 1, "_ahead", piece, hot)
    opened = linked.where(F.col("event_type") == chain[0])
    follows = F.lit(True)
    for i, kind in enumerate(chain[1:]):
        follows = follows & F.get(F.col("_ahead.type"), F.lit(i)).eqNullSafe(F.lit(kind))
    last = F.coalesce(F.try_element_at(F.col("_ahead.ts"), F.lit(-1)), F.col("event_ts_utc"))
    took = seconds_between("_last", "event_ts_utc")
    if max_seconds is not None:
        follows = follows & (seconds_between(last, "event_ts_utc") <= max_seconds)
    out = opened.select("event_id", "server_event_id", "character_id", "server_id", "event_ts_utc",
                        last.alias("_last"), follows.alias("complete"))
    out = out.withColumn("seconds", took)
    if gaps is None:
        return out.withColumn("excused", F.lit(False)).drop("_last")
    holes = gaps.select("server_id", "prev_event_ts", F.col("next_event_ts").alias("_hole_end"))
    near = asof_join(out, holes, ["server_id"], "_last", "prev_event_ts", ["_hole_end"], how="left", hot=hot)
    lost = F.coalesce(F.col("_hole_end") >= F.col("event_ts_utc"), F.lit(False))
    return near.withColumn("excused", ~F.col("complete") & lost).drop("_last", "_hole_end")


def threshold_mismatch(events: DataFrame, thresholds: DataFrame, level: str = "new_level",
                       total: str = "xp_total") -> DataFrame:
    """Events whose running total does not belong to the level they report.

    Each level's threshold is paired with the next one, so the check is an equi join on the level.
    """
    nexts = thresholds.select((F.col("level") - 1).alias("_level"), F.col("xp_required").alias("_next"))
    bounds = thresholds.join(nexts, F.col("level") == F.col("_level"), "left").select(
        F.col("level").alias("_level"), F.col("xp_required").alias("xp_from"), F.col("_next").alias("xp_below"))
    rows = events.where(F.col(level).isNotNull() & F.col(total).isNotNull())
    joined = rows.join(bounds, F.col(level) == F.col("_level")).drop("_level")
    return joined.where((F.col(total) < F.col("xp_from")) | (F.col(total) >= F.col("xp_below")))


def rate_vs_expected(trials: DataFrame, by: Sequence[str], success: Column, expected: DataFrame,
                     chance: str) -> DataFrame:
    """Observed rate per group against the published chance, with the deviation in standard errors."""
    rates = trials.groupBy(*by).agg(F.count("*").alias("trials"), F.count_if(success).alias("successes"))
    p = F.col(chance).cast("double")
    observed = ratio(F.col("successes"), F.col("trials"))
    error = F.sqrt(p * (1 - p) / F.col("trials"))
    return (rates.join(expected.select(*by, chance), list(by))
                 .select(*by, "trials", "successes", observed.alias("observed"), p.alias("expected"),
                         ((observed - p) / F.nullif(error, F.lit(0.0))).alias("deviation")))


def drop_rates(kills: DataFrame, drops: DataFrame, entries: DataFrame, versions: DataFrame) -> DataFrame:
    """Observed against published drop rate of each loot entry, over the versions it was valid in.

    Kills and drops are first counted per creature (and item) and game version; an entry is valid
    from the release of its first version to before the release that ended it.
    """
    release = versions.select("version", "released_at")
    since = release.select(F.col("version").alias("valid_from_version"), F.col("released_at").alias("_from"))
    until = release.select(F.col("version").alias("valid_to_version"), F.col("released_at").alias("_to"))
    item_entries = entries.where(F.col("item_template_id").isNotNull())
    valid = item_entries.join(since, "valid_from_version").join(until, "valid_to_version", "left")

    def counted(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        n = df.groupBy(*keys, "game_version").agg(F.count("*").alias(name))
        return n.join(release.withColumnRenamed("version", "game_version"), "game_version")

    in_force = (F.col("released_at") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("released_at") < F.col("_to")))
    entry = ["loot_entry_id", "creature_id", "item_template_id", "drop_chance"]
    tried = (valid.join(counted(kills, ["creature_id"], "_n"), "creature_id").where(in_force)
                  .groupBy(*entry).agg(F.sum("_n").alias("kills")))
    got = (valid.join(counted(drops, ["creature_id", "item_template_id"], "_n"), ["creature_id", "item_template_id"])
                .where(in_force).groupBy("loot_entry_id").agg(F.sum("_n").alias("drops")))
    return (tried.join(got, "loot_entry_id", "left").fillna(0, ["drops"])
                 .withColumn("observed", ratio(F.col("drops"), F.col("kills")))
                 .withColumn("expected", F.col("drop_chance").cast("double")).drop("drop_chance"))


def not_allowed(df: DataFrame, allowed: DataFrame, pair: Sequence[str]) -> DataFrame:
    """Rows whose combination is not in the list of allowed ones (rows with a NULL part are skipped)."""
    known = df
    for c in pair:
        known = known.where(F.col(c).isNotNull())
    return known.join(allowed.select(*pair).distinct(), list(pair), "left_anti")


def balance_breaks(movements: DataFrame, key: str, ts: str, event: str, amount: str, balance: str,
                   slice_seconds: int = DAY, hot: Hot = HOT_ROWS) -> DataFrame:
    """Movements after which the balance is not the previous balance plus the movement."""
    rows = movements.where(F.col(key).isNotNull() & F.col(balance).isNotNull())
    seq = with_previous(rows, [key], [ts, event], {"balance": F.col(balance)}, "_prev",
                        time_slice(ts, slice_seconds), hot)
    expected = F.col("_prev.balance") + F.col(amount)
    return (seq.where(F.col(balance) != expected)
               .withColumns({"expected_balance": expected, "difference": F.col(balance) - expected}).drop("_prev"))


def looted_by_other(loots: DataFrame, drops: DataFrame) -> DataFrame:
    """Items looted by somebody else than the member they were assigned to."""
    right = first_known(drops, "item_instance_id", ["assigned_character_id"])
    return loots.join(right, "item_instance_id").where(F.col("character_id") != F.col("assigned_character_id"))


def reward_after_exit(rewards: DataFrame, exits: DataFrame, by: Sequence[str], ts: str = "event_ts_utc") -> DataFrame:
    """Rewards received after the first exit (death, escape) from the same fight."""
    left = exits.groupBy(*by).agg(F.min(ts).alias("exited_at"))
    return rewards.join(left, list(by)).where(F.col(ts) > F.col("exited_at"))


def moved_while_away(events: DataFrame, login: str = "session_login", logout: str = "session_logout",
                     slice_seconds: int = DAY, hot: Hot = HOT_ROWS) -> DataFrame:
    """Logins directly after a logout, in another place than the logout."""
    rows = events.where(F.col("event_type").isin(login, logout) & F.col("character_id").isNotNull()).select(
        "event_id", "event_type", "event_ts_utc", "character_id", "zone_id")
    seq = with_previous(rows, ["character_id"], ["event_ts_utc", "event_id"],
                        {"type": F.col("event_type"), "zone": F.col("zone_id")}, "_prev",
                        time_slice("event_ts_utc", slice_seconds), hot)
    bad = seq.where((F.col("event_type") == login) & (F.col("_prev.type") == logout)
                    & (F.col("_prev.zone") != F.col("zone_id")))
    return bad.select("event_id", "character_id", "event_ts_utc", F.col("_prev.zone").alias("logout_zone_id"),
                      F.col("zone_id").alias("login_zone_id"))


def concurrent_members(members: DataFrame, group: str, member: str, start: str, stop: str,
                       slice_seconds: int = 30 * DAY, hot: Hot = HOT_ROWS) -> DataFrame:
    """Largest number of members a group ever had at once.

    Every stay is +1 at its start and -1 at its end; at one instant departures come first.
    """
    stays = members.where(F.col(group).isNotNull() & F.col(start).isNotNull())
    entry = F.struct(F.col(start).alias("at"), F.lit(1).cast("bigint").alias("step"))
    leave = F.when(F.col(stop).isNotNull(), F.struct(F.col(stop).alias("at"), F.lit(-1).cast("bigint").alias("step")))
    steps = stays.select(group, member, F.explode(F.array_compact(F.array(entry, leave))).alias("s")).select(
        group, member, "s.at", "s.step")
    # identical steps are one row with their sum, so the order below is total
    steps = steps.groupBy(group, "at", "step", member).agg(F.sum("step").alias("delta"))
    load = running_sum(steps, [group], ["at", "step", member], F.col("delta"), "members",
                       time_slice("at", slice_seconds), hot)
    return load.groupBy(group).agg(F.max("members").alias("max_members"),
                                   F.min_by("at", F.struct(-F.col("members"), F.col("at"))).alias("first_reached_at"))


def mixed_groups(members: DataFrame, group: str, attribute: str) -> DataFrame:
    """Groups whose members do not share one value of an attribute (such as the faction)."""
    kinds = members.where(F.col(attribute).isNotNull()).groupBy(group).agg(
        F.min(attribute).alias("lowest"), F.max(attribute).alias("highest"))
    return kinds.where(F.col("lowest") != F.col("highest"))


def no_origin(events: DataFrame, item: str, origin: Column) -> DataFrame:
    """Items that appear in events although nothing ever brought them into the game before.

    One row per item: its first event, and its first origin event if there is one later.
    """
    seen = events.where(F.col(item).isNotNull()).groupBy(item).agg(
        F.min("event_ts_utc").alias("first_seen_at"), F.count("*").alias("events"),
        F.min(F.when(origin, F.col("event_ts_utc"))).alias("origin_at"))
    return seen.where(F.col("origin_at").isNull() | (F.col("origin_at") > F.col("first_seen_at")))


def state_vs_events(snapshot: DataFrame, events: DataFrame, key: str, value: str, reported: str,
                    ts: str = "event_ts_utc", event: str = "event_id") -> DataFrame:
    """Snapshot values that differ from the last value the event log reported."""
    last = events.where(F.col(key).isNotNull() & F.col(reported).isNotNull()).groupBy(key).agg(
        F.max_by(reported, F.struct(ts, event)).alias("_last"))
    return (snapshot.select(key, F.col(value).alias("snapshot_value")).join(last, key)
                    .where(F.col("snapshot_value") != F.col("_last"))
                    .select(key, "snapshot_value", F.col("_last").alias("event_value")))


def ratio_to_bound(df: DataFrame, by: Sequence[str], value: Column, bound: Column) -> DataFrame:
    """How far values reach relative to what is legal: median (exact), mean, largest, share above."""
    share = ratio(value, bound)
    summary = df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.avg(share).alias("mean_ratio"), F.max(share).alias("max_ratio"),
        F.count_if(share > 1).alias("above_bound"))
    return with_quantile(summary, df, by, share, "median_ratio")


def longest_session(sessions: DataFrame, max_hours: float = 20.0) -> DataFrame:
    """Longest session per character, and on how many days it played more than `max_hours`."""
    per_day = sessions.groupBy("character_id", "session_date").agg(
        F.sum("duration_s").alias("s"), F.max("duration_s").alias("m"), F.count("*").alias("n"))
    return per_day.groupBy("character_id").agg(
        F.max("m").alias("longest_s"), F.sum("n").alias("sessions"), F.count("*").alias("days_played"),
        F.count_if(F.col("s") > max_hours * 3600).alias("long_days"))


def pair_net_flow(transfers: DataFrame, giver: str, receiver: str, amount: Column) -> DataFrame:
    """What two characters gave each other, and the net from the smaller id to the larger."""
    low, high = F.least(giver, receiver), F.greatest(giver, receiver)
    forward = F.col(giver) == low
    return (transfers.where(F.col(giver) != F.col(receiver)).select(
                low.alias("character_a"), high.alias("character_b"),
                F.when(forward, amount).otherwise(0).alias("_ab"), F.when(forward, 0).otherwise(amount).alias("_ba"))
            .groupBy("character_a", "character_b")
            .agg(F.count("*").alias("transfers"), F.sum("_ab").alias("a_to_b"), F.sum("_ba").alias("b_to_a"))
            .withColumn("net_a_to_b", F.col("a_to_b") - F.col("b_to_a")))


def creation_clusters(accounts: DataFrame, key: Sequence[str], created: str, gap_seconds: int,
                      member: str, slice_seconds: int = 30 * DAY, hot: Hot = HOT_ROWS) -> DataFrame:
    """Number the runs of accounts created within `gap_seconds` of the one before, per key.

    Returns each account with its `cluster`. Group it to get sizes.
    """
    order, piece = [created, member], time_slice(created, slice_seconds)
    seq = with_previous(accounts, key, order, {"at": F.col(created)}, "_prev", piece, hot)
    opens = F.when(seconds_between(created, "_prev.at") <= gap_seconds, 0).otherwise(1).cast("bigint")
    return running_sum(seq.withColumn("_opens", opens), key, order, F.col("_opens"), "cluster", piece,
                       hot).drop("_prev", "_opens")


def cluster_sizes(clusters: DataFrame, key: Sequence[str], created: str, min_size: int) -> DataFrame:
    return (clusters.groupBy(*key, "cluster").agg(F.count("*").alias("size"), F.min(created).alias("first_at"),
                                                  F.max(created).alias("last_at"))
                    .where(F.col("size") >= min_size))


def always_together(clusters: DataFrame, memberships: DataFrame, by: Sequence[str], member: str,
                    party: str) -> DataFrame:
    """Of all parties a cluster's members joined, how many held the whole cluster (no pairs are built)."""
    size = clusters.groupBy(*by).agg(F.count("*").alias("size"))
    joined = memberships.select(member, party).distinct().join(clusters.select(member, *by), member)
    per_party = joined.groupBy(*by, party).agg(F.count("*").alias("present"))
    return (per_party.join(size, list(by)).groupBy(*by, "size")
                     .agg(F.count("*").alias("parties"), F.count_if(F.col("present") == F.col("size")).alias("full_parties")))


def offender_timeline(events: DataFrame, found: DataFrame, who: DataFrame) -> DataFrame:
    """Events and violations of the given characters side by side, in time order per character."""
    actors = who.select("character_id").distinct()
    no_text = F.lit(None).cast("string")
    logged = events.select("character_id", F.col("event_ts_utc").alias("at"), F.lit("event").alias("source"),
                           F.col("event_type").alias("what"), no_text.alias("detail"), "event_id")
    flagged = found.select("character_id", F.col("occurred_at").alias("at"), F.lit("violation").alias("source"),
                           F.col("rule_id").alias("what"), "detail",
                           F.element_at("evidence_event_ids", -1).alias("event_id"))
    return (logged.unionByName(flagged).join(actors, "character_id", "left_semi")
                  .orderBy("character_id", "at", "source", "event_id"))


def before_after(events: DataFrame, by: Sequence[str], ts: str, release: Column) -> DataFrame:
    """Use before and after a release, as counts and as counts per day observed."""
    after = F.col(ts) >= release
    date = F.col(ts).cast("date")
    per_day = events.groupBy(*by, date.alias("_day"), after.alias("_after")).agg(F.count("*").alias("n"))

    def side(flag: Column, name: str) -> list[Column]:
        return [F.coalesce(F.sum(F.when(flag, F.col("n"))), F.lit(0)).alias(f"uses_{name}"),
                F.count_if(flag).alias(f"days_{name}")]

    out = per_day.groupBy(*by).agg(*side(~F.col("_after"), "before"), *side(F.col("_after"), "after"))
    rate_b, rate_a = (ratio(F.col(f"uses_{n}"), F.col(f"days_{n}")) for n in ("before", "after"))
    return out.withColumn("change_pct", F.round((ratio(rate_a, rate_b) - 1) * 100, 1))


def fight_speed(kills: DataFrame, by: str, seconds: str, factor: float = 3.0) -> DataFrame:
    """Fastest against typical fight per creature; an outlier is `factor` times faster than typical."""
    timed = kills.where(F.col(seconds).isNotNull())
    speed = timed.groupBy(by).agg(F.count("*").alias("fights"), F.min(seconds).alias("fastest_s"), F.avg(seconds).alias("mean_s"))
    speed = with_quantile(speed, timed, [by], F.col(seconds), "typical_s")
    return speed.withColumn("outlier", F.col("fastest_s") * factor < F.col("typical_s"))
