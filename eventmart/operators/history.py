"""Time-varying state: interval histories, chains of custody, paired start/stop events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.functions.columns import bracket_min, col, seconds_between, time_slice
from eventmart.operators.ordered import HOT_ROWS, Hot, all_cold, number_rows, with_next, with_previous

# The open ends of every interval.
BEGINNING, END = "2000-01-01 00:00:00", "2100-01-01 00:00:00"


def history_from_changes(changes: DataFrame, snapshot: DataFrame, key: str, ts: str, value: str,
                         before_first: Column | None = None, slice_seconds: int = 7 * 86_400,
                         hot: Hot = HOT_ROWS) -> DataFrame:
    """One row per value held, with half-open [valid_from, valid_to).

    The value held before the first change is `before_first` (an expression over the first
    changed value; that value itself if omitted). Keys of `snapshot` that never changed keep
    the snapshot value throughout. Of several changes at one instant the larger value ends up
    with the open interval, the others with an empty one.
    """
    known = changes.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(
        key, F.col(ts).alias("valid_from"), F.col(value).cast("int").alias(value))
    start = F.lit(BEGINNING).cast("timestamp")
    first = (known.groupBy(key).agg(F.min_by(value, F.struct("valid_from", value)).alias(value))
                  .select(key, start.alias("valid_from"),
                          (before_first if before_first is not None else F.col(value)).cast("int").alias(value)))
    unchanged = (snapshot.select(key, F.col(value).cast("int").alias(value))
                         .join(known.select(key).distinct(), key, "left_anti")
                         .select(key, start.alias("valid_from"), value))
    segments = known.unionByName(first).unionByName(unchanged)
    nexts = with_next(segments, [key], ["valid_from", value], {"at": F.col("valid_from")}, "_next",
                      time_slice("valid_from", slice_seconds), hot)
    return nexts.select(key, value, "valid_from",
                        F.coalesce("_next.at", F.lit(END).cast("timestamp")).alias("valid_to"))


def level_history(events: DataFrame, characters: DataFrame, hot: Hot = HOT_ROWS) -> DataFrame:
    """Level of every character over time, with its ten-level bracket."""
    ups = events.where(F.col("event_type") == "level_up").select(
        "character_id", "event_ts_utc", F.col("new_level").alias("level"))
    held = history_from_changes(ups, characters, "character_id", "event_ts_utc", "level",
                                before_first=F.col("level") - 1, hot=hot)
    low = bracket_min("level")
    return held.withColumns({"bracket_min_level": low, "bracket_max_level": low + 9})


def item_moves(events: DataFrame, use_received: bool = False) -> DataFrame:
    """One row per item hand-over, from a single scan of the log.

    `holder_after` is NULL once the item left the game or sits in escrow. Trades are read from
    the giver's side; `use_received` adds hand-overs known only from the receiver's side (the
    giver's event was lost in delivery).
    """
    kind = F.col("event_type")
    gained = kind.isin("item_looted", "auction_purchased", "auction_expired")
    released = kind.isin("auction_created", "item_sold")
    traded = kind == "trade_completed"
    single = (gained | released) & F.col("item_instance_id").isNotNull()
    items = F.when(traded, F.col("items_given")).when(single, F.array("item_instance_id"))
    base = events.where(traded | single).select(
        F.explode(items).alias("item_instance_id"), "event_ts_utc", "event_id", "server_event_id", "event_type",
        F.when(traded, F.col("counterpart_character_id")).when(gained, F.col("character_id")).alias("holder_after"),
        F.when(~gained, F.col("character_id")).alias("giver"),
        *([F.col("trade_id")] if use_received else []))
    if not use_received:
        return base
    seen = base.where(traded).select("trade_id", "item_instance_id").distinct()
    received = events.where(traded).select(
        F.explode("items_received").alias("item_instance_id"), "event_ts_utc", "event_id", "server_event_id",
        "event_type", F.col("character_id").alias("holder_after"), F.col("counterpart_character_id").alias("giver"),
        "trade_id").join(seen, ["trade_id", "item_instance_id"], "left_anti")
    return base.unionByName(received).drop("trade_id")


def custody_chain(moves: DataFrame, item: str = "item_instance_id", ts: str = "event_ts_utc",
                  event: str = "event_id", slice_seconds: int = 86_400, hot: Hot = HOT_ROWS) -> DataFrame:
    """Number the hand-overs of each item and add who held it just before."""
    keyed = moves.where(F.col(item).isNotNull())
    piece = time_slice(ts, slice_seconds)
    if all_cold(hot, [item]):  # both from one sort of the item's hand-overs
        along = W.partitionBy(item).orderBy(ts, event)
        return keyed.withColumns({"custody_step": F.row_number().over(along).cast("bigint"),
                                  "holder_before": F.lag("holder_after").over(along)})
    steps = number_rows(keyed, [item], [ts, event], "custody_step", piece, hot)
    chained = with_previous(steps, [item], ["custody_step"], {"holder": F.col("holder_after")}, "_prev",
                            piece, hot)
    return chained.withColumn("holder_before", F.col("_prev.holder")).drop("_prev")


def with_last_given(custody: DataFrame, slice_seconds: int = 86_400, hot: Hot = HOT_ROWS) -> DataFrame:
    """Add `last_given`: the previous hand-over of the same item by the same giver (NULL on the first, and without a giver).

    On a chain that is not stored yet its rows already lie by item, so nothing is moved for it.
    """
    evidence = {"event_id": F.col("event_id"), "server_event_id": F.col("server_event_id"), "ts": F.col("event_ts_utc")}
    again = with_previous(custody, ["item_instance_id", "giver"], ["event_ts_utc", "custody_step"], evidence, "_prev",
                          time_slice("event_ts_utc", slice_seconds), hot)
    return again.withColumn("last_given", F.when(F.col("giver").isNotNull(), F.col("_prev"))).drop("_prev")


def pair_sessions(events: DataFrame, start: str = "session_login", stop: str = "session_logout",
                  keep_open: bool = False, slice_seconds: int = 86_400, hot: Hot = HOT_ROWS) -> DataFrame:
    """Pair each start with the stop that directly follows it for the same character.

    Starts whose stop is missing are dropped; `keep_open` keeps them, closed at the next start
    (or open) and flagged.
    """
    rows = events.where(F.col("event_type").isin(start, stop) & F.col("character_id").isNotNull())
    nexts = with_next(rows.select("character_id", "event_id", "event_type", "event_ts_utc", "zone_id"),
                      ["character_id"], ["event_ts_utc", "event_id"],
                      {"type": F.col("event_type"), "ts": F.col("event_ts_utc")}, "_next",
                      time_slice("event_ts_utc", slice_seconds), hot)
    missing = ~F.col("_next.type").eqNullSafe(F.lit(stop))
    out = nexts.where(F.col("event_type") == start).select(
        "character_id", F.col("event_ts_utc").alias("login_at"), F.col("_next.ts").alias("logout_at"),
        F.col("event_ts_utc").cast("date").alias("session_date"), F.col("zone_id").alias("login_zone_id"),
        seconds_between("_next.ts", "event_ts_utc").alias("duration_s"), missing.alias("logout_missing"))
    return out if keep_open else out.where(~F.col("logout_missing"))
