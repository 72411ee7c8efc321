"""Data-quality operators: each takes a frame and returns a frame, nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.columns import col, nulls_for, repair_int, repair_label, seconds_between
from eventmart.operators.ordered import HOT_ROWS, Hot, with_next
from eventmart.operators.quantiles import with_quantile


def dedup_first(df: DataFrame, key: str = "server_event_id", order: str = "event_id",
                count_col: str = "delivery_count") -> DataFrame:
    """Keep the first delivery of every event and say how often it was delivered.

    The choice is made on the two narrow id columns (a hash aggregate, so a third of all rows
    being copies of one event is no hot task) and joined back on the unique delivery id, which
    cannot be skewed.
    """
    keep = df.groupBy(key).agg(F.min(order).alias(order), F.count("*").alias(count_col)).select(order, count_col)
    return df.join(keep, order)


def clock_correct(df: DataFrame, corrections: DataFrame, server: str = "server_id", seq: str = "shard_seq",
                  ts: str = "event_ts", into: str = "event_ts_utc") -> DataFrame:
    """Shift the timestamps of the sequence ranges listed in `corrections`; flag what was shifted.

    `corrections` (server_id, from_shard_seq, to_shard_seq or NULL, add_to_event_ts) is a short
    reviewed list; see `overlapping_corrections` for the check that rows cannot fan out.
    """
    c = corrections.select(F.col("server_id").alias("_server"), F.col("from_shard_seq").alias("_from"),
                           F.col("to_shard_seq").alias("_to"), F.col("add_to_event_ts").alias("_add"))
    inside = ((F.col(server) == F.col("_server")) & (F.col(seq) >= F.col("_from"))
              & (F.col("_to").isNull() | (F.col(seq) <= F.col("_to"))))
    joined = df.join(c, inside, "left")
    hit = F.col("_server").isNotNull()
    return (joined.withColumn(into, F.when(hit, F.col(ts) + F.col("_add")).otherwise(F.col(ts)))
                  .withColumn("ts_corrected", hit).drop("_server", "_from", "_to", "_add"))


def overlapping_corrections(corrections: DataFrame) -> DataFrame:
    """Corrections that start before the previous one of the same server has ended (must be empty)."""
    nexts = with_next(corrections, ["server_id"], ["from_shard_seq"], {"start": F.col("from_shard_seq")}, "_next")
    late = F.col("to_shard_seq").isNull() | (F.col("_next.start") <= F.col("to_shard_seq"))
    return nexts.where(F.col("_next").isNotNull() & late).drop("_next")


def placeholders_to_null(df: DataFrame, placeholders: Mapping[str, object]) -> DataFrame:
    """Turn a known placeholder of each named column into NULL."""
    return df.withColumns({c: nulls_for(c, p) for c, p in placeholders.items()})


def repair_columns(df: DataFrame, columns: Sequence[str], label: str = "numeric_repair") -> DataFrame:
    """Repair corrupted integers in place, keep each original as `<name>_raw`, say what was done."""
    raw = {f"{c}_raw": F.col(c) for c in columns}
    return df.withColumns({**raw, label: repair_label(columns), **{c: repair_int(c) for c in columns}})


def first_known(df: DataFrame, key: str, columns: Sequence[str], order: str = "event_id") -> DataFrame:
    """One row per key with the first non-NULL value of each column along `order`."""
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*picks)


def recover_attribute(df: DataFrame, donors: DataFrame, key: str, column: str, order: str = "event_id") -> DataFrame:
    """Fill NULLs of `column` from other events of the same entity."""
    known = first_known(donors.where(F.col(column).isNotNull()), key, [column], order)
    known = known.select(F.col(key).alias("_key"), F.col(column).alias("_value"))
    return (df.join(known, F.col(key) == F.col("_key"), "left")
              .withColumn(column, F.coalesce(F.col(column), F.col("_value"))).drop("_key", "_value"))


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL reference exists nowhere in the parent."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return df.where(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_parent"), "left_anti")


def gap_edges(df: DataFrame, part: str = "server_id", seq: str = "shard_seq", ts: str = "event_ts_utc",
              bucket: int = 1_000_000, hot: Hot = HOT_ROWS) -> DataFrame:
    """One row per hole in a consecutive numbering, with its neighbours.

    A shard's stream is one enormous key (one of four may hold most rows), so it is cut by
    sequence number and only the slice borders meet again.
    """
    rows = df.where(F.col(part).isNotNull() & F.col(seq).isNotNull()).select(part, seq, ts)
    piece = F.floor(F.col(seq) / F.lit(bucket)).cast("bigint")
    nexts = with_next(rows, [part], [seq], {"seq": F.col(seq), "ts": F.col(ts)}, "_next", piece, hot)
    return nexts.where(F.col("_next.seq") - F.col(seq) > 1).select(
        part, F.col(seq).alias("prev_seq"), F.col(ts).alias("prev_event_ts"),
        F.col("_next.seq").alias("next_seq"), F.col("_next.ts").alias("next_event_ts"))


def seq_gaps(df: DataFrame, part: str = "server_id", seq: str = "shard_seq", ts: str = "event_ts_utc",
             bucket: int = 1_000_000, hot: Hot = HOT_ROWS, block: int = 10_000) -> DataFrame:
    """Every missing sequence number with the events either side of it.

    A hole is cut into stretches of block * block numbers and these into blocks, which a shuffle
    spreads before they are expanded: one huge hole is neither one huge array nor one task.
    """
    edges = gap_edges(df, part, seq, ts, bucket, hot)
    wide = F.sequence(F.col("prev_seq") + 1, F.col("next_seq") - 1, F.lit(block * block).cast("bigint"))
    wide_end = F.least(F.col("_wide") + (block * block - 1), F.col("next_seq") - 1)
    starts = F.sequence(F.col("_wide"), wide_end, F.lit(block).cast("bigint"))
    blocks = edges.withColumn("_wide", F.explode(wide)).withColumn("_start", F.explode(starts))
    last = F.least(F.col("_start") + (block - 1), F.col("next_seq") - 1)
    return (blocks.repartition(part, "_start").withColumn("missing_seq", F.explode(F.sequence(F.col("_start"), last)))
                  .select(part, "missing_seq", "prev_seq", "prev_event_ts", "next_seq", "next_event_ts"))


def shard_quality(deliveries: DataFrame, kept: DataFrame, bucket: int = 1_000_000,
                  hot: Hot = HOT_ROWS) -> DataFrame:
    """Per shard: rows, unique events, extra copies, gaps, lost events, largest gap, delivery delay."""
    copies = deliveries.groupBy("server_id").agg(F.count("*").alias("rows"))
    delay_ms = (F.unix_micros("received_at") - F.unix_micros("event_ts_utc")) / F.lit(1000)
    unique = kept.groupBy("server_id").agg(
        F.count("*").alias("unique_events"),
        F.max(delay_ms).alias("longest_delay_ms"), F.avg(delay_ms).alias("mean_delay_ms"))
    unique = with_quantile(unique, kept, ["server_id"], delay_ms, "typical_delay_ms")
    size = F.col("next_seq") - F.col("prev_seq") - 1
    gaps = gap_edges(kept, bucket=bucket, hot=hot).groupBy("server_id").agg(
        F.count("*").alias("gaps"), F.sum(size).alias("lost_events"), F.max(size).alias("largest_gap"))
    return (copies.join(unique, "server_id", "left").join(gaps, "server_id", "left")
                  .withColumn("extra_rows", F.col("rows") - F.col("unique_events"))
                  .fillna(0, ["gaps", "lost_events", "largest_gap"]))


def repair_proof(repaired: DataFrame, reference: DataFrame, key: str, value: str, expected: str) -> DataFrame:
    """How many repaired values equal the reference data they should equal."""
    known = repaired.where(F.col(value).isNotNull()).join(reference.select(key, expected), key)
    fixed = F.col(f"{value}_raw") != F.col(value)
    same = F.col(value) == F.col(expected)
    return known.agg(F.count("*").alias("compared"), F.count_if(same).alias("equal"),
                     F.count_if(fixed).alias("repaired"), F.count_if(fixed & same).alias("repaired_equal"))


def dq_summary(deliveries: DataFrame, kept: DataFrame, characters: DataFrame,
               no_character_types: Sequence[str] = ("item_dropped",), level_event: str = "level_up",
               placeholder: str = "zone_unknown", hot: Hot = HOT_ROWS) -> DataFrame:
    """One row per check with the number of affected rows.

    Each check is a conditional aggregate over the cleaned table, unpivoted at the end. Unknown
    characters are counted per character before the characters are looked up, so a character with
    very many events is one row of that join. The placeholder check counts delivered rows by text
    (before deduplication), as delivered.
    """
    delivered = deliveries.agg(
        F.count("*").alias("n"), F.count_if(F.col("body").contains(placeholder)).alias("DQ-5a"))
    per_character = kept.groupBy("character_id").agg(F.count("*").alias("n"))
    unknown = orphans(per_character, "character_id", characters, "character_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("DQ-5b"))
    has_body, no_character = ~F.col("body_missing"), F.col("character_id").isNull()
    checks = {
        "kept": F.count("*"),
        "DQ-3": F.count_if("ts_corrected"),
        "DQ-4a": F.count_if("body_missing"),
        "DQ-4b": F.count_if(no_character & has_body & ~F.col("event_type").isin(*no_character_types)),
        "DQ-6a": F.count_if(F.col("numeric_repair") == "bitflip_recovered"),
        "DQ-6b": F.count_if(F.col("numeric_repair") == "overflow_nulled"),
        "DQ-7": F.count_if((F.col("event_type") == level_event) & F.col("new_level").isNull() & has_body),
    }
    counts = kept.agg(*[c.alias(k) for k, c in checks.items()])
    gaps = gap_edges(kept, hot=hot).agg(
        F.coalesce(F.sum(F.col("next_seq") - F.col("prev_seq") - 1), F.lit(0)).alias("DQ-2"))

    def rows(one: DataFrame, ids: Sequence[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(i).alias("part"), F.col(f"`{i}`").cast("bigint").alias("n")) for i in ids])
        return one.select(F.explode(pairs).alias("p")).select("p.part", "p.n")

    parts = (rows(delivered, ["n", "DQ-5a"]).unionByName(rows(gaps, ["DQ-2"]))
             .unionByName(rows(unknown, ["DQ-5b"])).unionByName(rows(counts, list(checks))))
    # deliveries less kept events = removed copies
    check = F.when(F.col("part").isin("n", "kept"), "DQ-1").otherwise(F.col("part"))
    sign = F.when(F.col("part") == "kept", -1).otherwise(1)
    names = F.create_map(*[F.lit(x) for pair in CHECK_NAMES.items() for x in pair])
    return (parts.groupBy(check.alias("check_id")).agg(F.sum(F.col("n") * sign).alias("affected_rows"))
                 .select("check_id", names[F.col("check_id")].alias("check_name"), "affected_rows"))


# Check ids and their published names.
CHECK_NAMES = {
    "DQ-1": "Duplicate deliveries removed",
    "DQ-2": "Events lost in delivery (shard_seq gaps)",
    "DQ-3": "Timestamps corrected for shard clock fault",
    "DQ-4a": "Events with an empty body",
    "DQ-4b": "Events missing character_id where the type requires it",
    "DQ-5a": "Placeholder zone_unknown replaced by NULL",
    "DQ-5b": "Events referencing a character that does not exist",
    "DQ-6a": "Corrupted integers recovered (bitwise NOT)",
    "DQ-6b": "Corrupted integers unrecoverable (set to NULL)",
    "DQ-7": "Level-up events reporting level 0 (set to NULL)",
}


def skew_by_hour(events: DataFrame, alarm_seconds: float = 60.0) -> DataFrame:
    """Delivery lag per shard and receive hour; hours beyond the alarm propose a correction.

    The proposal is the lag rounded to whole quarter hours, with the sequence range it was seen in.
    """
    lag = seconds_between("received_at", "event_ts")
    hourly = (events.groupBy("server_id", F.window("received_at", "1 hour").alias("w"))
                    .agg(F.count("*").alias("events"), F.min(lag).alias("min_lag_s"),
                         F.min("shard_seq").alias("from_shard_seq"), F.max("shard_seq").alias("to_shard_seq")))
    return hourly.select("server_id", F.col("w.start").alias("hour_start"), "events", "min_lag_s",
                         (F.col("min_lag_s") > alarm_seconds).alias("alarm"),
                         F.when(F.col("min_lag_s") > alarm_seconds,
                                (F.round(F.col("min_lag_s") / 900) * 900).cast("bigint")).alias("proposed_add_s"),
                         "from_shard_seq", "to_shard_seq")


def spans_by_hour(events: DataFrame) -> DataFrame:
    """The span of sequence numbers seen per shard and receive hour.

    Only aggregates that merge are used, so it also runs on a stream whose copies were dropped
    upstream.
    """
    return (events.groupBy("server_id", F.window("received_at", "1 hour").alias("w"))
                  .agg(F.count("*").alias("events"), F.min("shard_seq").alias("first_seq"),
                       F.max("shard_seq").alias("last_seq"))
                  .select("server_id", F.col("w.start").alias("hour_start"), "events", "first_seq", "last_seq"))


def lost_events(spans: DataFrame) -> DataFrame:
    """Lost events per shard and hour, those between two hours counted in the later one.

    What is missing up to an hour is the span of all numbers seen so far less the events seen so
    far; an hour's loss is how much that grew. It is negative where an hour brings late events. The
    sum over a shard's hours is the number of its sequence gaps. A shard has one row per hour here.
    """
    order = Window.partitionBy("server_id").orderBy("hour_start")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    missing = F.max("last_seq").over(so_far) - F.min("first_seq").over(so_far) + 1 - F.sum("events").over(so_far)
    counted = spans.withColumn("_missing", missing)
    return counted.select("server_id", "hour_start", "events",
                          (F.col("_missing") - F.coalesce(F.lag("_missing").over(order), F.lit(0))).alias("lost_events"))


def loss_by_hour(events: DataFrame) -> DataFrame:
    """Lost events per shard and receive hour, from the sequence numbers seen."""
    return lost_events(spans_by_hour(events))
