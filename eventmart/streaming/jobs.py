"""Structured Streaming forms of the detections that should not wait for the batch.

Every job is DataFrame in, DataFrame out; `run_to_table` drains a stream into a Parquet table.
Rows later than the watermark are dropped, so stream and batch agree within it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventmart.operators.quality import skew_by_hour, spans_by_hour
from eventmart.plans.findings import rules_of, violation_key

LATENESS = "2 hours"


def dedup_stream(deliveries: DataFrame, key: str = "server_event_id", ts: str = "received_at",
                 lateness: str = LATENESS) -> DataFrame:
    """One row per event: redeliveries within the watermark are dropped."""
    return deliveries.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def skew_stream(deliveries: DataFrame, alarm_seconds: float = 60.0, lateness: str = LATENESS) -> DataFrame:
    """Delivery lag per shard and hour, with a proposed correction beyond the alarm."""
    return skew_by_hour(dedup_stream(deliveries, lateness=lateness), alarm_seconds)


def loss_stream(deliveries: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The span of sequence numbers per shard and closed hour; `quality.lost_events` turns the stored rows into losses.

    An hour is written once the watermark has passed it; the last hours of a stream stay open.
    """
    return spans_by_hour(dedup_stream(deliveries, lateness=lateness))


def burst_stream(hits: DataFrame, min_hits: int = 2, lateness: str = LATENESS) -> DataFrame:
    """Several hits of one character in one encounter at one instant, as soon as the instant is closed."""
    return (hits.where(F.col("damage").isNotNull()).withWatermark("event_ts_utc", lateness)
                .groupBy("event_ts_utc", "character_id", "encounter_id")
                .agg(F.count("*").alias("hits"), F.sum("damage").alias("damage"),
                     F.min("event_id").alias("first_event_id"))
                .where(F.col("hits") >= min_hits))


class TransferTracker(StatefulProcessor):
    """Per item: hand-overs that wait for the watermark, who holds it, and the last hand-over of each giver.

    Hand-overs are judged in time order once the watermark has passed them, whatever batch brought them. A waiting row
    stays for the lateness at most, a giver for `remember_ms` after the last hand-over; then a timer clears them, and
    an item that no longer moves has no state at all.
    """

    WAITING = ["event_id", "ms", "us", "giver", "holder_after"]

    def __init__(self, remember_ms: int) -> None:
        self.remember_ms = remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "event_id bigint, ms bigint, us bigint, giver string, holder_after string")
        self.holder = handle.getValueState("holder", "holder string")
        self.given = handle.getListState("given", "giver string, event_id bigint, us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for part in rows:
            self.waiting.appendList(as_rows(part[self.WAITING]))
            first = part["ms"].min() if first is None else min(first, part["ms"].min())
        if first is not None:
            self.handle.registerTimer(int(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        waiting = pd.DataFrame(list(self.waiting.get()), columns=self.WAITING)
        past = waiting["ms"] < now
        due, later = waiting[past].sort_values(["us", "event_id"]), waiting[~past]
        given = pd.DataFrame(list(self.given.get()), columns=["giver", "event_id", "us"])
        if len(due):
            holder = self.holder.get()[0] if self.holder.exists() else None
            held_by = due["holder_after"].shift()
            held_by.iloc[0] = holder
            # the last hand-over of each known giver goes before the rows that are due
            gave = pd.concat([given.assign(held_by=None, due=False), due[["giver", "event_id", "us"]].assign(held_by=held_by, due=True)], ignore_index=True)
            gave = gave[gave["giver"].notna()]
            before = gave.groupby("giver", sort=False)[["event_id", "us"]].shift()
            bad = (gave["due"].astype(bool) & before["event_id"].notna() & gave["held_by"].notna() & (gave["held_by"] != gave["giver"])
                   & (gave["us"] - before["us"] <= self.remember_ms * 1000))
            found = gave[bad]
            if len(found):
                yield pd.DataFrame({"item_instance_id": key[0], "character_id": found["giver"], "held_by": found["held_by"],
                                    "first_event_id": before["event_id"][bad].astype("int64"), "event_id": found["event_id"].astype("int64")})
            given = gave.drop_duplicates("giver", keep="last")[["giver", "event_id", "us"]]
            self.holder.update((due["holder_after"].iloc[-1],))
            put(self.waiting, later[self.WAITING])
        given = given[given["us"] // 1000 + self.remember_ms >= now]
        put(self.given, given)
        if len(later):
            self.handle.registerTimer(int(later["ms"].min()))
        if len(given):
            self.handle.registerTimer(int(given["us"].min() // 1000 + self.remember_ms))
        elif not len(later):
            self.holder.clear()

    def close(self) -> None:
        pass


def as_rows(part: pd.DataFrame) -> list[tuple]:
    return list(part.astype(object).where(part.notna(), None).itertuples(index=False, name=None))


def put(state, rows: pd.DataFrame) -> None:
    """Replace a list state."""
    if len(rows):
        state.put(as_rows(rows))
    else:
        state.clear()


def duplicate_transfer_stream(moves: DataFrame, lateness: str = LATENESS, remember_days: int = 30) -> DataFrame:
    """Hand-overs of an item by somebody who gave it away before and does not hold it.

    A hand-over is judged when the watermark has passed it, in the order of time and event id; those of the last
    `lateness` of a stream stay open, as do those without a time or an item. The earlier hand-over counts for
    `remember_days`. Within these bounds the result is that of `rules.item_duplication`, however the rows
    are dealt to batches. An item's state holds its rows of the last `lateness` and one row for each giver of the
    last `remember_days`.
    """
    schema = ("item_instance_id string, character_id string, held_by string, first_event_id bigint, event_id bigint")
    known = moves.where(F.col("item_instance_id").isNotNull() & F.col("event_ts_utc").isNotNull())
    timed = known.select("item_instance_id", "event_id", "event_ts_utc", F.unix_millis("event_ts_utc").alias("ms"),
                         F.unix_micros("event_ts_utc").alias("us"), "giver", "holder_after").withWatermark("event_ts_utc", lateness)
    return timed.groupBy("item_instance_id").transformWithStateInPandas(
        TransferTracker(remember_days * 86_400_000), schema, outputMode="Append", timeMode="EventTime")


def run_to_table(stream: DataFrame, folder: str) -> DataFrame:
    """Process everything that is there, append it to a Parquet table, and open the table."""
    running = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                     .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/table").start())
    running.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")


def alert_day(columns: list[str]) -> Column:
    """The day a violation happened on; it is the same whenever the violation is found. Without a time: one fixed day."""
    unknown = F.lit("1970-01-01").cast("date")
    return F.coalesce(F.to_date("occurred_at"), unknown) if "occurred_at" in columns else unknown


def write_new_alerts(batch: DataFrame, batch_id: int, table: str) -> None:
    """Append the violations no earlier batch has reported.

    Each batch owns one partition, which a repeated batch replaces, so a restart reports nothing
    twice and loses nothing. Within it alerts lie by day, and only the days that occur in the batch
    are looked up; the driver holds one date for each of them.
    """
    day = alert_day(batch.columns)
    keyed = batch.withColumn("violation_key", violation_key(batch.columns)).dropDuplicates(["violation_key"]).withColumn("day", day)
    days = [r.day for r in batch.select(day.alias("day")).distinct().collect()]
    known = batch.sparkSession.read.parquet(table).where(
        (F.col("batch_id") < batch_id) & F.col("day").isin(days)).select("violation_key")
    fresh = keyed.join(known, "violation_key", "left_anti")
    fresh.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{table}/batch_id={batch_id}")


def run_alerts(found: DataFrame, folder: str, severity: str | None = None) -> DataFrame:
    """Feed a stream of findings into the alert table and open it; with `severity`, those of such rules only."""
    table = f"{folder}/table"
    spark = found.sparkSession
    if severity is not None:
        found = found.where(F.col("rule_id").isin(rules_of(severity)))
    empty = spark.createDataFrame([], found.schema).withColumn("violation_key", F.lit(None).cast("string"))
    # so the table can be read from the first batch on
    empty.write.mode("ignore").parquet(f"{table}/batch_id=-1/day=1970-01-01")
    running = (found.writeStream.foreachBatch(lambda df, i: write_new_alerts(df, i, table))
                    .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    running.awaitTermination()
    return spark.read.parquet(table).drop("day")
