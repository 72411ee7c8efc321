"""The cleaned event table: one row per game event, trustworthy time, body unpacked."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventmart.functions.bodies import parse_body, unpack
from eventmart.operators.quality import clock_correct, dedup_first

LINEAGE = ["event_id", "server_event_id", "server_id", "shard_seq", "source_batch_id", "source_file",
           "delivery_count"]
IDENTITY = ["event_type", "schema_version", "game_version", "event_ts_utc", "event_ts_raw", "ts_corrected",
            "received_at", "body_missing"]


def stg_events(deliveries: DataFrame, corrections: DataFrame) -> DataFrame:
    """Deliveries -> events: first copy, corrected clock, one parse of the body, repaired numbers."""
    kept = dedup_first(deliveries)
    timed = clock_correct(kept, corrections).withColumnRenamed("event_ts", "event_ts_raw")
    parsed = parse_body(timed)
    return parsed.select(*LINEAGE, *IDENTITY, *unpack(parsed), parsed["body"].alias("body_raw"))
