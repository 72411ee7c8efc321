"""Incremental load that recognizes a redelivery however late it comes.

The keys of all events loaded so far lie in a table of their own, in buckets of the key's hash and with
the day each key was first received. A batch is joined against the buckets its keys fall into, nothing
else is read. In place of a watermark's state, which forgets, the index grows with the events and lies in
files; `compact_keys` keeps it at one set of files per bucket.

Each load owns one partition of the events and one of the index, and looks only at earlier loads, so a
load that is repeated after a failure replaces what it wrote and decides the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS, KEYS = "events", "keys"
KEY_SCHEMA = "key string, first_received_day date, load_id bigint, bucket int"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def known_keys(spark: SparkSession, folder: str, before: int, buckets_met: list[int] | None = None) -> DataFrame:
    """(key, first_received_day) of the loads before `before`, from the named buckets or all."""
    keys = spark.read.schema(KEY_SCHEMA).parquet(f"{folder}/{KEYS}").where(F.col("load_id") < before)
    if buckets_met is not None:
        keys = keys.where(F.col("bucket").isin(buckets_met))
    return keys.select("key", "first_received_day")


def open_index(spark: SparkSession, folder: str) -> None:
    """Make an empty index, if there is none, so the first load can read it."""
    empty = spark.createDataFrame([], "key string, first_received_day date")
    empty.write.mode("ignore").parquet(f"{folder}/{KEYS}/load_id=-1/bucket=0")


def load_batch(batch: DataFrame, load_id: int, folder: str, key: str = "server_event_id", order: str = "event_id",
               received: str = "received_at", buckets: int = 256) -> None:
    """Append the events of a batch that no earlier load has brought.

    Of several deliveries within the batch the one with the smallest `order` stays. Rows without a key cannot be
    recognized and all stay. The driver holds the numbers of the buckets met, `buckets` at most. `buckets` must be the
    same for all loads of a folder.
    """
    spark = batch.sparkSession
    # whether a row is the first of its key is decided on two narrow columns: a key with very many copies is no hot task
    firsts = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"), F.min(received).alias("_seen"))
    firsts = firsts.select(F.col(key).alias("_key"), "_first", F.to_date("_seen").alias("_day"), bucket_of(F.col(key), buckets).alias("_bucket"))
    met = sorted(r["_bucket"] for r in firsts.select("_bucket").distinct().collect())
    known = known_keys(spark, folder, load_id, met).select(F.col("key").alias("_known"))
    keys = f"{folder}/{KEYS}/load_id={load_id}"
    new = firsts.join(known, F.col("_key") == F.col("_known"), "left_anti")
    named = new.select(F.col("_key").cast("string").alias("key"), F.col("_day").alias("first_received_day"), F.col("_first"), F.col("_bucket").alias("bucket"))
    # the look-up is done once: events are joined with what it stored
    named.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(keys)
    chosen = spark.read.schema(f"key string, first_received_day date, _first {dict(batch.dtypes)[order]}, bucket int").parquet(keys)
    fresh = batch.join(chosen.select("_first"), F.col(order) == F.col("_first"), "left_semi").unionByName(batch.where(F.col(key).isNull()))
    fresh.write.mode("overwrite").parquet(f"{folder}/{EVENTS}/load_id={load_id}")


def load_stream(deliveries: DataFrame, folder: str, **options) -> DataFrame:
    """Load what a stream has to offer, batch by batch, and open the table of events."""
    spark = deliveries.sparkSession
    open_index(spark, folder)
    running = (deliveries.writeStream.foreachBatch(lambda df, i: load_batch(df, i, folder, **options))
                         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    running.awaitTermination()
    return spark.read.schema(deliveries.schema).parquet(f"{folder}/{EVENTS}")


def compact_keys(spark: SparkSession, folder: str, upto: int, into: str) -> None:
    """Write the keys of all loads up to `upto` to the folder `into`, one load with a file per bucket.

    The loads that follow continue in `into`; the old folder stays until nobody reads it any more.
    """
    keys = spark.read.schema(KEY_SCHEMA).parquet(f"{folder}/{KEYS}").where(F.col("load_id") <= upto)
    keys = keys.select("key", "first_received_day", "bucket").where(F.col("key").isNotNull())
    open_index(spark, into)
    keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{into}/{KEYS}/load_id={upto}")
