"""What the operators of this subpackage share: stored tables, running totals, components."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.session import shared_folder


ROWS_A_FILE = 100_000  # of narrow tables whose size is known
BATCH_BYTES = 4 << 20


def store(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later work starts from files.

    A lost executor then repeats one stage at most, and shuffle files of the job can go. Where it is known about how many `rows` there
    are, a small table is dealt to a few files before it is written, however many partitions it was made in. Each file costs its writer
    child processes for permissions on a file system without native calls, and while such a child starts, it has all of the
    executor's memory in its own account as well.
    """
    spark = df.sparkSession
    files = shuffle_parts(spark) if rows is None else max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE))
    if files < shuffle_parts(spark):
        df = df.repartition(files)
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    free(spark)
    return out


def free(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that are over: it does so once their plans are garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """From now on, rows go to Python workers in batches of about 4 MB at most (a lower limit of the session's stays).

    By their number alone (10,000), rows with texts make batches of 20 MB and more, which an executor holds several times: as it
    writes them, as the worker reads them and as it gets them back.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    value, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
    if int(value) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table that needs no Python worker, as one made from a list of rows would."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where(F.lit(False))


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def running_totals(df: DataFrame, order: list[str], sums: list[str], by: str | None = None, name: str = "run") -> DataFrame:
    """Add `<s>_end` for each column of `sums`: its running total over `order` (within `by`).

    Rows are range-partitioned by (by, order), so one value of `by` may span many tasks; only one
    row per partition (and value of `by`) meets in the window that carries totals across partitions.
    """
    keys = [by] if by else []
    placed = store(
        df.repartitionByRange(shuffle_parts(df.sparkSession), *keys, *order).withColumn("_part", F.spark_partition_id()), name)
    totals = placed.groupBy(*keys, "_part").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col("_part").alias("_bpart"), *[F.col(k).alias(f"_b_{k}") for k in keys],
                         *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_b_{s}_base") for s in sums])
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_part") == F.col("_bpart")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    rows = placed.select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    return rows.join(base, same).select(
        *df.columns, *[(F.col(f"_in_{s}") + F.col(f"_b_{s}_base")).alias(f"{s}_end") for s in sums])


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b) of longs: component is its smallest node.

    Alternating large-star and small-star steps; each writes its edges to the shared folder. A node
    with very many neighbours is aggregated map-side and joined back, never gathered. `rows` is how many edges there are, if known.
    """
    edges = store(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", rows)
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("m").alias("a"), F.col("b")).where("a <> b")
        large = large.distinct()
        # small star: every edge is (a < b); b's smallest neighbour takes over b's smaller neighbours
        least = large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("u"), "m")
        small = large.join(least, F.col("b") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                              F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = store(small.where("a <> b").distinct(), "edges", rows if mark is None else mark[0])
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("node"), "component").union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def texts(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with its texts as UTF-8 bytes (null: empty)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        yield batch, [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def words_of(c: Column) -> Column:
    """The number of runs of characters other than space and U+0009 to U+000D (null: 0)."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))
