"""Landing, materialising and exporting tables, with row counts that prove nothing got lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.session import shuffles_dropped

# Source type -> Spark type. Whatever is not listed lands as text, without loss.
SOURCE_TYPES = {
    "text": "string", "character varying": "string", "character": "string",
    "integer": "int", "smallint": "smallint", "bigint": "bigint", "numeric": "decimal(38,10)",
    "double precision": "double", "real": "float", "boolean": "boolean", "date": "date",
    "timestamp with time zone": "timestamp", "timestamp without time zone": "timestamp_ntz",
    "jsonb": "string", "json": "string", "uuid": "string", "inet": "string",
}
UNKNOWN_DATE = "unknown"


def typed_as_source(df: DataFrame, source_types: Mapping[str, str]) -> DataFrame:
    """Cast every column to what its source type lands as (`source_types`: column -> source type)."""
    return df.select(*[F.col(c).cast(SOURCE_TYPES.get(source_types.get(c, ""), "string")).alias(c)
                       for c in df.columns])


def read_source_table(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
                      partitions: int, **options: str) -> DataFrame:
    """A partitioned read over JDBC: each task fetches one range of the key (needs a driver on the classpath)."""
    return (spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=partitions,
        fetchsize=100_000, sessionInitStatement="SET TIME ZONE 'UTC'", **options).load())


def discover(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name -> path of every Parquet table in a folder of any file system Spark reads, in order of the names.

    A table is a `<name>.parquet` file or a folder; names beginning with a dot or underscore are skipped.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(place)
    names = [(s.getPath().getName(), s) for s in found]
    return {name.removesuffix(".parquet"): s.getPath().toString() for name, s in sorted(names, key=lambda n: n[0])
            if not name.startswith((".", "_")) and (s.isDirectory() or name.endswith(".parquet"))}


def discovered_columns(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, position, column_name, data_type) of all tables of a folder, from their footers alone."""
    rows = [(name, i, f.name, f.dataType.simpleString()) for name, path in discover(spark, folder).items()
            for i, f in enumerate(spark.read.parquet(path).schema.fields, 1)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def register_views(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Make every table of a folder a temporary view, its name after a prefix; the receive date is not part of the data."""
    views = []
    for name, path in discover(spark, folder).items():
        read_landed(spark, path).createOrReplaceTempView(f"{prefix}{name}")
        views.append(f"{prefix}{name}")
    return views


def received_date(ts: str) -> Column:
    """Partition value: the UTC date a row was received, or a fixed word where that is unknown."""
    return F.coalesce(F.col(ts).cast("date").cast("string"), F.lit(UNKNOWN_DATE))


def land_table(df: DataFrame, path: str, partition_ts: str | None = None) -> tuple[int, int]:
    """Write a table as delivered (zstd Parquet, fully replaced); return (rows read, rows on disk).

    Rows read are counted inside the writing job; rows on disk are counted from the files. A
    partitioned table is rebalanced by date first, so a busy date gets several files and quiet
    dates do not get one file per task. An empty table still lands its schema.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = counted
    if partition_ts:
        out = counted.withColumn("received_date", received_date(partition_ts)).hint("rebalance", "received_date")
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy("received_date") if partition_ts else writer).parquet(path)
    landed = df.sparkSession.read.schema(df.schema).parquet(path).count()
    return int(seen.get["rows"]), landed


def read_landed(spark: SparkSession, path: str, keep_date: bool = False, since: str | None = None) -> DataFrame:
    """A landed table; `received_date` is a partition for pruning and not part of the data.

    `since` (a date as text) reads only the partitions from that day on, and the rows without a
    receive date, for an incremental run.
    """
    df = spark.read.parquet(path)
    if "received_date" not in df.columns:
        return df
    if since is not None:
        date = F.col("received_date").cast("string")
        df = df.where((date >= since) | (date == UNKNOWN_DATE))
    return df if keep_date else df.drop("received_date")


MANIFEST = "table_name string, source_rows bigint, landed_rows bigint, reconciled boolean"


def land_all(tables: Mapping[str, DataFrame], folder: str, partitioned: Mapping[str, str] | None = None) -> DataFrame:
    """Land several tables and return the manifest: one row per table, with the comparison."""
    partitioned = partitioned or {}
    rows = []
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        source, landed = land_table(df, f"{folder}/{name}", partitioned.get(name))
        rows.append((name, source, landed, source == landed))
    return spark.createDataFrame(rows, MANIFEST)


def require_reconciled(manifest: DataFrame) -> None:
    """Fail if any table lost or gained rows on the way (the manifest has one row per table)."""
    bad = [r.table_name for r in manifest.where(~F.col("reconciled")).select("table_name").collect()]
    if bad:
        raise RuntimeError(f"tables that do not reconcile: {sorted(bad)}")


def materialize(df: DataFrame, path: str, partition_by: str | None = None) -> tuple[DataFrame, int]:
    """Write a model as Parquet (replaced), return the stored table and its row count."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        out = out.hint("rebalance", partition_by)
    writer = out.write.mode("overwrite").option("compression", "zstd")
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path), int(seen.get["rows"])


def lower_types(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Types a desktop BI tool can load: lists as text, UTC wall clock, decimals as doubles."""

    def lowered(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), separator)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("bigint" if f.dataType.scale == 0 and f.dataType.precision > 18 else "double")
        return c.alias(f.name)

    return df.select(*[lowered(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str) -> int:
    """One CSV file with a header, for report results (small by nature); returns the rows written."""
    seen = Observation()
    flat = lower_types(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    flat.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return int(seen.get["rows"])
