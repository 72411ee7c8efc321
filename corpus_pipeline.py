"""From documents to training shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns the documents that stay,
with the columns it got; the last one returns where each of them goes. Columns beyond those of `documents`
pass through, whatever their names. Rows without text fail the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.common import small_batches, store, words_of
from eventmart.llm.decontamination import contaminated
from eventmart.llm.divergence import divergence_rules
from eventmart.llm.mixing import mix_sources
from eventmart.llm.neardup import near_duplicates
from eventmart.llm.sharding import minimax_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules keep."""
    small_batches(spark)
    names = docs.columns
    own = docs.select("text", "lang", *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(names) if c not in ("text", "lang")])
    kept = divergence_rules(own).where("kept")
    return kept.select(*[F.col("text") if c == "text" else F.col("lang") if c == "lang" else F.col(f"_c{k}").alias(c) for k, c in enumerate(names)])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (runs of five words, similarity 0.8 or more).

    Rows with the same doc_id are one document and stay or go together; rows without doc_id stay.
    """
    small_batches(spark)
    gone = near_duplicates(docs, size=5, percent=80).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(store(gone, "gone"), F.col("doc_id") == F.col("_gone"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark; rows without doc_id stay."""
    small_batches(spark)
    leaks = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(store(leaks, "leaks"), F.col("doc_id") == F.col("_leak"), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: some not at all, some twice."""
    digest = F.xxhash64("text")
    rows = docs.select("doc_id", "source", digest.alias("_digest"), words_of(F.col("text")).alias("_words"))
    taken = mix_sources(rows, "source", F.col("_words"), ["doc_id", "_digest"])
    # rows equal in all that counts share what they are taken for
    taken = taken.groupBy(F.col("doc_id").alias("_id"), "source", "_digest").agg(F.sum("times").alias("_times"), F.count("*").alias("_n"))
    taken = store(taken.where("_times > 0").withColumnRenamed("source", "_source"), "taken")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (digest == F.col("_digest")) & F.col("source").eqNullSafe(F.col("_source"))
    turn = F.row_number().over(Window.partitionBy("doc_id", "_digest", "source").orderBy(F.lit(0)))
    times = F.floor(F.col("_times") / F.col("_n")) + F.when(turn <= F.col("_times") % F.col("_n"), 1).otherwise(0)
    rows = docs.join(taken, same).withColumn("_copies", times.cast("int")).where("_copies > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, size, shard, slot): where each row goes; equal texts stay together."""
    rows = docs.select("doc_id", "source", "lang", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                       F.sha2(F.col("text"), 256).alias("_group"))
    return minimax_shards(rows, "_group", "size", 40, ["doc_id"]).drop("_group")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("near duplicates", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

# MinHash candidates and hash-random mixing are beyond SQL: tests/llm checks the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
