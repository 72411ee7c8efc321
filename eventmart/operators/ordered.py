"""Ordered per-key operators that survive a hot key.

A plain window puts all rows of one key in one task. Here a key with more rows than a limit is cut
into slices along its order (`slice_by` must never decrease along `order`). Windows then run per
(key, slice), and only one summary row per slice is carried over to the following slices. All
other keys keep a single slice. Results equal the plain window.

Which keys are hot is measured once per stored table with `measure_hot_keys` and handed to every
operator that orders rows of that table (or part of them) by that key; where nothing is hot, the
operators are plain windows. Given a number instead, an operator counts for itself, which reads its
input once more. The list of hot keys is broadcast: it holds at most total_rows / limit keys.

Rows with a NULL key have no neighbours to speak of; callers filter them first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.functions.columns import col

HOT_ROWS = 2_000_000
HOT, SLICE = "_hot", "_slice"


@dataclass(frozen=True)
class HotKeys:
    """The keys of a table that hold more rows than one task should take."""

    table: DataFrame
    columns: tuple[str, ...]
    count: int

    def covers(self, keys: Sequence[str]) -> bool:
        """Whether windows over `keys` can rely on this list: a part of a cold key is cold as well."""
        return set(self.columns) <= set(keys)


Hot = int | HotKeys


def _heavy(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*keys)


def measure_hot_keys(df: DataFrame, keys: Sequence[str], path: str, limit: int = HOT_ROWS, buckets: int = 65_536) -> HotKeys:
    """Store the hot keys of a table.

    Rows are counted by a hash of their key first, a few numbers a task; a hot key lies in a bucket over the limit, so
    only the keys of such buckets (at most rows / limit of them) are counted themselves.
    """
    seen, bucket = Observation(), F.pmod(F.xxhash64(*keys), F.lit(buckets))
    full = df.groupBy(bucket.alias("_b")).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select("_b").collect()
    _heavy(df.where(bucket.isin([r[0] for r in full]) if full else F.lit(False)), keys, limit).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return HotKeys(df.sparkSession.read.parquet(path), tuple(keys), int(seen.get["n"]))


def all_cold(hot: Hot, keys: Sequence[str]) -> bool:
    return isinstance(hot, HotKeys) and hot.covers(keys) and hot.count == 0


def hot_keys_of(df: DataFrame, keys: Sequence[str], hot: Hot) -> HotKeys:
    """The measured list, if it serves these keys; else one that is counted when it is used."""
    if isinstance(hot, HotKeys) and hot.covers(keys):
        return hot
    return HotKeys(_heavy(df, keys, hot if isinstance(hot, int) else HOT_ROWS), tuple(keys), 1)


def split_hot(df: DataFrame, keys: Sequence[str], slice_by: Column, hot: Hot = HOT_ROWS) -> DataFrame:
    """Add `_hot` (true for rows of a hot key, else NULL) and `_slice` (0 for other keys)."""
    listed = hot_keys_of(df, keys, hot)
    marks = listed.table.select(*[F.col(k).alias(f"_k_{k}") for k in listed.columns], F.lit(True).alias(HOT))
    match = None
    for k in listed.columns:
        one = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        match = one if match is None else match & one
    joined = df.join(F.broadcast(marks), match, "left").drop(*[f"_k_{k}" for k in listed.columns])
    return joined.withColumn(SLICE, F.when(F.col(HOT), slice_by).otherwise(F.lit(0).cast("bigint")))


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [col(o) for o in order]


def _neighbour(df, keys, order, values, into, slice_by, hot, ahead: bool) -> DataFrame:
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    step = F.lead if ahead else F.lag
    if slice_by is None or all_cold(hot, keys):
        return df.withColumn(into, step(row).over(W.partitionBy(*keys).orderBy(*_order(order))))
    cut = split_hot(df, keys, slice_by, hot)
    edge_of = F.min_by if ahead else F.max_by
    edges = (cut.where(HOT).groupBy(*keys, SLICE)
                .agg(edge_of(row, F.struct(*_order(order))).alias("_edge"))
                .withColumn("_carry", step("_edge").over(W.partitionBy(*keys).orderBy(SLICE)))
                .drop("_edge"))
    inside = W.partitionBy(*keys, SLICE).orderBy(*_order(order))
    return (cut.withColumn(into, step(row).over(inside))
               .join(edges, [*keys, SLICE], "left")
               .withColumn(into, F.coalesce(F.col(into), F.col("_carry")))
               .drop(HOT, SLICE, "_carry"))


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  values: Mapping[str, Column], into: str = "prev",
                  slice_by: Column | None = None, hot: Hot = HOT_ROWS) -> DataFrame:
    """Add a struct of `values` taken from the previous row of the same key (NULL on the first)."""
    return _neighbour(df, keys, order, values, into, slice_by, hot, ahead=False)


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              values: Mapping[str, Column], into: str = "next",
              slice_by: Column | None = None, hot: Hot = HOT_ROWS) -> DataFrame:
    """Add a struct of `values` taken from the next row of the same key (NULL on the last)."""
    return _neighbour(df, keys, order, values, into, slice_by, hot, ahead=True)


def with_following(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], values: Mapping[str, Column], n: int,
                   into: str = "ahead", slice_by: Column | None = None, hot: Hot = HOT_ROWS) -> DataFrame:
    """Add an array of structs of `values`: the next `n` rows of the same key, fewer at its end.

    A slice of a hot key hands its first `n` rows over to the slices before it. Every slice has a row, so the next
    `n` slices hold all that a slice can lack: one pass over the rows and one over these heads, whatever `n`.
    """
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    if n < 1:
        return df.withColumn(into, F.filter(F.array(row), lambda _: F.lit(False)))
    if slice_by is None or all_cold(hot, keys):
        return df.withColumn(into, F.collect_list(row).over(W.partitionBy(*keys).orderBy(*_order(order)).rowsBetween(1, n)))
    cut = split_hot(df, keys, slice_by, hot)
    inside = W.partitionBy(*keys, SLICE).orderBy(*_order(order))
    first = (cut.where(HOT).select(*keys, SLICE, row.alias("_row"), F.row_number().over(inside).alias("_at")).where(F.col("_at") <= n)
                .groupBy(*keys, SLICE).agg(F.sort_array(F.collect_list(F.struct("_at", "_row"))).alias("_head")))
    later = F.flatten(F.collect_list("_head").over(W.partitionBy(*keys).orderBy(SLICE).rowsBetween(1, n)))
    heads = first.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(SLICE).alias("_of"), F.transform(F.slice(later, 1, n), lambda x: x["_row"]).alias("_carry"))
    same = F.col(SLICE) == F.col("_of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    own = F.collect_list(row).over(inside.rowsBetween(1, n))
    return (cut.withColumn("_own", own).join(heads, same & F.col(HOT), "left")
               .withColumn(into, F.when(F.col("_carry").isNull(), F.col("_own")).otherwise(F.slice(F.concat("_own", "_carry"), 1, n)))
               .drop(HOT, SLICE, "_own", "_carry", "_of", *[f"_k_{k}" for k in keys]))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], amount: Column,
                into: str, slice_by: Column, hot: Hot = HOT_ROWS) -> DataFrame:
    """Running total of `amount` per key, up to and including the row.

    `order` must be total within a key: equal rows would be added one by one.
    """
    if all_cold(hot, keys):
        whole = W.partitionBy(*keys).orderBy(*_order(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.withColumn(into, F.sum(amount).over(whole))
    cut = split_hot(df.withColumn("_amount", amount), keys, slice_by, hot)
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = (cut.where(HOT).groupBy(*keys, SLICE).agg(F.sum("_amount").alias("_amount"))
                  .select(*keys, SLICE, F.sum("_amount").over(before).alias("_offset")))
    inside = (W.partitionBy(*keys, SLICE).orderBy(*_order(order))
               .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (cut.withColumn(into, F.sum("_amount").over(inside))
               .join(offsets, [*keys, SLICE], "left")
               .withColumn(into, F.col(into) + F.coalesce(F.col("_offset"), F.lit(0)))
               .drop(HOT, SLICE, "_amount", "_offset"))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], into: str,
                slice_by: Column, hot: Hot = HOT_ROWS) -> DataFrame:
    """1, 2, 3, ... per key along a total order."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), into, slice_by, hot)


def number_globally(df: DataFrame, order: Sequence[str], coarse: Column | Sequence[Column], fine: Sequence[str],
                    into: str, counted: Column | None = None, groups: DataFrame | None = None) -> DataFrame:
    """1, 2, 3, ... over the whole frame along a total order, without sorting it in one task.

    `fine` is a prefix of `order`; `coarse` are expressions of its columns that never decrease along it, from the
    finest to the coarsest (second, hour, month of a leading timestamp), each a function of the one
    before. Rows are numbered within each fine group; groups are counted, and their counts summed up
    within each finest slice, the slices within each next coarser one, and so on. Only the last step
    is one task, over one row per coarsest slice. Nothing is sampled, so a recomputed task gives the
    same numbers. `counted` is 1 or 0: a row of 0 has the number of the row before it.

    Rows are moved once, by their fine group, and meet its number where they then lie. `groups` (see `fine_groups`) may
    bring further columns for the rows of a group; a group that is listed several times has each of its rows as often,
    numbered one after another, and one that is not listed has none.
    """
    if groups is None:
        groups = fine_groups(df, fine, counted)
    levels = [coarse] if isinstance(coarse, Column) else list(coarse)
    names = [f"{SLICE}{i}" for i in range(len(levels))]
    more = [c for c in groups.columns if c not in (*fine, "_n")]
    # keys are structs: they are never NULL, so a plain equality joins them where a window has already laid the rows
    cut = groups.select("*", *[F.struct(c).alias(n) for c, n in zip(levels, names)])
    totals = cut
    sums = []
    for i in range(len(names)):
        totals = totals.groupBy(*names[i:]).agg(F.sum("_n").alias("_n"))
        sums.append(totals)
    starts = None
    for i in reversed(range(len(names))):
        before = W.partitionBy(*names[i + 1:i + 2]).orderBy(names[i]).rowsBetween(W.unboundedPreceding, -1)
        level = sums[i].withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        if starts is None:
            starts = level.select(F.col(names[i]).alias("_of"), F.col("_in").alias("_start"))
        else:
            starts = (level.join(starts, F.col(names[i + 1]) == F.col("_of"))
                           .select(F.col(names[i]).alias("_of"), (F.col("_in") + F.col("_start")).alias("_start")))
    alike = W.partitionBy(names[0], *fine)
    copy = F.row_number().over(alike.orderBy(*(more or fine)))
    upto = F.sum("_n").over(W.partitionBy(names[0]).orderBy(*fine).rangeBetween(W.unboundedPreceding, W.currentRow))
    offsets = (cut.withColumns({"_copy": copy, "_copies": F.count("*").over(alike)}).withColumn("_upto", upto)
                  .join(starts, F.col(names[0]) == F.col("_of"))
                  .select(F.struct(*fine).alias("_group"), "_copy", "_copies", *more,
                          (F.col("_upto") - F.col("_n") * F.col("_copies") + F.col("_start")).alias("_offset")))
    one = F.lit(1) if counted is None else counted
    inside = W.partitionBy("_fine").orderBy(*[c for c in order if c not in fine] or ["_fine"]).rowsBetween(W.unboundedPreceding, 0)
    rows = df.select(*[c for c in df.columns if c not in fine], F.struct(*fine).alias("_fine"), one.cast("bigint").alias("_one"))
    rows = rows.withColumn("_row", F.sum("_one").over(inside)).join(offsets, F.col("_fine") == F.col("_group"))
    last = F.col("_offset") + F.col("_row") * F.col("_copies")
    number = F.when(F.col("_one") > 0, last - F.col("_copies") + F.col("_copy")).otherwise(last)
    return rows.select(*[F.col(f"_fine.{c}") if c in fine else c for c in df.columns], *more, number.cast("bigint").alias(into))


def fine_groups(df: DataFrame, fine: Sequence[str], counted: Column | None = None) -> DataFrame:
    """One row per fine group of `number_globally` with `_n`, the rows it counts."""
    return df.groupBy(*fine).agg(F.sum((F.lit(1) if counted is None else counted).cast("bigint")).alias("_n"))
