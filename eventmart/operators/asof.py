"""As-of joins: each left row meets the latest right row of its key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from eventmart.functions.columns import time_slice
from eventmart.operators.ordered import HOT, HOT_ROWS, SLICE, Hot, all_cold, hot_keys_of, split_hot

UNKEYED_GROUPS = 4096


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
              values: Sequence[str], how: str = "inner", tie: str | None = None,
              slice_seconds: int = 86_400, hot: Hot = HOT_ROWS) -> DataFrame:
    """Attach `values` of the latest right row with `right_on <= left_on` per key.

    Both sides are stacked and the last right row seen is carried forward, so the cost is
    one sort per key however long its history is (an interval join would pair every event
    of a key with its whole history). A hot key is cut into time slices; the last right row
    of each slice is handed to the slices after it. `tie` (a right column, larger wins)
    decides between right rows of one instant. Left columns must not clash with `values`.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    tie_col = F.col(tie).cast("bigint") if tie else F.lit(None).cast("bigint")
    keyed = F.col(left_on).isNotNull()
    for k in by:
        keyed = keyed & F.col(k).isNotNull()
        right = right.where(F.col(k).isNotNull())
    # rows that cannot match pass along, spread over many groups of their own
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(UNKEYED_GROUPS)).cast("int") + 1
    facts = left.select("*", F.col(left_on).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("bigint").alias("_tie"),
                        F.when(keyed, F.lit(0)).otherwise(spread).alias("_group"))
    known = right.where(F.col(right_on).isNotNull()).select(
        *by, F.col(right_on).alias("_at"), F.lit(0).alias("_side"), tie_col.alias("_tie"), F.lit(0).alias("_group"),
        F.struct(*values).alias("_match"))
    stacked = (facts if how == "left" else facts.where(F.col("_group") == 0)).unionByName(known, allowMissingColumns=True)
    latest = F.last("_match", ignorenulls=True)

    def upto(*keys: str) -> WindowSpec:
        return (W.partitionBy(*keys).orderBy("_at", "_side", "_tie")
                 .rowsBetween(W.unboundedPreceding, W.currentRow))

    if all_cold(hot, by):
        found = stacked.withColumn("_found", latest.over(upto(*by, "_group"))).where(F.col("_side") == 1)
    else:
        listed, piece = hot_keys_of(stacked, by, hot), time_slice("_at", slice_seconds)
        cut = split_hot(stacked, by, piece, listed)
        cut = cut.withColumn(SLICE, F.when(F.col("_group") > 0, F.col("_group").cast("bigint")).otherwise(F.col(SLICE)))
        earlier = W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
        # what is handed on comes from the right rows; of the left ones only the slices they lie in are wanted
        last = (split_hot(known, by, piece, listed).where(HOT).groupBy(*by, SLICE)
                .agg(F.max_by("_match", F.struct("_at", "_tie")).alias("_last")))
        there = (split_hot(left.where(keyed).select(*by, F.col(left_on).alias("_at")), by, piece, listed)
                 .where(HOT).select(*by, SLICE).distinct())
        carry = there.join(last, [*by, SLICE], "full").select(
            *by, SLICE, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
        found = (cut.withColumn("_found", latest.over(upto(*by, SLICE))).where(F.col("_side") == 1)
                    .join(carry, [*by, SLICE], "left").withColumn("_found", F.when(F.col("_group") == 0, F.coalesce("_found", "_carry"))))
    if how == "inner":
        found = found.where(F.col("_found").isNotNull())
    return found.select(*left.columns, *[F.col(f"_found.{v}").alias(v) for v in values])


def asof_interval_join(left: DataFrame, history: DataFrame, by: Sequence[str], on: str,
                       values: Sequence[str], how: str = "inner",
                       valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """As-of join against a history that already carries half-open [valid_from, valid_to) intervals.

    An equi join on the key with a residual: right for histories of a few rows per key, where
    either side may be broadcast by its measured size. Use `asof_join` for long histories.
    """
    h = history.select(*[F.col(k).alias(f"_h_{k}") for k in by],
                       F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *values)
    match = (F.col(on) >= F.col("_from")) & (F.col(on) < F.col("_to"))
    for k in by:
        match = match & (F.col(k) == F.col(f"_h_{k}"))
    return left.join(h, match, how).drop("_from", "_to", *[f"_h_{k}" for k in by])


def bracket_join(df: DataFrame, brackets: DataFrame, value: str, low: str, high: str,
                 how: str = "inner") -> DataFrame:
    """Join on `value BETWEEN low AND high`, without a nested loop over the facts.

    Each bracket is expanded to the whole numbers it covers, which turns the range into an equi
    join on the number. Meant for whole values and brackets of bounded width (levels): a value with
    a fraction meets no bracket, and neither does a bracket that ends before it begins.
    """
    start, end = F.ceil(low).cast("bigint"), F.floor(high).cast("bigint")
    table = brackets.where(start <= end).withColumn("_bracket_value", F.explode(F.sequence(start, end)))
    whole = df.withColumn("_value", F.when(F.col(value) == F.floor(value), F.col(value).cast("bigint")))
    return whole.join(table, F.col("_value") == F.col("_bracket_value"), how).drop("_value", "_bracket_value")
