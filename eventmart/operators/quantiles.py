"""Exact quantiles per group, for groups of any size."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.session import shared_folder

SMALL = 200_000


def exact_quantile(df: DataFrame, by: Sequence[str], value: Column, into: str, q: float = 0.5, small: int = SMALL, bins: int = 1024) -> DataFrame:
    """(by, into): the value at place ceil(q * n) of each group's n known values in order.

    `df` is read once: the distinct values of each group with their numbers are stored in the shared folder, and every pass reads
    those. A group of up to `small` distinct values is ranked by a window. In a larger one the stretch that holds the place is
    narrowed: each pass counts its values in `bins` equal steps, as partial sums, and goes on with the step the place falls into,
    until that has few or one. The smallest and the largest value of a stretch lie in different steps, so every pass narrows it.
    Groups are one row each, written to the shared folder between passes. NULL and NaN are no values, infinite ones count as the
    largest finite ones; a group without values gives no row.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/quantile-{uuid.uuid4().hex}"
    finite = F.least(F.greatest(value.cast("double"), F.lit(-sys.float_info.max)), F.lit(sys.float_info.max))

    def stored(state: DataFrame, turn: int | str) -> DataFrame:
        state.write.parquet(f"{folder}/{turn}")
        return spark.read.schema(state.schema).parquet(f"{folder}/{turn}")

    given = df.where(value.isNotNull() & ~F.isnan(value)).select(*by, finite.alias("_v"))
    rows = stored(given.groupBy(*by, "_v").agg(F.count("*").alias("_c")), "values")

    def in_stretch(of: DataFrame) -> DataFrame:
        """The values of these groups that lie in their stretches."""
        named = of.select(*[F.col(k).alias(f"_k_{k}") for k in by], "_low", "_high", "_place")
        match = (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
        for k in by:
            match &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return rows.join(named, match).drop(*[f"_k_{k}" for k in by])

    def reached(counted: DataFrame, order: str) -> DataFrame:
        """The row the place falls into, `_before` it the rows that come earlier."""
        upto = F.sum("_c").over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
        return counted.withColumn("_before", upto - F.col("_c")).where(
            (F.col("_before") < F.col("_place")) & (F.col("_before") + F.col("_c") >= F.col("_place")))

    size = [F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]
    place = F.greatest(F.ceil(F.lit(q) * F.sum("_c")), F.lit(1)).cast("bigint")
    state = stored(rows.groupBy(*by).agg(*size, place.alias("_place")), 0)
    wide, turn = (F.col("_n") > small) & (F.col("_low") < F.col("_high")), 0
    while not state.where(wide).isEmpty():
        turn += 1
        # halves first: the distance between two far ends may not be a double
        step = F.least(F.floor((F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2) * bins), F.lit(bins - 1))
        counted = in_stretch(state.where(wide)).groupBy(*by, "_place", step.alias("_step")).agg(F.sum("_c").alias("_c"), *size)
        hit = reached(counted, "_step").select(*by, "_n", "_low", "_high", (F.col("_place") - F.col("_before")).alias("_place"))
        state = stored(state.where(~wide).unionByName(hit), turn)
    single = F.col("_low") == F.col("_high")
    return state.where(single).select(*by, F.col("_low").alias(into)).unionByName(
        reached(in_stretch(state.where(~single)), "_v").select(*by, F.col("_v").alias(into)))


def with_quantile(summary: DataFrame, df: DataFrame, by: Sequence[str], value: Column, into: str, q: float = 0.5) -> DataFrame:
    """`summary` (one row per group of `df`) with the group's exact quantile, NULL where it has no values."""
    found = exact_quantile(df, by, value, into, q).select(*[F.col(k).alias(f"_q_{k}") for k in by], into)
    match = F.lit(True)
    for k in by:
        match &= F.col(k).eqNullSafe(F.col(f"_q_{k}"))
    return summary.join(found, match, "left").drop(*[f"_q_{k}" for k in by])
