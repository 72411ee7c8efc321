"""Mixing sources to target weights: whole documents, chosen by hash, up to each source's budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import running_totals, store


def source_targets(rows: DataFrame, source: str, size: str, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """A row per source: `source_size` and its `target`.

    Sources in order of their name (null last) weigh `weights`, repeating. They share `share` times the
    sum of all sizes by weight, but none gets more than `max_epochs` times its own size: what is left
    over goes to the others by weight. So a target is min(max_epochs * size, level * weight), with the
    one level at which all targets add up; it is found by running sums over the sources.
    """
    per = rows.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col("_source").isNull(), "_source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").isNull(), "_source")
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    open_weight = F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    # the level if all sources before this one are capped, and this one and those after it are not
    per = per.withColumn("_level", (F.lit(float(share)) * F.sum("source_size").over(everything) - capped) / open_weight)
    fits = F.col("_level") * F.col("_w") <= F.col("_cap")
    per = per.withColumn("_final", F.min(F.when(fits, F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(everything))
    level = F.col("_final").getField("_level")
    return per.select("_source", "source_size", F.coalesce(F.least(level * F.col("_w"), F.col("_cap")), F.col("_cap")).alias("target"))


def mix_sources(
    docs: DataFrame, source: str, size: Column, order: list[str], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
    max_epochs: float = 2, seed: int = 17,
) -> DataFrame:
    """Add `size`, `source_size`, `target`, `times` and `taken` to every row: how often the mix takes it.

    Each row gets a key hashed from `seed` and `order`; rows are range-sorted by it within each source
    and running totals of the sizes are distributed. A source's target is met by as many whole epochs as it
    holds, and of one more epoch the first rows up to the budget: a row is in if more than half of it is
    within, so the words taken differ from the target by at most half a document. `taken` is
    times * size.

    Documents are never split. The same data give the same mix on every run. A null source is a source (the
    last one); rows of size 0 are taken as often as the rows around them; rows equal in `order` are
    interchangeable. Columns of the same names are replaced, all others are carried as one struct, so any name may
    occur. An empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "times", "taken")]
    work = store(docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), F.col(source).alias("of"), size.alias("size"),
                             F.xxhash64(F.lit(seed), *order).alias("key")), "mix-rows")
    targets = source_targets(work, "of", "size", weights, share, max_epochs)
    placed = running_totals(work, ["key", *[f"row.`{c}`" for c in order]], ["size"], by="of", name="mix-run")
    rows = placed.join(targets, F.col("of").eqNullSafe(F.col("_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    more = F.when(F.col("size_end") - F.col("size") / F.lit(2) < rest, 1).otherwise(0)
    rows = rows.withColumn("times", (epochs + more).cast("long"))
    return rows.select("row.*", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))
