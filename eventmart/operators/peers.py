"""Standing among peers, without a window over a whole peer group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.functions.columns import number_slice, ratio
from eventmart.operators.ordered import HOT_ROWS, Hot, running_sum


def peer_standing(df: DataFrame, peer_keys: Sequence[str], score: str, is_peer: Column,
                  slice_width: float, hot: Hot = HOT_ROWS) -> DataFrame:
    """Add `peer_count` (peers other than the row itself) and `peers_below` (strictly lower score).

    `is_peer` says which rows others are compared with; a row that is no peer is still ranked.
    Peer groups are few and huge, so the group is first reduced to one row per distinct score
    (map-side combine), the running count goes over those, and a group with very many distinct
    scores is cut along the score. One row per input row comes back.
    """
    peer = F.coalesce(is_peer, F.lit(False)).cast("bigint")
    marked = df.withColumn("_peer", peer)
    by_score = marked.groupBy(*peer_keys, score).agg(F.sum("_peer").alias("_here"))
    running = running_sum(by_score, list(peer_keys), [score], F.col("_here"), "_upto",
                          number_slice(score, slice_width), hot)
    below = running.select(*[F.col(k).alias(f"_g_{k}") for k in peer_keys], F.col(score).alias("_g_score"),
                           (F.col("_upto") - F.col("_here")).alias("peers_below"))
    totals = by_score.groupBy(*peer_keys).agg(F.sum("_here").alias("_total")).select(
        *[F.col(k).alias(f"_t_{k}") for k in peer_keys], "_total")
    with_below = F.col(score).eqNullSafe(F.col("_g_score"))
    in_group = None
    for k in peer_keys:
        with_below = with_below & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        one = F.col(f"_g_{k}").eqNullSafe(F.col(f"_t_{k}"))
        in_group = one if in_group is None else in_group & one
    standing = below.join(totals, in_group)
    return (marked.join(standing, with_below)
                  .withColumn("peer_count", F.col("_total") - F.col("_peer"))
                  .drop("_peer", "_total", "_g_score",
                        *[f"_g_{k}" for k in peer_keys], *[f"_t_{k}" for k in peer_keys]))


def percentile(below: str = "peers_below", count: str = "peer_count") -> Column:
    """Whole-number percentage of peers below; NULL without peers."""
    return F.round(ratio(F.lit(100.0) * F.col(below), F.col(count)))


def share_of_total(categories: DataFrame, count: str, into: str, digits: int = 1) -> DataFrame:
    """Add each row's share of the column total in percent. For a frame already reduced to a
    fixed list of categories: the total is taken in one task."""
    total = F.sum(count).over(W.partitionBy())
    return categories.withColumn(into, F.round(ratio(F.lit(100.0) * F.col(count), total), digits))
