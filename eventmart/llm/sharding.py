"""Contiguous partition of ordered atomic groups into shards whose largest is as small as possible."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import running_totals, store


class Ends:
    """What the driver knows of the groups' end positions: a bounded summary, finer where it matters.

    The summary is a list of disjoint blocks in ascending order, each with its smallest and largest
    group end. Where a block holds one end only, the answer of a lookup is exact.
    """

    def __init__(self, table: DataFrame, total: int, blocks: int) -> None:
        self.table, self.total, self.blocks, self.width = table, total, blocks, 2 * total
        self.set(self.summary([(1, total)]))

    def set(self, rows: list[tuple[int, int]]) -> None:
        self.low, self.high = [r[0] for r in rows], [r[1] for r in rows]

    def summary(self, windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Smallest and largest end in each of about `blocks` equal pieces of the windows, finer than any before."""
        width = self.width = max(1, min(self.width // 2, -(-sum(hi - lo + 1 for lo, hi in windows) // self.blocks)))
        inside, which = F.lit(False), F.lit(0)
        for k, (lo, hi) in enumerate(windows):
            inside |= F.col("end").between(lo, hi)
            which += F.when(F.col("end") >= lo, 1).otherwise(0)
        block = F.floor(F.col("end") / F.lit(width)) if len(windows) == 1 else F.struct(which, F.floor(F.col("end") / F.lit(width)))
        rows = self.table.where(inside).groupBy(block.alias("block")).agg(F.min("end").alias("lo"), F.max("end").alias("hi")).collect()
        return sorted((r.lo, r.hi) for r in rows)

    def refine(self, windows: list[tuple[int, int]]) -> None:
        """Look closer at the blocks that meet the windows."""
        merged: list[list[int]] = []
        for lo, hi in sorted(windows):
            i, j = bisect_left(self.high, lo), bisect_right(self.low, hi) - 1
            lo, hi = min(lo, self.low[i]) if i < len(self.low) else lo, max(hi, self.high[j]) if j >= 0 else hi
            if merged and lo <= merged[-1][1] + 1:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        kept = [(a, b) for a, b in zip(self.low, self.high) if not any(lo <= a and b <= hi for lo, hi in merged)]
        self.set(sorted(kept + self.summary([(a, b) for a, b in merged])))

    def reach(self, x: int) -> tuple[int, int]:
        """Bounds of the largest end that is at most x (0 if none)."""
        if x >= self.total:
            return self.total, self.total
        i = bisect_right(self.low, x) - 1
        if i < 0:
            return 0, 0
        return (self.high[i], self.high[i]) if x >= self.high[i] else (self.low[i], x)

    def path(self, capacity: int, shards: int, best: bool) -> list[int] | None:
        """The greedy cuts with certain ends, or (best) with the farthest thinkable ones; None if they don't suffice."""
        at, cuts = 0, []
        for _ in range(shards):
            nearer, farther = self.reach(at + capacity)
            at = max(at, farther if best else nearer)
            cuts.append(at)
        return cuts if at >= self.total else None


def smallest_capacity(ends: Ends, shards: int) -> int:
    """Binary search for the smallest capacity with which greedy filling needs at most `shards` shards."""
    low, high = -(-ends.total // shards) - 1, ends.total  # low: too small for certain; high: suffices
    while True:
        a, b = low, high
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (a, mid) if ends.path(mid, shards, best=False) else (mid, b)
        high = b
        a, b = low, high
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (a, mid) if ends.path(mid, shards, best=True) else (mid, b)
        low = a
        if high - low <= 1:
            return high
        near, far = [0], [0]
        for cuts, capacity, best in ((near, low + 1, False), (far, high, True)):
            for _ in range(shards):
                cuts.append(max(cuts[-1], ends.reach(cuts[-1] + capacity)[best]))
        ends.refine([(max(1, a), b) for a, b in zip(near[1:], far[1:])])


def even_cuts(ends: Ends, shards: int, capacity: int) -> list[int]:
    """Ends at which to cut: no shard above the capacity, and each as near to an equal share of the rest as that allows."""
    known = sorted({0, *ends.low, *ends.high, ends.total})
    must = [ends.total]  # the earliest place from which the shards that are left suffice
    for _ in range(shards - 1):
        must.append(known[bisect_left(known, must[-1] - capacity)])
    at, cuts = 0, []
    for left in range(shards - 1, 0, -1):
        lo, hi = bisect_left(known, max(at, must[left])), bisect_right(known, at + capacity) - 1
        fair = at + (ends.total - at) / (left + 1)
        i = bisect_left(known, fair)
        i = min(max(i, lo), hi)
        if i > lo and abs(known[i - 1] - fair) <= abs(known[i] - fair):
            i -= 1
        at = known[i]
        cuts.append(at)
    return cuts


def minimax_shards(rows: DataFrame, key: str, size: str, shards: int, order: list[str], blocks: int = 16384) -> DataFrame:
    """Add `shard` (0 to shards - 1) and `slot` (from 0, without gaps) to every row.

    Rows of one `key` are an atomic group; groups are laid out in order of the key, rows of a group in
    order of `order`. The smallest feasible capacity of a shard is found by binary search with a greedy
    check, then the sequence is cut: no shard exceeds that capacity, and sizes are as even as it allows.

    The driver holds at most about 2 * `blocks` + 40 pairs of numbers, whatever the data. Running
    totals are distributed, so a group may hold any share of the rows. Sizes below 1 or null count
    as 1; a null key is a group of its own and comes first. Rows equal in all of key and `order` take
    their slots in any order. Given columns `shard` and `slot` are replaced, all others are carried as one
    struct, so any name may occur. An empty table gives an empty result.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    work = rows.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), F.lit(1).cast("long").alias("one"),
                       F.greatest(F.coalesce(F.col(size), F.lit(1)), F.lit(1)).cast("long").alias("size"))
    own_key = F.col(f"row.`{key}`")
    placed = store(running_totals(work, [f"row.`{c}`" for c in (key, *order)], ["size", "one"], name="shard-rows"), "shard-placed")
    groups = store(placed.groupBy(own_key.alias("key")).agg(F.max("size_end").alias("end")), "shard-groups")
    total = groups.agg(F.max("end")).first()[0]
    cuts: list[int] = []
    if total:
        ends = Ends(groups, total, blocks)
        cuts = even_cuts(ends, shards, smallest_capacity(ends, shards))
    # a row's shard: the number of cuts before the end of its group, found by the last keys before the cuts
    found = {r.end: r.key for r in groups.where(F.col("end").isin(cuts)).collect()} if cuts else {}
    shard = F.lit(0)
    for cut in cuts:
        last = found.get(cut)
        before = F.lit(False) if cut == 0 else own_key.isNull() if last is None else F.coalesce(own_key <= F.lit(last), F.lit(True))
        shard += F.when(before, 0).otherwise(1)
    dealt = placed.withColumn("shard", shard.cast("int"))
    first = dealt.groupBy(F.col("shard").alias("of")).agg(F.min("one_end").alias("first"))  # a row per shard
    return dealt.join(F.broadcast(first), F.col("shard") == F.col("of")).select(
        "row.*", "shard", (F.col("one_end") - F.col("first")).alias("slot"))
