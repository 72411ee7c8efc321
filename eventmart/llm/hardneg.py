"""Hard-negative mining: exact integer scores of a stated set of anchors against all rows, several to a product."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.llm.common import shuffle_parts, store

LOW, HIGH = -(2**63), 2**63 - 1
EXACT = 53  # bits that a double holds exactly
SLICE = 512  # candidates scored at once


def components(column: pa.ChunkedArray, scale: int) -> tuple[np.ndarray, int]:
    """A matrix of floor(scale * x), shorter vectors filled with 0, and its largest absolute value; wide numbers are Python's."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    grid = np.zeros((len(sizes), int(sizes.max(initial=0))))
    grid[np.arange(grid.shape[1]) < sizes[:, None]] = flat
    if np.abs(grid).max(initial=0) < 2.0**52 / scale:
        whole = np.floor(scale * grid).astype(np.int64)
        return whole, int(np.abs(whole).max(initial=0))
    wide = np.frompyfunc(lambda x: int(np.floor(scale * x)) if abs(x) < 2.0**52 else int(x) * scale, 1, 1)(grid)
    return wide, max(abs(x) for x in wide.flat)


class Packed:
    """Candidates whose components, made positive by a bias, lie in separate fields of one wide number per dimension.

    One product with an anchor's component scores as many candidates as there are fields. Fields are wide enough for the whole
    sum, so none spills into the next. Where two fields fit the 53 bits in which doubles are exact whole numbers, matrices of
    those are multiplied; otherwise Python's numbers of any width are, 32 fields to each.
    """

    def __init__(self, rows: np.ndarray, largest: int, anchor_largest: int) -> None:
        n, dims = rows.shape
        self.n, self.bias, self.anchor_bias = n, largest, anchor_largest
        self.bits = max(1, dims * (2 * largest) * (2 * anchor_largest)).bit_length()
        self.small = 2 * self.bits <= EXACT and max(largest, anchor_largest) < 1 << 30
        self.fields, self.kind = (2, np.int64) if self.small else (32, object)
        rows = rows.astype(self.kind)
        self.sums = rows.sum(axis=1)
        padded = np.zeros((-(-n // self.fields), self.fields, dims), dtype=self.kind)
        padded.reshape(len(padded) * self.fields, dims)[:n] = rows + largest
        self.wide = sum(padded[:, f] << (f * self.bits) for f in range(self.fields)).T

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Whole inner products, anchors down, candidates across, held within the range of a long."""
        anchors = anchors.astype(self.kind)
        biased = anchors + self.anchor_bias
        dims, mask = anchors.shape[1], (1 << self.bits) - 1
        fixed = self.bias * anchors.sum(axis=1)[:, None] + self.anchor_bias * self.sums[None, :] + dims * self.bias * self.anchor_bias
        if self.small:
            product = (biased.astype(np.float64) @ self.wide.astype(np.float64)).astype(np.int64)
        else:
            product = biased @ self.wide
        fields = np.stack([(product >> (f * self.bits)) & mask for f in range(self.fields)], axis=2)
        found = fields.reshape(len(anchors), self.fields * self.wide.shape[1])[:, : self.n] - fixed
        return found if self.small else np.clip(found, LOW, HIGH).astype(np.int64)


def first_of(who: np.ndarray, scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` rows of each `who`: higher scores first, then smaller ids."""
    order = np.lexsort((ids, ~scores, who))  # ~x falls as x grows, over all of the range
    start = np.flatnonzero(np.r_[True, who[order][1:] != who[order][:-1]]) if order.size else np.empty(0, dtype=np.int64)
    rank = np.arange(order.size) - np.repeat(start, np.diff(np.r_[start, order.size]))
    return order[rank < most]


class Best:
    """The first `most` candidates of each of several searches, slice by slice; only what beats the last kept is looked at."""

    def __init__(self, searches: int, most: int) -> None:
        self.most, self.floor = most, np.full(searches, LOW)
        self.who, self.score, self.id = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.who, self.score, self.id = (np.concatenate(x) for x in ((self.who, who), (self.score, scores), (self.id, ids)))
        keep = first_of(self.who, self.score, self.id, self.most)
        self.who, self.score, self.id = self.who[keep], self.score[keep], self.id[keep]
        full, counts = np.unique(self.who, return_counts=True)
        ends = np.cumsum(counts) - 1
        done = counts == self.most
        self.floor[full[done]] = self.score[ends[done]]


def read_cell(anchors: pa.Table, rows: pa.Table, scale: int) -> tuple:
    """Both sides as sorted ids, label numbers and components, of one width."""
    rows = rows.sort_by("vec_id")
    labels = {x: k for k, x in enumerate(dict.fromkeys([*anchors.column("label").to_pylist(), *rows.column("label").to_pylist()]))}
    (a, a_most), (c, c_most) = components(anchors.column("vec"), scale), components(rows.column("vec"), scale)
    width = max(a.shape[1], c.shape[1])
    a, c = (np.hstack([x, np.zeros((len(x), width - x.shape[1]), dtype=x.dtype)]) for x in (a, c))
    number = [np.array([labels[x] for x in t.column("label").to_pylist()], dtype=np.int64) for t in (anchors, rows)]
    return a, a_most, number[0], c, c_most, number[1], rows.column("vec_id").to_numpy()


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256,
                   block: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows of (vec_id, vec, label).

    Anchors are the rows where `anchor` holds. A component x counts as floor(scale * x), a score is the whole inner product
    (held within the range of a long); higher scores come first, then smaller vec_ids. An anchor's positives are its first `positives` other rows of
    the same label. For each of them: the first `negatives` rows of other labels whose score is at most the positive's and at least
    `percent` hundredths of it.

    Rows with a null vec_id, vec or label, or a null or non-finite component, take no part. Of rows with the same vec_id, the one
    with the smallest label, then vector, stands for all. A shorter vector goes on with zeros. Anchors without positives, and positives
    without negatives, give no row; an empty table gives none.

    Anchors and rows are both dealt at random into blocks of about `block`, and each pair of blocks is one group: work is
    anchors times rows, as exact search asks for, with a bounded group each. Scores are computed twice, for positives (rows of the
    same label only) and for negatives within the positives' limits, instead of being stored.
    """
    spark = rows.sparkSession
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = rows.select("vec_id", "vec", "label", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    given = given.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.col("label").isNotNull()).where(sound)
    one = given.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.struct("label", "vec", "anchor")).alias("r"))
    one = store(one.select("vec_id", "r.label", "r.vec", "r.anchor"), "vectors")
    n, m = one.agg(F.count("*"), F.count_if("anchor")).first()
    across = max(1, -(-n // block), min(shuffle_parts(spark), -(-n // 256)))
    down = max(1, -(-m // block))

    def dealt(parts: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    candidates = one.select("vec_id", "vec", "label", dealt(across, 1).alias("c")).withColumn("a", each(down)).groupBy("a", "c")

    def cells(anchors: DataFrame) -> "PandasCogroupedOps":  # noqa: F821
        return anchors.withColumn("a", dealt(down, 2)).withColumn("c", each(across)).groupBy("a", "c").cogroup(candidates)

    def nearest(anchors: pa.Table, others: pa.Table) -> pa.Table:
        a, a_most, a_label, c, c_most, c_label, ids = read_cell(anchors, others, scale)
        mine, best = anchors.column("vec_id").to_numpy(), Best(len(anchors), positives)
        for label in np.unique(a_label):
            at, there = np.flatnonzero(a_label == label), np.flatnonzero(c_label == label)
            for k in range(0, len(there), SLICE):
                some = there[k : k + SLICE]
                scores = Packed(c[some], c_most, a_most).scores(a[at])
                ok = (mine[at][:, None] != ids[some][None, :]) & ((scores > best.floor[at][:, None]) | (best.floor[at][:, None] == LOW))
                i, j = np.nonzero(ok)
                best.add(at[i], scores[i, j], ids[some][j])
        return pa.table({"anchor_id": mine[best.who], "positive_id": best.id, "score": best.score})

    found = store(cells(one.where("anchor").select("vec_id", "vec", "label")).applyInArrow(nearest, "anchor_id long, positive_id long, score long"), "nearest")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= positives)
    limits = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("score", "positive_id"))).alias("positives"))
    limits = store(one.where("anchor").select("vec_id", "vec", "label").join(limits, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "limits")

    def below(anchors: pa.Table, others: pa.Table) -> pa.Table:
        a, a_most, a_label, c, c_most, c_label, ids = read_cell(anchors, others, scale)
        listed = anchors.column("positives").to_pylist()
        owner = np.repeat(np.arange(len(listed)), np.array([len(x) for x in listed], dtype=np.int64))
        order = np.arange(len(owner)) - np.searchsorted(owner, owner)
        positive = [p["positive_id"] for x in listed for p in x]
        high = np.array([p["score"] for x in listed for p in x], dtype=np.int64)
        least = np.array([-(-percent * p["score"] // 100) for x in listed for p in x], dtype=np.int64)
        best = Best(len(owner), negatives)
        for k in range(0, len(c), SLICE):
            scores, other = Packed(c[k : k + SLICE], c_most, a_most).scores(a), a_label[:, None] != c_label[None, k : k + SLICE]
            hits = []
            for nth in range(int(order.max(initial=-1)) + 1):
                search = np.flatnonzero(order == nth)
                s, floor = scores[owner[search]], best.floor[search][:, None]
                i, j = np.nonzero((s <= high[search][:, None]) & (s >= least[search][:, None]) & ((s > floor) | (floor == LOW)) & other[owner[search]])
                hits.append((search[i], s[i, j], ids[k : k + SLICE][j]))
            if hits:
                best.add(*(np.concatenate(x) for x in zip(*hits)))
        mine = anchors.column("vec_id").to_numpy()
        return pa.table({"anchor_id": mine[owner[best.who]], "positive_id": pa.array([positive[w] for w in best.who], pa.int64()),
                         "negative_id": best.id, "positive_score": high[best.who], "negative_score": best.score})

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = store(cells(limits).applyInArrow(below, schema), "negatives")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
