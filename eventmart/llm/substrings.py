"""Repeated byte strings: prefix doubling over text positions, thinned out as ranks become unique."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import store, texts

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
ROWS = "core long, whole long, doc_id long, digest long, lo int, hi int, anchor int"
GROUP = 1 << 17  # bytes of text handled at a time


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of a pair of ranks: equal pairs, equal ranks (64-bit fingerprints stand for ranks)."""
    x = a * M1
    x += b
    x ^= x >> np.uint64(29)
    x *= M2
    x ^= x >> np.uint64(32)
    return x


class Ranks:
    """Ranks of all positions for the lengths 1, 2, 4, ...: each from the pair of ranks at distance h."""

    def __init__(self, data: np.ndarray, longest: int) -> None:
        self.by = {1: (data.astype(np.uint64) + np.uint64(1)) * M2}
        h = 1
        while 2 * h <= min(longest, data.size):
            self.by[2 * h] = pair(self.by[h][:-h], self.by[h][h:])
            h *= 2

    def of(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The two ranks that stand for the strings of a length: of its first and its last 2^k bytes, which overlap."""
        h = 1 << (length.bit_length() - 1)
        return self.by[h][at], self.by[h][at + (length - h)]

    def varying(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """As `of`, for a length of its own each, as one number."""
        out = np.zeros(at.size, dtype=np.uint64)
        for h in self.by:
            here = (length >= h) & (length < 2 * h)
            if here.any():
                r = self.by[h]
                out[here] = pair(r[at[here]], r[at[here] + length[here] - h] + length[here].astype(np.uint64))
        return out


def groups(found: list[bytes]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """Neighbouring texts put together up to GROUP bytes: (first, their offsets, the bytes)."""
    first, held, offsets = 0, [], [0]
    for k, t in enumerate(found):
        held.append(t)
        offsets.append(offsets[-1] + len(t))
        if offsets[-1] >= GROUP or k + 1 == len(found):
            yield first, offsets, np.frombuffer(b"".join(held), dtype=np.uint8)
            first, held, offsets = k + 1, [], [0]


def anchors(r: np.ndarray, window: int, valid: np.ndarray, text_no: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start): each window's anchor is the leftmost position of its smallest rank.

    Which position that is depends on the window's own bytes only, so equal strings have the same anchor.
    """
    low, h = r, 1
    while 2 * h <= window:
        low, h = np.minimum(low[:-h], low[h:]), 2 * h
    if h < window:
        low = np.minimum(low[: low.size - (window - h)], low[window - h :])
    starts = np.flatnonzero(valid[: low.size])
    if not starts.size:
        return starts, starts, starts
    new = np.r_[True, (low[starts[1:]] != low[starts[:-1]]) | (starts[1:] != starts[:-1] + 1) | (text_no[starts[1:]] != text_no[starts[:-1]])]
    first, last = starts[new], np.r_[starts[np.flatnonzero(new)[1:] - 1], starts[-1]]
    out, ahead = [], np.arange(window)
    while first.size:
        at = first + np.argmin(r[first[:, None] + ahead], axis=1)
        out.append((at, first, np.minimum(last, at)))
        on = last > at
        first, last = at[on] + 1, last[on]
    return tuple(np.concatenate(x) for x in zip(*out))


def first_rows(length: int, core: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per anchor: rank of the `core` bytes at it, rank of all bytes its strings cover, and their starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            ids, digests = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            for begin, offsets, data in groups(found):
                if data.size < length:
                    continue
                edges = np.array(offsets)
                text_no = np.repeat(np.arange(edges.size - 1), np.diff(edges))
                valid = np.arange(data.size) + length <= edges[text_no + 1]
                ranks = Ranks(data, 2 * length)
                at, lo, hi = anchors(ranks.by[core], length - core + 1, valid, text_no)
                if not at.size:
                    continue
                doc = text_no[lo]
                whole = pair(ranks.varying(lo, hi - lo + length), ((at - lo) * 4096 + (hi - lo)).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranks.by[core][at].view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids[begin + doc]), pa.array(digests[begin + doc]),
                     *(pa.array((x - edges[doc]).astype(np.int32)) for x in (lo, hi, at))],
                    ["core", "whole", "doc_id", "digest", "lo", "hi", "anchor"])

    return run


def finer_rows(length: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The strings that are still open, in ranges of at most `width` starts, with the ranks of what all strings of
    a range share and of what they cover together. A width of 1 compares the strings themselves.

    Ranges are counted from the range's anchor string, so equal strings fall into equal places of a range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            lists = batch.column(3)
            for k, text in enumerate(found):
                data = np.frombuffer(text, dtype=np.uint8)
                ranks = Ranks(data, 2 * length)
                item = lists[k].values
                lo, hi, zero = (np.asarray(item.field(c)).astype(np.int64) for c in ("lo", "hi", "anchor"))
                # starts by distance to the anchor: `far` of them down to `near`, cut at multiples of width
                near, far = zero - hi, zero - lo
                first, n = near // width, far // width - near // width + 1
                row = np.repeat(np.arange(lo.size), n)
                block = first[row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                begin, end = np.maximum(lo[row], zero[row] - (block * width + width - 1)), np.minimum(hi[row], zero[row] - block * width)
                if width == 1:
                    core, whole = ranks.of(begin, length)
                else:
                    a, b = ranks.of(zero[row] - block * width, length - width + 1)
                    core = pair(pair(a, b), block.astype(np.uint64))
                    whole = pair(ranks.varying(begin, end - begin + length), ((zero[row] - begin) * 4096 + end - begin).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array([batch.column(0)[k].as_py()] * row.size, pa.int64()),
                     pa.array([batch.column(2)[k].as_py()] * row.size, pa.int64()), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)),
                     pa.array(zero[row].astype(np.int32))], ["core", "whole", "doc_id", "digest", "lo", "hi", "anchor"])

    return run


def rerank(rows: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """(ranges of starts that are repeated, ranges still open), from the ranks of one round.

    A rank that nothing else has is unique, and so are all strings of its range. Ranges equal in all their
    bytes are repeated; one of each kind stays open if others share its core but not all.
    """
    shared = rows.groupBy("core").agg(F.count("*").alias("_n")).where("_n > 1").select("core")
    alive = store(rows.join(shared, "core"), "alive")
    who = [c for c in rows.columns if c not in ("core", "whole")]
    kinds = store(alive.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct(*who)).alias("who")), "kinds")
    repeated = store(alive.join(kinds.where("n > 1").select("core", "whole"), ["core", "whole"]).select("doc_id", "digest", "lo", "hi"), "repeated")
    if last:
        return repeated, None
    several = kinds.groupBy("core").agg(F.count("*").alias("_k")).where("_k > 1").select("core")
    return repeated, store(kinds.join(several, "core").select("who.*"), "open")


def repeated_starts(docs: DataFrame, length: int, core: int, widths: tuple[int, ...]) -> DataFrame:
    """(doc_id, digest, lo, hi): all starts of byte strings of `length` that start elsewhere too."""
    rows = store(docs.mapInArrow(first_rows(length, core), ROWS), "ranks")
    repeated, still = rerank(rows, last=False)
    found = [repeated]
    for width in widths:
        marks = still.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("lo", "hi", "anchor")).alias("marks"))
        rows = docs.join(marks, ["doc_id", "digest"]).select("doc_id", "text", "digest", "marks").mapInArrow(
            finer_rows(length, width), ROWS)
        repeated, still = rerank(store(rows, "ranks"), last=width == 1)
        found.append(repeated)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def substring_dedup(docs: DataFrame, length: int = 200, core: int = 32, widths: tuple[int, ...] = (16, 1)) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of (doc_id, text): repeated byte strings taken out.

    Every byte that lies in a string of `length` bytes which also starts anywhere else, in the same text or
    another, is removed; `kept` is what is left. Strings are judged on the input and never cross texts.

    Method: prefix doubling. Positions get ranks for the lengths 1, 2, 4, ...; a rank is that of the pair of
    ranks at distance h. Spark groups equal ranks; positions whose rank is unique drop out, the rest go
    on to longer prefixes, until they are unique or past `length`. The first rounds run inside a text
    (its ranks need no one else's), and the global rounds compare few positions: at first one per
    string neighbourhood, an anchor that the strings' own bytes determine (`core` bytes from it), then
    ranges of `widths` strings around the anchors that are left, at last single strings. Ranks are 64-bit
    fingerprints, and 128 bits decide that two strings are equal.

    Null counts as empty. A text shorter than `length` is never touched. Rows repeated as a whole
    count as different texts and lose all their bytes. A null doc_id is allowed. An empty table gives an
    empty result. Texts of any length are taken whole; a task holds one text at a time besides its batch.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), "text").select(
        "doc_id", "text", F.xxhash64("text").alias("digest"))
    starts = repeated_starts(docs, length, core, widths)
    marks = starts.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))  # as long as the text at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            n_bytes, removed, spans, kept = [], [], [], []
            lists = batch.column(3)
            for k, text in enumerate(found):
                data = np.frombuffer(text, dtype=np.uint8)
                step = np.zeros(data.size + 1, dtype=np.int64)
                if lists[k].is_valid:
                    item = lists[k].values
                    np.add.at(step, np.asarray(item.field("lo")), 1)
                    np.add.at(step, np.asarray(item.field("hi")) + length, -1)
                out = np.cumsum(step)[:-1] > 0
                n_bytes.append(data.size)
                removed.append(int(out.sum()))
                spans.append(int((out[1:] & ~out[:-1]).sum() + out[:1].sum()))
                kept.append(data[~out].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, spans)), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = docs.join(marks, ["doc_id", "digest"], "left").select("doc_id", "text", "digest", "marks")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumn(
        "doc_id", F.when(F.col("doc_id") != -(2**63), F.col("doc_id")))
