"""Benchmark decontamination: a BM25 index of test items searched with block-max WAND for every passage."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import empty, store, texts

# words: A-Z in lower case; letters, digits and what lies beyond ASCII
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
END = 1 << 60
SPAN = 4  # neighbouring entries that the first bound of a passage takes together


def words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def question_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """An item's words: the last sentence (or line) is its answer, what stands before it the question."""
    parts = [w for w in (words(p) for p in re.split(rb"(?<=[.!?])\s+|\n+", text)) if w]
    return ([w for p in parts[:-1] for w in p], parts[-1]) if len(parts) > 1 else ([w for p in parts for w in p], [])


def runs(ws: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    size = max(1, min(size, len(ws)))
    return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}


class Cursor:
    """A term's postings (entry number, weight) in blocks, each with its last entry and its largest weight."""

    __slots__ = ("ids", "weights", "last", "best", "block", "at", "top")

    def __init__(self, term: "Term") -> None:
        self.ids, self.weights, self.last, self.best, self.block, self.top = term
        self.at = 0

    def now(self) -> int:
        return self.ids[self.at] if self.at < len(self.ids) else END

    def seek(self, entry: int) -> None:
        self.at = bisect_left(self.ids, entry, self.at)

    def block_of(self, entry: int) -> int:
        return bisect_left(self.last, entry)


Term = tuple[list[int], list[float], list[int], list[float], int, float]


class Index:
    """BM25 weights of pieces of test items, scaled so that a piece scores 1 against itself.

    A piece is up to `piece` words of an item, so that a long item is found by any of its parts.
    """

    def __init__(self, items: list[tuple[int, bytes]], idf: dict[bytes, float], mean_length: float, piece: int, block: int,
                 k1: float = 1.2, b: float = 0.75) -> None:
        self.entries: list[tuple[int, int]] = []  # (item, position in parts)
        self.parts: dict[int, tuple[list[bytes], list[bytes]]] = {}
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for item, text in items:
            self.parts[item] = question_answer(text)
            ws = words(text)
            for at in range(0, max(1, len(ws) - piece // 2), piece):
                chunk = ws[at : at + piece + piece // 2 if at + piece + piece // 2 >= len(ws) else at + piece]
                norm = k1 * (1 - b + b * len(chunk) / max(mean_length, 1))
                score = {w: idf.get(w, 0) * n * (k1 + 1) / (n + norm) for w, n in Counter(chunk).items()}
                whole = sum(score.values())
                if whole > 0:
                    for w, s in score.items():
                        if s > 0:
                            postings.setdefault(w, []).append((len(self.entries), s / whole))
                    self.entries.append((item, at))
        self.number = {w: k for k, w in enumerate(postings)}
        self.terms: list[Term] = []
        for found in postings.values():
            ids, weights = [e for e, _ in found], [s for _, s in found]
            cut = range(0, len(ids), block)
            self.terms.append((ids, weights, [ids[min(k + block, len(ids)) - 1] for k in cut],
                               [max(weights[k : k + block]) for k in cut], block, max(weights)))
        self.tops = np.array([t[5] for t in self.terms] + [0.0])  # the last one is for words that aren't in the index
        # largest weight of each term among SPAN neighbouring entries, for a first bound of whole passages
        span, near = SPAN, []
        for t, (ids, weights, *_) in enumerate(self.terms):
            best: dict[int, float] = {}
            for e, s in zip(ids, weights):
                best[e // span] = max(s, best.get(e // span, 0.0))
            near += [(t, b, s) for b, s in best.items()]
        self.spans = len(self.entries) // span + 1
        self.near_term, self.near_span = (np.array([x[k] for x in near], dtype=np.int64) for k in (0, 1))
        self.near_best = np.array([x[2] for x in near])
        self.near_from = np.searchsorted(self.near_term, np.arange(len(self.terms) + 1))

    def bounds(self, passage: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """The most that any entry can score in each of n passages, from (passage, term) pairs."""
        key = np.unique(passage * (len(self.terms) + 1) + term)
        passage, term = key // (len(self.terms) + 1), key % (len(self.terms) + 1)
        count = self.near_from[term + 1] - self.near_from[term]
        at = np.arange(count.sum()) + np.repeat(self.near_from[term] - np.cumsum(count) + count, count)
        sums = np.bincount(np.repeat(passage, count) * self.spans + self.near_span[at], self.near_best[at], n * self.spans)
        return sums.reshape(n, self.spans).max(axis=1)

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all entries whose score, the sum of the terms' weights, is at least the threshold."""
        cursors, found = [Cursor(self.terms[t]) for t in terms], []
        while True:
            cursors = sorted((c for c in cursors if c.at < len(c.ids)), key=Cursor.now)
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c.top
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            entry = cursors[pivot].now()
            while pivot + 1 < len(cursors) and cursors[pivot + 1].now() == entry:
                pivot += 1
            ahead = cursors[: pivot + 1]
            blocks = [c.block_of(entry) for c in ahead]
            if sum(c.best[k] for c, k in zip(ahead, blocks) if k < len(c.best)) < threshold:
                # no entry before the end of the nearest of these blocks can reach the threshold
                beyond = min([c.last[k] + 1 for c, k in zip(ahead, blocks) if k < len(c.last)]
                             + ([cursors[pivot + 1].now()] if pivot + 1 < len(cursors) else []))
                for c in ahead:
                    c.seek(beyond)
            elif cursors[0].now() == entry:
                score = sum(c.weights[c.at] for c in ahead)
                if score >= threshold:
                    found.append((entry, score))
                for c in ahead:
                    c.at += 1
            else:
                for c in ahead:
                    if c.now() < entry:
                        c.seek(entry)

    def numbers(self, ws: list[bytes]) -> np.ndarray:
        get, none = self.number.get, len(self.terms)
        return np.fromiter((get(w, none) for w in ws), dtype=np.int64, count=len(ws))


def passages(ws: list[bytes], index: Index, width: int, threshold: float) -> dict[int, tuple[float, list[int]]]:
    """For each item that a passage of the text retrieves: its best score and the passages' starts.

    Passages are `width` words and begin every half width, so every run of half the width lies in one. One
    whose bound, from the largest weights of its terms in neighbouring entries, stays below the threshold
    can't retrieve anything; the others go through the index.
    """
    out: dict[int, tuple[float, list[int]]] = {}
    ids = index.numbers(ws)
    known = np.flatnonzero(ids < len(index.terms))
    if not known.size:
        return out
    step, term = width // 2, ids[known]
    n = max(1, -(-(len(ws) - step) // step))
    later = known // step  # the last passage a word lies in; it lies in the one before, too
    for begin in range(0, n, 256):
        end = min(n, begin + 256)
        both = np.concatenate([later, later - 1]), np.concatenate([term, term])
        here = (both[0] >= begin) & (both[0] < end)
        if not here.any():
            continue
        bound = index.bounds(both[0][here] - begin, both[1][here], end - begin)
        for k in (begin + np.flatnonzero(bound >= threshold - 1e-9)).tolist():
            s = k * step
            for entry, score in index.search(set(ids[s : s + width].tolist()) - {len(index.terms)}, threshold):
                item = index.entries[entry][0]
                best, at = out.setdefault(item, (0.0, []))
                at.append(s)
                out[item] = (max(best, score), at)
    return out


def overlaps(ws: list[bytes], starts: list[int], parts: tuple[list[bytes], list[bytes]], width: int, size: int) -> tuple[float, float]:
    """The shares of the question's and the answer's runs of `size` words that stand near the passages (none: 1)."""
    reach = width + len(parts[0]) + len(parts[1])
    near: set[tuple[bytes, ...]] = set()
    sizes = [max(1, min(size, len(p))) for p in parts]
    for s in starts:
        around = ws[max(0, s - reach) : s + width + reach]
        for k in set(sizes):
            near |= runs(around, k)
    return tuple(sum(r in near for r in wanted) / len(wanted) if p else 1.0
                 for p, wanted in ((p, runs(p, k)) for p, k in zip(parts, sizes)))


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8, piece: int = 64, width: int = 192,
    size: int = 5, block: int = 64, index_items: int = 20_000,
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): documents (doc_id, text) that hold a test item (item_id, text).

    Every passage of every document queries the BM25 index of the items; all items with at least `threshold`
    of the score they have against themselves are retrieved with block-max WAND, and stay if `overlap` of
    the question's and of the answer's runs of five words stand in the text around the passage.

    Term frequencies are counted by Spark over the different texts of all items; every word has a positive weight, however common. An index holds at most `index_items` items
    and is sent to the executors; a larger benchmark is searched in several such blocks, one after the other.
    Null and empty texts and items without an id give nothing; documents without an id are reported as one;
    rows with the same ids are judged one by one and reported once, with their best score. Texts of any
    length are searched whole. An empty table gives an empty result.
    """
    items = store(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct(), "items")
    word = F.explode(F.array_distinct(F.split(F.regexp_replace(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                                               r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " ")))
    mean = items.agg(F.avg(F.size(F.split("text", r"\s+")))).first()[0]
    different = items.select("text").distinct()  # a text under many ids makes its words no commoner
    count, n = items.count(), different.count()
    frequencies = store(different.select(word.alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n")), "item-words")
    # blocks by range of a running number over (item_id): each holds `index_items` rows at most
    parts = max(1, -(-count // index_items))
    numbered = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(4 * parts)))
    sizes = sorted((r["count"], r["_block"]) for r in numbered.groupBy("_block").count().collect())
    groups: list[list[int]] = []
    held = 0
    for rows_of, b in sizes:
        if not groups or held + rows_of > index_items:
            groups.append([])
            held = 0
        groups[-1].append(b)
        held += rows_of
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = empty(docs.sparkSession, schema)
    for group in groups:
        block_items = numbered.where(F.col("_block").isin(group)).drop("_block")
        vocabulary = block_items.select(word.alias("word")).distinct()
        idf = {r.word.encode(): log(1 + (n - r.n + 0.5) / (r.n + 0.5)) for r in frequencies.join(vocabulary, "word").collect()}
        index = Index(sorted((r.item_id, r.text.encode()) for r in block_items.collect() if r.item_id is not None),
                      idf, float(mean or 1), piece, block)

        def run(batches: Iterator[pa.RecordBatch], found_in: Index = index) -> Iterator[pa.RecordBatch]:
            rows = []
            for batch, found in texts(batches):
                for doc, text in zip(batch.column(0).to_pylist(), found):
                    ws = words(text)
                    for item, (score, starts) in passages(ws, found_in, width, threshold).items():
                        q, a = overlaps(ws, starts, found_in.parts[item], width, size)
                        if q >= overlap and a >= overlap:
                            rows.append((doc, item, float(score), q, a))
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 2 + [pa.float64()] * 3)],
                                                     ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
                    rows = []

        out = out.union(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))
    return out.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max("question_overlap").alias("question_overlap"), F.max("answer_overlap").alias("answer_overlap"))
