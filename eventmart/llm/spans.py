"""Substring dedup by sliding spans of sentences, long ones cut where their words say."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import store, texts
from eventmart.llm.neardup import WordHashes, mix

# a sentence ends after . ! or ? before white space, or at the end of a line; its piece keeps the gap that follows
WORD = re.compile(rb"\S+")
END = re.compile(rb"(?:[.!?]+[\"')\]]*(?=[ \t\r\n])|\n)[ \t\r\n]*")


def sentences(text: bytes) -> list[bytes]:
    """Pieces of the text, in order; put together they are the text."""
    at = [0, *(m.end() for m in END.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:]) if a < b]


def anchors(h: np.ndarray, ends: np.ndarray, reach: int) -> np.ndarray:
    """Places chosen by what stands there: of each `reach` neighbouring pairs of words of a sentence the one of the smallest hash.

    Two texts with the same reach + 1 words in a sentence have an anchor at the same one of them, whatever surrounds these.
    """
    if h.size <= reach:
        return np.empty(0, dtype=np.int64)
    of = np.repeat(np.arange(ends.size - 1), np.diff(ends))
    start = np.flatnonzero(of[:-reach] == of[reach:])
    pairs = np.lib.stride_tricks.sliding_window_view(mix(h[:-1], h[1:]), reach)
    return np.unique(pairs[start].argmin(axis=1) + start)


class RunHashes:
    """Two 64-bit hashes of any run of words, from sums over the words' hashes times powers of an odd number."""

    SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

    def __init__(self) -> None:
        self.up, self.down = [np.ones(1, dtype=np.uint64)] * 2, [np.ones(1, dtype=np.uint64)] * 2

    def of(self, h: np.ndarray, first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        out = []
        for k, base in enumerate(self.SEEDS):
            if self.up[k].size <= h.size:
                for powers, odd in ((self.up, base), (self.down, np.uint64(pow(int(base), -1, 1 << 64)))):
                    powers[k] = np.cumprod(np.r_[np.uint64(1), np.full(2 * h.size, odd, dtype=np.uint64)], dtype=np.uint64)
            total = np.r_[np.uint64(0), np.cumsum(mix(h, base) * self.up[k][: h.size], dtype=np.uint64)]
            out.append(mix((total[end] - total[first]) * self.down[k][first], (end - first).astype(np.uint64)).view(np.int64))
        return out


def runs(h: np.ndarray, ends: np.ndarray, size: int, min_words: int, long: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of the runs of a text whose sentences end before the words `ends` (0 first).

    A sentence of more than `reach` words is cut at its anchors, into pieces of `reach` words at most that act as sentences.
    From each sentence or piece a run goes on until it has the ends of `size` sentences and `min_words` words, or
    `long` words. The last one goes to the end of the text; a text without any is one run if it has `min_words` words.
    """
    n = int(ends[-1])
    cuts = np.unique(np.r_[ends, anchors(h, ends, reach) + 1])
    first = cuts[:-1]
    after = np.r_[ends, np.full(size, 2 * n + 2 * long)]  # beyond the text: there is no such end
    far = np.r_[cuts, 2 * n + 2 * long]
    by_sentence = np.maximum(after[np.searchsorted(ends, first, side="right") + size - 1], far[np.searchsorted(cuts, first + min_words)])
    end = np.minimum(by_sentence, far[np.searchsorted(cuts, first + long)])
    first, end = first[end <= n], end[end <= n]
    if end.size == 0:
        whole = np.array([0] * (n >= min_words), dtype=np.int64)
        return whole, whole + n
    return (first, end) if end[-1] == n else (np.r_[first, first[-1]], np.r_[end, n])


def join_hot(rows: DataFrame, keys: DataFrame, on: list[str], share: int = 10_000) -> DataFrame:
    """Inner join with one row for each key, `_n` of them rows; keys of many rows are sent to the rows, so that none meets in one task.

    What is broadcast is at most `share` keys: each has more than the `share`-th part of all rows.
    """
    many = F.col("_n") > max(10_000, rows.count() // share)
    hot = F.broadcast(keys.where(many).drop("_n"))
    cold = rows.join(F.broadcast(keys.where(many).select(*on)), on, "left_anti").join(keys.where(~many).drop("_n"), on)
    return rows.join(hot, on).union(cold)


def repeated_spans(docs: DataFrame, size: int = 3, min_words: int = 12, long: int = 25, reach: int = 13) -> DataFrame:
    """(doc_id, first, last): the runs, by their words, that occurred before, in a smaller (doc_id, place).

    What overlaps the first occurrence is part of it, not another one. Words are compared with A-Z in lower case and any
    white space between them. Runs are counted by half of their hash; only those met again are followed to their places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, of_runs = WordHashes(), RunHashes()
        for batch, found in texts(batches):
            none = np.empty(0, dtype=np.int64)
            h1, h2, ids, first, last = [none], [none], [none], [none], [none]
            for doc, text in zip(batch.column(0).to_pylist(), found):
                ws = [w for w in (p.lower().split() for p in sentences(text)) if w]
                if ws:
                    ends = np.cumsum([0, *map(len, ws)])
                    h = np.fromiter((words[x] for w in ws for x in w), dtype=np.uint64, count=int(ends[-1]))
                    a, b = runs(h, ends, size, min_words, long, reach)
                    for into, x in zip((h1, h2, ids, first, last), (*of_runs.of(h, a, b), np.full(a.size, doc), a, b - 1)):
                        into.append(x)
            places = [pa.array(np.concatenate(x), t) for x, t in ((h1, pa.int64()), (h2, pa.int64()), (ids, pa.int64()), (first, pa.int32()), (last, pa.int32()))]
            yield pa.RecordBatch.from_arrays(places, ["h1", "h2", "doc_id", "first", "last"])

    spans = store(docs.mapInArrow(run, "h1 long, h2 long, doc_id long, first int, last int"), "spans")
    met = store(spans.groupBy("h1").agg(F.count("*").alias("_n")).where("_n > 1"), "met-again")
    places = store(join_hot(spans, met, ["h1"]), "places")
    place = F.struct("doc_id", "first", "last")
    again = places.groupBy("h1", "h2").agg(F.min(place).alias("_where"), F.count("*").alias("_n")).where("_n > 1")
    again = store(again, "again")  # its shuffle files can go before the spans are dealt out
    found = join_hot(places, again, ["h1", "h2"]).where((F.col("doc_id") != F.col("_where.doc_id")) | (F.col("first") > F.col("_where.last")))
    return store(found.select("doc_id", "first", "last"), "repeated-spans")


def span_dedup(docs: DataFrame, size: int = 3, min_words: int = 12, long: int = 25, reach: int = 13) -> DataFrame:
    """(doc_id, n_sentences, n_removed, n_spans, text) of every row of (doc_id, text), repeated passages taken out.

    Runs of `size` consecutive sentences (longer where these have fewer than `min_words` words, shorter where fewer have `long`)
    are hashed. Long sentences are first cut, at places that the words themselves choose, into pieces of `reach` words
    at most that act as sentences, so any repeated passage of long + 2 * reach - 1 words is met, wherever it begins in a
    sentence and however it is punctuated; at each of its ends up to `reach` words of it may stay. A run that occurs more than once keeps its first place, by (doc_id, place),
    and all words that another occurrence covers are removed, within a document too, with the white space after them.
    n_removed counts the sentences that lost words, n_spans the stretches removed.

    A null text stays null and has no sentences. Rows with the same doc_id share one list of places, so their
    equal texts count as one; rows without doc_id are passed through. A text without a run and
    of `min_words` words or more is a run, too. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(docs.where("doc_id is not null"), size, min_words, long, reach)
    marks = spans.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("marks"))  # as long as the text at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            n, removed, stretches, kept = [], [], [], []
            for raw, text, marks in zip(batch.column(1), found, batch.column(2).to_pylist()):
                pieces = sentences(text)
                n.append(len(pieces))
                if not marks:
                    removed.append(0)
                    stretches.append(0)
                    kept.append(text if raw.is_valid else None)
                    continue
                starts = [m.start() for m in WORD.finditer(text)]
                out = np.zeros(len(starts) + 1, dtype=bool)
                for m in marks:
                    out[m["first"] : min(m["last"] + 1, len(starts))] = True  # a repeated doc_id may bring marks of a longer text
                edges = np.flatnonzero(np.diff(np.r_[False, out])).reshape(-1, 2)  # the last entry is never set, so edges come in pairs
                cuts = [(starts[a], starts[b] if b < len(starts) else len(text)) for a, b in edges.tolist()]
                of = np.searchsorted(np.cumsum([len(p) for p in pieces]), np.array(starts)[out[:-1]], side="right")
                removed.append(int(np.unique(of).size))
                stretches.append(len(cuts))
                kept.append(b"".join(text[a:b] for a, b in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(text)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, stretches)), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_sentences", "n_removed", "n_spans", "text"])

    return docs.join(marks, "doc_id", "left").select("doc_id", "text", "marks").mapInArrow(
        run, "doc_id long, n_sentences long, n_removed long, n_spans long, text string")
