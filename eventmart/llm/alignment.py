"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, per document and over the corpus."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.llm.common import store
from eventmart.llm.tokens import KEPT, LONGEST, Numbers, byte_level_tokens, file_bytes, json_encode, json_tokenizer, lasting, sentence_piece_tokens, stretches

WINDOW = 1_000_000  # characters aligned at once; a longer text goes through in several windows
BROADCAST_ROWS = 500_000  # id pairs that are sent to all tasks; more are joined by a shuffle


@dataclass
class Aligned:
    """What the windows of one document add up to."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pairs: Counter = field(default_factory=Counter)
    keys: np.ndarray | None = None
    times: np.ndarray | None = None
    text: list = field(default_factory=list)
    digest: "hashlib._Hash" = field(default_factory=hashlib.sha256)


class Aligner:
    """Tokenizes texts both ways, finds overlaps and common ends; lives in one task.

    Both tokenizers cut where a stretch ends, so a text's alignment is that of its stretches, one after the other. Each stretch is
    aligned when it is first met; texts add up what is kept of theirs.
    """

    def __init__(self, model_a: bytes, model_b: bytes, digest: bool) -> None:
        import sentencepiece

        tokenizer, pieces = json_tokenizer(model_a, plain_specials=True), sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.bytes_a, self.bytes_b = byte_level_tokens(tokenizer), sentence_piece_tokens(pieces)
        self.size_b, self.digest = len(self.bytes_b), digest
        self.len_a, self.len_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        encode = json_encode(tokenizer)
        self.encode_a, self.encode_b = (lambda parts: encode([" " + p for p in parts])), (lambda parts: pieces.encode(parts, num_threads=1))
        self.names_a = np.array([f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"], dtype=object)
        self.names_b = np.array([f"{i}{mark}" for i in range(self.size_b) for mark in ",;\n"], dtype=object)
        self.forget()

    def forget(self) -> None:
        self.known, self.size = Numbers(), 0
        self.said: list[bytes] = []  # the groups of each stretch, written
        self.counts = np.empty((0, 5), dtype=np.int32)  # of each: n_a, n_b, n_groups, n_links, whether the tokens don't give it back
        self.starts = np.empty(0, dtype=np.int64)  # of each: its first link in `pairs`
        self.pairs = np.empty(0, dtype=np.int64)

    def learn(self) -> None:
        """Align the stretches that have a number only."""
        parts, self.known.new = self.known.new, []
        if not parts:
            return
        self.size += sum(map(len, parts))
        texts = [(" " + p).encode() for p in parts]
        a = self.faithful(texts, list(self.encode_a(parts)), self.bytes_a, self.len_a)
        b = self.faithful(texts, self.encode_b(parts), self.bytes_b, self.len_b)
        kept = [m for m, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
        counts, said = np.zeros((len(parts), 5), dtype=np.int32), [b""] * len(parts)
        counts[:, 4] = 1
        if kept:
            found, written, pairs = self.overlaps([a[m] for m in kept], [b[m] for m in kept])
            counts[kept, :4], counts[kept, 4] = found, 0
            for m, w in zip(kept, written):
                said[m] = w
            self.pairs, at = np.concatenate([self.pairs, pairs]), self.pairs.size
        else:
            at = self.pairs.size
        ends = np.cumsum(counts[:, 3], dtype=np.int64)
        self.starts = np.concatenate([self.starts, at + ends - counts[:, 3]])
        self.counts = np.concatenate([self.counts, counts])
        self.said += said

    @staticmethod
    def faithful(texts: list[bytes], found: list[list[int]], token: list[bytes], lengths: np.ndarray) -> list[bytes | None]:
        """The ids of each stretch, None where their bytes are not those of the stretch."""
        flat = np.fromiter(itertools.chain.from_iterable(found), dtype="<u4")
        ends = np.cumsum([len(x) for x in found])
        at = np.r_[0, np.cumsum(lengths[flat])][ends]
        raw, cut = flat.tobytes(), [0, *(4 * ends).tolist()]
        out = [raw[x:y] for x, y in zip(cut, cut[1:])]
        if (at == np.cumsum([len(t) for t in texts])).all() and b"".join(map(token.__getitem__, flat.tolist())) == b"".join(texts):
            return out  # all of them, as usual
        return [x if b"".join(map(token.__getitem__, ids)) == t else None for x, ids, t in zip(out, found, texts)]

    def run(self, texts: list[str]) -> list[Aligned]:
        """Each text's alignment; a text without tokens, or one that a tokenizer doesn't give back, has none."""
        out, part, size = [Aligned() for _ in texts], [], 0
        for k, text in enumerate(texts):
            cut = stretches(text) if text else []
            for at in range(0, len(cut), WINDOW // 8):
                part.append((k, cut[at : at + WINDOW // 8]))
                size += len(text) * len(part[-1][1]) // len(cut)
                if size >= WINDOW:
                    self.align(part, out)
                    part, size = [], 0
        self.align(part, out)
        return [self.closed(x) for x in out]

    def align(self, part: list[tuple[int, list[str]]], out: list[Aligned | None]) -> None:
        """Add windows (document, stretches) to their documents."""
        if len(self.known) > KEPT or self.size > KEPT * LONGEST // 4:
            self.forget()
        if not part:
            return
        listed = list(map(self.known.__getitem__, itertools.chain.from_iterable(p for _, p in part)))
        self.learn()
        numbers, ends = np.array(listed), np.cumsum([0, *(len(p) for _, p in part)])
        each = self.counts[numbers]
        sums = np.add.reduceat(each, ends[:-1], axis=0, dtype=np.int64)
        links = each[:, 3].astype(np.int64)
        at = np.arange(links.sum()) + np.repeat(self.starts[numbers] - np.cumsum(links) + links, links)
        span = len(self.bytes_a) * self.size_b
        keys, times = np.unique(np.repeat(np.arange(len(part)) * span, sums[:, 3]) + self.pairs[at], return_counts=True)
        bounds = np.searchsorted(keys, np.arange(len(part) + 1) * span)
        for m, (k, _) in enumerate(part):
            n_a, n_b, n_groups, n_links, broken = sums[m].tolist()
            if broken:
                out[k] = None
            x = out[k]
            if x is None:
                continue
            own, often = keys[bounds[m] : bounds[m + 1]] - m * span, times[bounds[m] : bounds[m + 1]]
            if x.keys is None:
                x.keys, x.times = own, often
            else:  # a further window of a long text
                x.keys, place = np.unique(np.r_[x.keys, own], return_inverse=True)
                x.times = np.bincount(place, weights=np.r_[x.times, often]).astype(np.int64)
            said = b";".join(map(self.said.__getitem__, listed[ends[m] : ends[m + 1]]))
            if self.digest:
                x.digest.update(b";" + said if x.n_groups else said)
            else:
                x.text.append(said)
            x.n_a, x.n_b, x.n_groups, x.n_links = x.n_a + n_a, x.n_b + n_b, x.n_groups + n_groups, x.n_links + n_links

    def overlaps(self, ids_a: list[bytes], ids_b: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Of each stretch its counts (n_a, n_b, n_groups, n_links) and its groups, written; the linked id pairs, stretch by stretch.

        Each token's start finds the token of the other side that covers it; both directions together are all overlaps. Places
        are counted on from stretch to stretch: both sides have the same bytes in each.
        """
        n = len(ids_a)
        count_a, count_b = (np.array([len(x) // 4 for x in side]) for side in (ids_a, ids_b))
        a, b = (np.frombuffer(b"".join(side), dtype="<u4").astype(np.int64) for side in (ids_a, ids_b))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        stretch_a = np.repeat(np.arange(n), count_a)
        left = pd.DataFrame({"at": end_a - self.len_a[a], "i": np.arange(len(a))})
        right = pd.DataFrame({"at": end_b - self.len_b[b], "j": np.arange(len(b))})
        cover_a = pd.merge_asof(left, right, on="at")["j"].to_numpy().astype(np.int64)
        cover_b = pd.merge_asof(right, left, on="at")["i"].to_numpy().astype(np.int64)
        start_a, start_b = left["at"].to_numpy(), right["at"].to_numpy()
        same_a, same_b = start_b[cover_a] == start_a, start_a[cover_b] == start_b
        more = np.flatnonzero(~same_b)  # equal starts are met from either side
        i, j = np.r_[np.arange(len(a)), cover_b[more]], np.r_[cover_a, more]
        order = np.argsort(i, kind="stable")
        pairs = (a[i] * self.size_b + b[j])[order]
        last_a, last_b = np.r_[same_a[1:], True], np.r_[same_b[1:], True]  # a token ends where the next one starts
        counts = np.column_stack([count_a, count_b, np.bincount(stretch_a[last_a], minlength=n), np.bincount(stretch_a[i], minlength=n)])
        return counts, self.written(a, b, last_a, last_b, np.cumsum(count_b) - 1), pairs

    def written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, closing: np.ndarray) -> list[bytes]:
        """Each stretch's ids with the mark that follows each, group by group: those of the first tokenizer, then those of the second.

        `closing` has the places in `b` where stretches end.
        """
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_a = np.r_[0, np.cumsum(np.bincount(group_b, minlength=int(last_a.sum())))]  # tokens b in earlier groups
        before_b = np.cumsum(np.bincount(group_a, minlength=int(last_a.sum())))  # tokens a up to and with the group
        mark_b = last_b.astype(np.int64)
        mark_b[closing] = 2
        out = np.empty(len(a) + len(b), dtype=object)
        out[np.arange(len(a)) + before_a[group_a]] = self.names_a[2 * a + last_a]
        out[np.arange(len(b)) + before_b[group_b]] = self.names_b[3 * b + mark_b]
        return "".join(out.tolist()).encode().split(b"\n")[:-1]

    def closed(self, x: Aligned | None) -> Aligned:
        x = x or Aligned()
        x.keys = np.empty(0, dtype=np.int64) if x.keys is None else x.keys
        x.times = np.empty(0, dtype=np.int64) if x.times is None else x.times
        return x

    def groups(self, x: Aligned) -> str:
        return "" if not x.n_a else x.digest.hexdigest() if self.digest else b";".join(x.text).decode()


def aligned(docs: DataFrame, model_a: bytes, model_b: bytes, digest: bool) -> DataFrame:
    """One row for each row of (doc_id, text): counts, groups, and its linked id pairs with their numbers of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = lasting(lambda: Aligner(model_a, model_b, digest), model_a, model_b, bytes([digest]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                found = aligner.run(some.column("text").to_pylist())
                ends = pa.array(np.r_[0, np.cumsum([len(x.keys) for x in found])], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(v), pa.int64())) for v in ([x.keys for x in found], [x.times for x in found])]
                counts = [pa.array([getattr(x, c) for x in found], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *counts, pa.array([aligner.groups(x) for x in found], pa.string()), *lists],
                                                 ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>")


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False,
                     broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of (doc_id, text).

    Space + text is tokenized by a byte-level JSON tokenizer (A) and by a sentence-piece model (B, which adds the space itself).
    Byte offsets where tokens of both end cut the text into groups, written `a1,a2|b1;a3|b2,b3` (or the SHA-256 of that, with
    `digest`). Links are all pairs of an A and a B token whose byte ranges overlap. An id pair's count is the number of rows that
    hold it linked, over all rows; n_best is how many links have the highest count of their A id (ties included), count_sum the sum
    of the counts of all links.

    A null or empty text, or one that the tokens of A or B don't give back byte for byte, has zeros and an empty text. Rows are not told
    apart by doc_id: repeated rows are documents of their own. Texts go through in windows that end where both tokenizers cut; of a very
    long one only its distinct id pairs are held. Counts are broadcast up to `broadcast_rows` id pairs, and joined by a shuffle beyond.
    """
    model_a, model_b = file_bytes(path_a or public_tokenizers.path("byte_bpe_50k.json")), file_bytes(path_b or public_tokenizers.path("piece_bpe_32k.model"))
    size_b = model_size(model_b)
    rows = store(aligned(docs, model_a, model_b, digest).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counted = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    highest = F.max("count").over(Window.partitionBy((F.col("pair") / size_b).cast("long")))
    counted = store(counted.withColumn("best", F.col("count") == highest).withColumnRenamed("pair", "_pair"), "pairs")
    small = counted.count() <= broadcast_rows
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    links = links.join(F.broadcast(counted) if small else counted, F.col("pairs") == F.col("_pair"))
    sums = store(links.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")), "sums")
    none = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups")


def model_size(model: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
