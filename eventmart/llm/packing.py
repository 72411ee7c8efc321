"""Best-fit packing: documents as token pieces, placed in sequences of bounded length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import store, texts
from eventmart.llm.tokens import WordIds, file_bytes, lasting

SENT = 4_000_000  # bytes of ids in one batch


def token_pieces(docs: DataFrame, tokenizer: str | None = None, end: int = 0, longest: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every row of (doc_id, text): its token ids, then the id `end`.

    ids are little-endian unsigned 32-bit numbers. Only a document of more than `longest` ids is cut, into pieces
    of `longest`; the last one may be shorter. start counts the document's ids before the piece. A null or empty text
    is the one id `end`. Rows are not told apart by doc_id: repeated rows are documents of their own. `tokenizer` is a
    JSON file whose normalizer and splitter never join what ASCII white space parts (word_bpe_49k.json by default);
    each part of a text is tokenized once per worker and looked up afterwards.
    """
    model = file_bytes(tokenizer or public_tokenizers.path("word_bpe_49k.json"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tail = lasting(lambda: WordIds(model), model), np.uint32(end).astype("<u4").tobytes()
        rows, held = [], 0

        def made() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids"])

        for batch, found in texts(batches):
            for i, text in zip(batch.column(0).to_pylist(), found):
                ids = known.of(text) + tail
                for k, at in enumerate(range(0, len(ids), 4 * longest)):
                    cut = ids[at : at + 4 * longest]
                    rows.append((i, k, at // 4, len(cut) // 4, cut))
                    held += len(cut)
                    if held > SENT:
                        yield made()
                        rows, held = [], 0
        if rows:
            yield made()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary")


class OpenBins:
    """Bins by their remaining room, under a segment tree that tells where any are: the tightest is found in log(room)."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << (capacity + 1).bit_length()
        self.any = [False] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        node = room + self.leaves
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, number) of a bin with the least room that is `size` or more; it is open no longer."""
        node = size + self.leaves
        while not self.any[node]:
            while node & 1:  # a right child: what follows hangs on the parent's right neighbour
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        number = self.bins[room].pop()
        if not self.bins[room]:
            while node and not (self.any[2 * node] or self.any[2 * node + 1] if node < self.leaves else self.bins[room]):
                self.any[node] = False
                node >>= 1
        return room, number


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size: longest first, each into the tightest open bin; one beyond the capacity is alone."""
    bins, offsets, opened = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64), 0
    open_bins = OpenBins(capacity)
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = open_bins.take(size) if size <= capacity else None
        room, number = found or (max(capacity, size), opened)
        opened += not found
        bins[k], offsets[k] = number, max(capacity, size) - room if not found else capacity - room
        if size <= capacity:
            open_bins.put(room - size, number)
    return bins, offsets


def best_fit_pack(pieces: DataFrame, length: str, capacity: int = 2048, group_rows: int = 65_536) -> DataFrame:
    """Every row of `pieces` with sequence_id and offset: sequences of at most `capacity`, as few as best fit finds.

    Rows are dealt at random into groups of about `group_rows`, each packed in one task with the longest first; a group of
    this size leaves about one sequence that a larger group would have filled. A null or negative length counts as 0;
    a row longer than the capacity has a sequence of its own. offset is the sum of the lengths before a row in its sequence.
    All columns of `pieces` pass through, but for its own sequence_id and offset. Repeated rows are packed one by one. No rows give
    none. The table is stored first, so the numbers that rows are dealt by stay the same if a task is repeated.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    size = F.greatest(F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)), F.lit(0))
    rows = store(pieces.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], size.alias("size"),
                               F.monotonically_increasing_id().alias("number")), "pieces")
    groups = max(1, -(-rows.count() // group_rows))

    def run(group: pa.Table) -> pa.Table:
        bins, offsets = best_fit_decreasing(group.column("size").to_numpy(), capacity)
        first = group.column("part")[0].as_py() << 32
        return pa.table({"number": group.column("number"), "sequence_id": pa.array(bins + first), "offset": pa.array(offsets)})

    part = F.pmod(F.xxhash64("number"), F.lit(groups)).cast("long")
    placed = rows.select("number", "size", part.alias("part")).groupBy("part").applyInArrow(run, "number long, sequence_id long, offset long")
    placed = store(placed, "placed").withColumnRenamed("number", "_number")
    return rows.join(placed, F.col("number") == F.col("_number")).select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids) from rows with ids, sequence_id and offset: the ids of each sequence, joined in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), parts.alias("_parts")).select(
        "sequence_id", "n_pieces", F.expr("aggregate(transform(_parts, p -> p.ids), CAST('' AS BINARY), (x, y) -> x || y)").alias("ids"))
