"""Near duplicates: one-permutation MinHash with densification, banded buckets, stars in rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import components, empty, store, texts

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit numbers, order counts."""
    with np.errstate(over="ignore"):
        x = a * M1 + b
        x ^= x >> np.uint64(32)
        x *= M2
        x ^= x >> np.uint64(29)
    return x


class WordHashes(dict):
    """64-bit hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words, A-Z in lower case; a shorter text is one run."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(words))
    out = mix(h[: len(h) - size + 1], np.uint64(size))
    for k in range(1, size):
        out = mix(out, h[k : len(h) - size + 1 + k])
    return np.unique(out)


def set_key(found: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(found.tobytes()) if found.size else None


class OnePermutation:
    """`bands` * `rows` bins: a shingle's hash chooses its bin and is its value there; the smallest counts.

    An empty bin takes the value of the first filled bin in a random order of its own (optimal
    densification: bins are probed independently of each other, the same way in every document).
    """

    def __init__(self, bands: int, rows: int, seed: int = 5) -> None:
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(seed)
        self.probe = np.array([rng.permutation(self.bins) for _ in range(self.bins)])

    def buckets(self, found: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per band of a document's sorted shingle hashes."""
        at = ((found >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)  # grows with the hash
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        value, filled = np.zeros(self.bins, dtype=np.uint64), np.zeros(self.bins, dtype=bool)
        value[at[first]], filled[at[first]] = found[first], True
        if first.size < self.bins:
            empty = np.flatnonzero(~filled)
            probe = self.probe[empty]
            value[empty] = value[probe[np.arange(empty.size), filled[probe].argmax(axis=1)]]
        grid = value.reshape(self.bands, self.rows)
        out = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            out = mix(out, grid[:, k])
        return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sign(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, buckets) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, opm = WordHashes(), OnePermutation(bands, rows)
        for batch, found in texts(batches):
            n, keys, flat, ends = [], [], [], [0]
            for t in found:
                s = shingles(t, size, hashes)
                n.append(s.size)
                keys.append(set_key(s))
                if s.size:
                    flat.append(opm.buckets(s))
                ends.append(ends[-1] + bands * bool(s.size))
            values = signed(np.concatenate(flat)) if flat else np.empty(0, dtype=np.int64)
            buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), buckets],
                                             ["doc_id", "n_shingles", "set_key", "buckets"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, buckets array<long>")


def keyed_texts(docs: DataFrame, size: int) -> DataFrame:
    """(set_key, text), one text for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, found in texts(batches):
            keys = [set_key(shingles(t, size, hashes)) for t in found]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(1)], ["set_key", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "set_key binary, text string").where("set_key is not null")


def confirmed(pairs: DataFrame, held: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap enough; `held` has each document's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sides = [[x or b"" for x in batch.column(c).cast(pa.binary()).to_pylist()] for c in ("text_a", "text_b")]
            known: dict[bytes, np.ndarray] = {}
            keep = []
            for x, y in zip(*sides):
                if x not in known:
                    if len(known) > 8:
                        known.clear()
                    known[x] = shingles(x, size, hashes)
                p, q = known[x], shingles(y, size, hashes)
                both = np.intersect1d(p, q, assume_unique=True).size
                keep.append(100 * both >= percent * (p.size + q.size - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = held.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85, bands: int = 32, rows: int = 6) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text).

    Documents with equal shingle sets are one class, and its smallest doc_id stands for it. Two classes
    that share a bucket are candidates, and candidates are links if their full sets have
    100 * intersection >= percent * union. Candidates are compared in rounds, see `link_all`, until each
    pair of a bucket was compared, can't be alike by its sizes or its rarest shingles, or is in one component already.

    component_id is the smallest doc_id that links reach. An empty or null text links with nothing. A text
    of fewer words than `size` is one shingle. Rows with the same doc_id are one document. A null doc_id
    is never linked: component_id is null, kept is true. With the defaults two documents at the
    threshold share no bucket with a probability of about 3 in 10 million.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed_rows = store(sign(docs, size, bands, rows), "signatures")
    usable = signed_rows.where("set_key is not null and doc_id is not null")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    reps = usable.join(classes.withColumnRenamed("set_key", "_key"), (F.col("set_key") == F.col("_key")) & (F.col("doc_id") == F.col("rep")))
    # repeated rows give a class once; a doc_id with several texts keeps all of them
    reps = store(reps.select("rep", "set_key", "n_shingles", "buckets").dropDuplicates(["rep", "set_key"]), "classes")

    members = reps.select("rep", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high"), F.count("*").alias("_n"))
    shared = shared.where("_low <> _high").select("bucket", "_n")
    live = store(members.join(shared, "bucket"), "members")
    # a class that agrees with many on many bands is likely what the others were made from
    weight = live.groupBy("rep").agg(F.sum("_n").alias("weight"))
    touched = store(weight, "touched", signed_rows.count())
    texts_of = docs.join(touched.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    held = store(keyed_texts(texts_of, size).dropDuplicates(["set_key"]).join(reps.select("set_key", "rep"), "set_key").select("rep", "text"), "texts")
    rows_live = live.count()
    live = live.drop("_n").join(touched, "rep").select("bucket", "rep", "n_shingles", "weight", F.col("rep").alias("label"), F.lit(1).cast("long").alias("n_label"))
    return finish(signed_rows, classes, link_all(live, held, size, percent, rows=rows_live))


def rarity(held: DataFrame, size: int, slots: int) -> np.ndarray:
    """How many of the sets in (rep, text) hold a shingle, counted for `slots` slots that shingles share by hash.

    The array has `slots` entries whatever the input; it orders shingles and decides nothing by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(slots, dtype=np.int64)
        for _, found in texts(batches):
            at = np.concatenate([np.empty(0, dtype=np.uint64), *(shingles(t, size, hashes) for t in found)]) % np.uint64(slots)
            total += np.bincount(at.astype(np.int64), minlength=slots)
        used = np.flatnonzero(total)
        for k in range(0, used.size, 10_000):
            part = used[k : k + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], ["slot", "n"])

    counts = held.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(slots, dtype=np.int64)
    out[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    return out


def by_rare_shingles(live: DataFrame, held: DataFrame, size: int, percent: int, slots: int = 1 << 20) -> DataFrame:
    """The members of `live` dealt anew: into a group for each of the rarest shingles of their sets.

    With all shingles in one order, two sets with 100 * intersection >= percent * union share one of their first
    n - ceil(percent * n / 100) + 1. In an order of rarity, sets that have only widespread passages in common share none
    of these. `pos` is a shingle's place in the order: from the first one they share, two sets have no more than
    n - pos left to agree on. Groups of one are left out.
    """
    members = live.select("rep", "weight", "label", "n_label").distinct()
    picked = store(held.join(members.select("rep"), "rep", "left_semi"), "unsettled")
    order = rarity(picked, size, slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, found in texts(batches):
            keys, at, n, reps = [np.empty(0, dtype=np.uint64)], [], [], []
            for rep, t in zip(batch.column(0).to_pylist(), found):
                s = shingles(t, size, hashes)
                first = s.size + percent * s.size // -100 + 1
                count = order[(s % np.uint64(slots)).astype(np.int64)]
                keys.append(s[np.lexsort((s, count))[:first]])
                at.append(np.arange(first))
                n.append(np.full(first, s.size))
                reps.append(np.full(first, rep))
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), *(pa.array(np.concatenate([[], *x]).astype(np.int64)) for x in (reps, n, at))],
                                             ["bucket", "rep", "n_shingles", "pos"])

    rare = store(picked.select("rep", "text").mapInArrow(run, "bucket long, rep long, n_shingles long, pos long"), "rare")
    shared = rare.groupBy("bucket").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high")).where("_low <> _high").select("bucket")
    return store(rare.join(shared, "bucket", "left_semi").join(members, "rep"), "members")


def link_all(live: DataFrame, held: DataFrame, size: int, percent: int, fan: int = 16, rows: int | None = None) -> DataFrame:
    """(node, component) of the links among the members (bucket, rep, n_shingles, weight, label, n_label) of each bucket.

    In each round some members of a bucket, its centres, are compared with all others that are not in
    their component; then they leave the bucket, as all their pairs are settled. A bucket is done when what is
    left of it is in one component. After one round, in which most groups of copies become a component, the members
    left are dealt anew by the rarest shingles of their sets (see `by_rare_shingles`), so that texts with a
    passage in common that are not alike no longer meet. Rounds then take 1, `fan`, `fan` ** 2 ... centres, so there
    are few of them; members of small components go first, then those of great weight: a group around one
    original is one component after the first round, and what stands alone beside a group goes before the group. `rows` is the number of members, if known.
    """
    spark = live.sparkSession
    found, checked = empty(spark, "node long, component long"), empty(spark, "a long, b long")
    left, left_there = F.col("n_shingles") - F.col("pos"), F.col("c.n_shingles") - F.col("c.pos")
    near = (100 + percent) * F.least(left, left_there) >= percent * (F.col("n_shingles") + F.col("c.n_shingles"))  # else the sets can't be alike enough
    me, live = ["bucket", "rep", "n_shingles", "pos"], live.withColumn("pos", F.lit(0).cast("long"))
    centres, dealt_anew = 1, False
    while True:
        part = F.pmod(F.xxhash64("rep"), F.lit(centres))
        chosen = F.min(F.struct("n_label", (-F.col("weight")).alias("_w"), "rep", "n_shingles", "pos", "label")).alias("c")
        stars = store(live.groupBy("bucket", part.alias("_part")).agg(chosen).select("bucket", "c"), "centres", rows)
        pairs = live.join(stars, "bucket").where((F.col("label") != F.col("c.label")) & near).select(
            F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct()
        pairs = store(pairs.join(checked, ["a", "b"], "left_anti"), "pairs", rows)
        links = store(confirmed(pairs, held, size, percent), "links", pairs.count())
        checked = checked.union(pairs)
        n_links = links.count()
        if n_links:
            n_links += found.count()
            found = store(components(links.union(found.select(F.col("component").alias("a"), F.col("node").alias("b"))), n_links), "components", 2 * n_links)
        sizes = found.groupBy("component").agg(F.count("*").alias("_size"))
        names = found.join(sizes, "component").select(F.col("node").alias("rep"), "component", "_size")
        rest = live.drop("label", "n_label").join(stars.select("bucket", "c.rep", "c.n_shingles", "c.pos"), me, "left_anti").join(names, "rep", "left").select(
            *me, "weight", F.coalesce("component", "rep").alias("label"), F.coalesce("_size", F.lit(1).cast("long")).alias("n_label"))
        rest = store(rest, "rest", rows)
        several = rest.groupBy("bucket").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low <> _high").select("bucket")
        live = store(rest.join(several, "bucket", "left_semi"), "members", rows)
        rows = live.count()
        if not rows:
            return found
        if dealt_anew:
            centres *= fan
        else:
            live, dealt_anew = by_rare_shingles(live, held, size, percent), True
            rows = live.count()


def finish(signed_rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    rows = signed_rows.select("doc_id", "n_shingles", "set_key")
    rows = rows.join(classes.withColumnRenamed("set_key", "_key"), F.col("set_key") == F.col("_key"), "left")
    rows = rows.join(store(found, "components"), F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
