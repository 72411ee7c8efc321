"""Quality classifier with hierarchical empirical Bayes over sites."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import store, texts

TARGETS = ("quality", "toxic")
DENSE = 8


class Features(dict):
    """Hashed word features; numbers of words are kept while they are few."""

    def __init__(self, bits: int) -> None:
        self.size = 1 << bits

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        core = word.strip(b".,;:!?'\"()")
        self[word] = h = DENSE + xxhash.xxh3_64_intdigest(core) % self.size
        return h


def featurize(text: bytes, table: Features) -> tuple[np.ndarray, np.ndarray]:
    """(positions, values): a few dense measures of form, and the distinct words, weighted so that long texts don't shout."""
    ws = text.lower().split()
    n = max(1, len(ws))
    symbols = len(text) - len(text.translate(None, b"#$%&*+/<=>@[\\]^_`{|}~!?"))
    distinct = set(ws)
    dense = np.array([1.0, min(len(ws), 100) / 100, min(5.0, 10 * symbols / max(1, len(text))), len(distinct) / n, min(3.0, len(text) / n / 6),
                      min(1.0, 10 * sum(text.count(c) for c in b".!?\n") / n), float(len(distinct) < 0.3 * n), float(len(ws) < 20)])
    at = np.unique(np.fromiter((table[w] for w in distinct), dtype=np.int64, count=len(distinct)))
    return np.concatenate([np.arange(DENSE), at]), np.concatenate([dense, np.ones(at.size)])


def telling(at: np.ndarray, y: np.ndarray, size: int, least_z: float) -> np.ndarray:
    """Features that are much more or less frequent in one class than chance allows; measures of form always count.

    Without this, the many rare words tell the training rows apart, and nothing else.
    """
    n1, n0 = max(1, int((y > 0).sum())), max(1, int((y <= 0).sum()))
    label = y > 0
    in1, in0 = (np.bincount(a, minlength=size) for a in (at[0][label[at[1]]], at[0][~label[at[1]]]))
    share = (in1 + in0 + 1) / (n1 + n0 + 2)
    z = (in1 / n1 - in0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    out = np.abs(z) >= least_z
    out[:DENSE] = True
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, rounds: int = 100, penalty: float = 0.3, rate: float = 0.5,
        least_z: float = 5.0) -> np.ndarray:
    """Logistic regression on telling features by full-gradient steps with per-weight rates."""
    at, x = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [a.size for a, _ in rows])
    kept = telling((at, row), y, size, least_z)[at]
    at, x, row = at[kept], x[kept], row[kept]
    w, past = np.zeros(size), np.full(size, 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * w[at], minlength=len(rows)), -30, 30)))
        slope = np.bincount(at, x * (p - y)[row], minlength=size) + penalty * w
        past += slope * slope
        w -= rate * slope / np.sqrt(past)
    return w


def classifiers(docs: DataFrame, labels: DataFrame, sample: int, bits: int) -> dict[str, np.ndarray]:
    """Weights for quality and for toxic, fitted on at most `sample` labelled rows, chosen by a hash of doc_id."""
    labelled = labels.where("quality is not null and toxic is not null and doc_id is not null").select("doc_id", *TARGETS)
    n = labelled.count()
    picked = labelled.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1, sample / max(1, n)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Features(bits)
        for batch, found in texts(batches):
            both = [featurize(t, table) for t in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.astype(np.int32) for a, _ in both], pa.list_(pa.int32())),
                 pa.array([v[:DENSE] for _, v in both], pa.list_(pa.float64()))], [*TARGETS, "at", "dense"])

    joined = docs.select("doc_id", "text").join(picked, "doc_id").select(*TARGETS, "text")
    got = joined.mapInArrow(run, "quality int, toxic int, at array<int>, dense array<double>").toArrow()
    size = DENSE + (1 << bits)
    if not got.num_rows:
        return {t: np.zeros(size) for t in TARGETS}
    rows = [(np.asarray(a, dtype=np.int64), np.concatenate([d, np.ones(len(a) - DENSE)]))
            for a, d in zip(got["at"].to_numpy(), got["dense"].to_numpy())]
    return {t: fit(rows, got[t].to_numpy().astype(float), size) for t in TARGETS}


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def shrunk(stats: DataFrame, prior: Column, strength: Column, target: str) -> Column:
    """Posterior mean of a site's rate: its own evidence, and `strength` documents' worth of its parent's rate."""
    return (F.col(f"_s_{target}") + strength * prior) / (F.col("_n") + strength)


def site_quality(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, sample: int = 8_000, bits: int = 15,
    host_strength: float = 20.0, path_strength: float = 10.0, keep_at: float = 0.5,
) -> DataFrame:
    """(doc_id, host, path, p_quality, p_toxic, host_quality, path_quality, post_quality, post_toxic, kept) of every row.

    A classifier gives each document a probability for quality and for toxic. Sites are judged by grouped
    sums over all their documents: a host's rate is shrunk toward the global one, a path's toward its host's,
    as if `host_strength` or `path_strength` documents had been seen at the parent's rate, or more where
    sites differ little: the strength is estimated from the spread of the rates around their parent's (hosts around
    the global rate, paths around their host's; empirical Bayes by moments) and the parameter is its least value. A document's posterior odds are its own odds times
    those of its path against the global odds. kept: quality at least `keep_at` and toxic below it.

    Only the fit sees a sample (`sample` labelled rows at most, about); scores, sums and posteriors cover all
    rows. Null texts are empty; a null host or path is a site; without labels all probabilities are
    0.5. Equal rows get equal results. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    models = classifiers(docs, labels, sample, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Features(bits)
        for batch, found in texts(batches):
            p = {t: [] for t in TARGETS}
            for text in found:
                at, x = featurize(text, table)
                for t in TARGETS:
                    p[t].append(1 / (1 + np.exp(-np.clip((models[t][at] * x).sum(), -12, 12))))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in (0, 2, 3)] + [pa.array(p[t], pa.float64()) for t in TARGETS],
                                             ["doc_id", "host", "path", *(f"p_{t}" for t in TARGETS)])

    scored = store(docs.mapInArrow(run, "doc_id long, host string, path string, p_quality double, p_toxic double"), "scored")
    sums = [F.count("*").alias("_n"), *[F.sum(f"p_{t}").alias(f"_s_{t}") for t in TARGETS]]
    paths = store(scored.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("_n").alias("_n"), *[F.sum(f"_s_{t}").alias(f"_s_{t}") for t in TARGETS])
    total = hosts.agg(F.sum("_n").alias("n"), *[(F.sum(f"_s_{t}") / F.sum("_n")).alias(t) for t in TARGETS]).first()
    rate = {t: F.lit(min(max(total[t] if total[t] is not None else 0.5, 1e-4), 1 - 1e-4)) for t in TARGETS}

    def strength(stats: DataFrame, t: str, least: float) -> Column:
        """Beta prior's size by moments: how little the sites' rates spread, beyond what chance would give."""
        m, k = rate[t], F.col("_n")
        r = stats.agg((F.sum(k * F.pow(F.col(f"_s_{t}") / k - m, 2)) / F.sum(k)).alias("v"), (F.count("*") / F.sum(k)).alias("noise")).first()
        if r is None or r.v is None:
            return F.lit(least)
        spread = total[t] * (1 - total[t])
        between = r.v - spread * r.noise
        return F.lit(max(least, spread / between - 1 if between > spread * 1e-6 else 1e6))

    of_host = hosts.select(F.col("host").alias("_h"), F.col("_n").alias("_kh"), *[(F.col(f"_s_{t}") / F.col("_n")).alias(f"_r_{t}") for t in TARGETS])
    inside = paths.join(of_host, F.col("host") == F.col("_h"))

    def strength_inside(t: str, least: float) -> Column:
        """The same for paths, from their deviations from their own host's rate. A host of one path tells nothing."""
        k, r, free = F.col("_n"), F.col(f"_r_{t}"), 1 - F.col("_n") / F.col("_kh")
        x = inside.agg(F.sum(k * F.pow(F.col(f"_s_{t}") / k - r, 2)).alias("v"), F.sum(free * r * (1 - r)).alias("noise"),
                       F.sum(k * free).alias("scale"), (F.sum(k * r * (1 - r)) / F.sum(k)).alias("spread")).first()
        if x is None or x.v is None:
            return F.lit(least)
        between = (x.v - x.noise) / x.scale if x.scale > 0 else 0.0
        return F.lit(max(least, x.spread / between - 1 if between > x.spread * 1e-6 else 1e6))

    host_rate = hosts.select("host", *[shrunk(hosts, rate[t], strength(hosts, t, host_strength), t).alias(f"host_{t}") for t in TARGETS])
    by_path = paths.join(host_rate.withColumnRenamed("host", "_h"), F.col("host") == F.col("_h")).select(
        F.col("host").alias("_h"), F.col("path").alias("_p"), *[f"host_{t}" for t in TARGETS],
        *[shrunk(paths, F.col(f"host_{t}"), strength_inside(t, path_strength), t).alias(f"path_{t}") for t in TARGETS])
    rows = scored.join(by_path, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")))
    post = {t: 1 / (1 + F.exp(-(logit(F.col(f"p_{t}")) + logit(F.col(f"path_{t}")) - logit(rate[t])))) for t in TARGETS}
    return rows.select("doc_id", "host", "path", "p_quality", "p_toxic", "host_quality", "path_quality",
                       post["quality"].alias("post_quality"), post["toxic"].alias("post_toxic")).withColumn(
        "kept", (F.col("post_quality") >= keep_at) & (F.col("post_toxic") < keep_at))
