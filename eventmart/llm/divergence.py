"""Quality rules: how far a document's character classes and common words lie from its language's."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import store, texts

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
# character classes of UTF-8 text; what is in none of them counts as "other"
CLASSES = {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789", "space": SPACE,
    "stop": b".,;:!?'\"()-", "symbol": b"#$%&*+/<=>@[\\]^_`{|}~", "wide": bytes(range(0x80, 0x100)),
}
CONTINUATION = bytes(range(0x80, 0xC0))
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def count_of(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def class_counts(text: bytes) -> list[int]:
    return [count_of(text, chars) for chars in CLASSES.values()]


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    n, covered, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def base_measures(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return (len(words), len(text.translate(None, SPACE + CONTINUATION)), count_of(text, SYMBOLS),
            len(lines) - len(set(lines)), repeat_words(words))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts from the same row of the other; empty rows: 0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / p.sum(1, keepdims=True), q / q.sum(1, keepdims=True)
        m = (p + q) / 2
        parts = [np.nansum(np.where(x > 0, x * np.log2(x / m), 0), axis=1) for x in (p, q)]
    return np.sqrt(np.clip(np.nan_to_num((parts[0] + parts[1]) / 2), 0, 1))


def tally(flush_at: int = 200_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partial counts (lang, kind, token, n) of a task; it never holds more than about `flush_at` entries."""

    def rows(held: dict[str, Counter], classes: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = chain(((lang, "word", w, n) for lang, c in held.items() for w, n in c.items()),
                    ((lang, "class", name.encode(), int(n)) for lang, c in classes.items() for name, n in zip(CLASSES, c) if n))
        while part := list(islice(out, 10_000)):
            cols = list(zip(*part))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.int64())], ["lang", "kind", "token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        for batch, found in texts(batches):
            for text, lang in zip(found, batch.column("lang").to_pylist()):
                lang = lang or ""
                held.setdefault(lang, Counter()).update(text.lower().split())
                classes[lang] = classes.get(lang, 0) + np.array(class_counts(text), dtype=np.int64)
                if sum(map(len, held.values())) > flush_at:
                    yield from rows(held, classes)
                    held, classes = {}, {}
        yield from rows(held, classes)

    return run


def references(docs: DataFrame, top_words: int, min_reference_words: int) -> DataFrame:
    """(ref_lang, ref_classes, ref_words, ref_counts): class counts, common words and their counts (with "" for the rest) of each language.

    They are counted over all rows. A language of fewer than `min_reference_words` words has none, whatever its share.
    """
    counts = store(docs.select("text", "lang").mapInArrow(tally(), "lang string, kind string, token binary, n long")
                   .groupBy("lang", "kind", "token").agg(F.sum("n").alias("n")), "reference-counts")
    words = F.sum(F.when(F.col("kind") == "word", F.col("n")).otherwise(0))
    large = counts.groupBy("lang").agg(words.alias("_all")).where(F.col("_all") >= max(1, min_reference_words))
    large = large.select(F.col("lang").alias("_l"), "_all")
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "token")
    top = counts.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= max(top_words, len(CLASSES)))
    top = top.join(large, F.col("lang") == F.col("_l")).drop("_l")  # after the ranking, so that few rows of a language meet
    word = (F.col("kind") == "word") & (F.col("_rank") <= top_words)
    # at most top_words + 8 rows of a language meet
    both = top.groupBy(F.col("lang").alias("ref_lang")).agg(
        F.max("_all").alias("_all"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "class", F.struct(F.col("token").cast("string"), "n")))).alias("_classes"),
        F.array_sort(F.collect_list(F.when(word, F.struct("_rank", "token", "n")))).alias("_words"))
    common = F.col("_words.n")
    rest = F.col("_all") - F.aggregate(common, F.lit(0).cast("long"), lambda x, y: x + y)  # words that aren't common
    return store(both.select(
        "ref_lang", F.array(*[F.coalesce(F.col("_classes")[c], F.lit(0).cast("long")) for c in CLASSES]).alias("ref_classes"),
        F.concat(F.col("_words.token"), F.array(F.lit(b""))).alias("ref_words"), F.concat(common, F.array(rest)).alias("ref_counts")), "references")


def divergence_rules(
    docs: DataFrame, top_words: int = 100, min_reference_words: int = 5000, max_class_distance: float = 0.33,
    max_word_distance: float = 0.45, min_chars: int = 200, min_words: int = 50, max_repeat_pct: int = 50,
) -> DataFrame:
    """Add base measures, `class_distance`, `word_distance`, `base_failed` and `kept` to (text, lang, ...).

    The language references are counted over all rows. A distance is judged only where the text has
    enough to judge: at least `min_chars` bytes for classes, 2 * `min_words` words for words; and where
    its language has at least `min_reference_words` words in all, which doesn't depend on what else the corpus
    holds. Elsewhere it is null and speaks for keeping. Base rules: fewer than `min_words` words, or more than
    `max_repeat_pct` per cent of the words in repeated 3-word windows, fail.

    A null or empty text has no words and fails the base rules. Rows without a language
    are one language. Every row is judged by itself: equal rows get equal results. Columns of
    the same names are replaced; others may have any name, as they are numbered inside. An empty table gives an empty result.
    """
    added = [*(x.split()[0] for x in BASE.split(", ")), "class_distance", "word_distance", "base_failed", "kept"]
    kept_columns = [c for c in docs.columns if c not in added]
    ref = references(docs, top_words, min_reference_words)
    own_names = [f"c{k}" for k in range(len(kept_columns))]
    text_name, lang_name = (own_names[kept_columns.index(c)] for c in ("text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[int], dict[bytes, int], np.ndarray]] = {}  # references of the languages met last
        for batch, found in texts(batches, text_name):
            base, cls, cls_ref, word_d = [], [], [], []
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("ref_lang", "ref_classes", "ref_words", "ref_counts")]
            for k, (text, lang) in enumerate(zip(found, own[0].to_pylist())):
                if lang is not None and lang not in held:
                    if len(held) > 500:
                        held.clear()
                    c, w, n = (x[k].as_py() for x in own[1:])
                    held[lang] = c, {x: i for i, x in enumerate(w)}, np.array(n, dtype=float)
                words = text.split()
                base.append(base_measures(text, words))
                cls.append(class_counts(text) if len(text) >= min_chars and lang is not None else [0] * len(CLASSES))
                cls_ref.append(held[lang][0] if lang is not None else [1] * len(CLASSES))
                if len(words) >= 2 * min_words and lang is not None:
                    _, index, expected = held[lang]
                    at = Counter(map(index.get, text.lower().split()))
                    row = np.zeros((1, len(index)))
                    for i, n in at.items():
                        row[0, -1 if i is None else i] += n
                    word_d.append(float(js_distance(row, expected[None])[0]))
                else:
                    word_d.append(None)
            if not base:
                continue
            class_d = js_distance(np.array(cls, dtype=float), np.array(cls_ref, dtype=float))
            class_d = [float(x) if sum(c) else None for x, c in zip(class_d, cls)]
            failed = [n < min_words or 100 * r > max_repeat_pct * n for n, _, _, _, r in base]
            kept = [not f and (c is None or c <= max_class_distance) and (w is None or w <= max_word_distance)
                    for f, c, w in zip(failed, class_d, word_d)]
            new = [*(pa.array(x, pa.int64()) for x in zip(*base)), pa.array(class_d, pa.float64()),
                   pa.array(word_d, pa.float64()), pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())]
            old = [batch.column(batch.schema.get_field_index(c)) for c in own_names]
            yield pa.RecordBatch.from_arrays([*old, *new], [*kept_columns, *added])

    docs = docs.select(*[f"`{c}`" for c in kept_columns])
    known = docs.toDF(*own_names).join(ref, F.coalesce(lang_name, F.lit("")) == F.col("ref_lang"), "left")
    new = T.StructType.fromDDL(f"{BASE}, class_distance double, word_distance double, base_failed boolean, kept boolean")
    return known.mapInArrow(run, T.StructType([*docs.schema.fields, *new.fields]))
