"""Each operator against brute force, and on null, empty, long, repeated and clashing input."""

import base64
import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventmart.llm import common, decontamination, divergence, licenses, neardup, spans, warc
from eventmart.llm.common import components, words_of
from eventmart.llm.decontamination import contaminated
from eventmart.llm.mixing import mix_sources, source_targets
from eventmart.llm.sharding import minimax_shards
from eventmart.llm.site_quality import site_quality
from eventmart.llm.substrings import substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, shard string, size string, taken int"
FOLDER = "/root/testdata/sf0.001"
rng = random.Random(3)


def prose(n, vocabulary=4000, seed=0):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" + ("." if r.random() < 0.1 else "") for _ in range(n))


def documents(spark, *texts, start=0):
    rows = [(start + i, t, "en", f"s{i % 3}", 0, None, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, white space only, a very long one, repeated rows, null ids, sources and languages."""
    long, body = prose(40_000, seed=1), prose(120, seed=2)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, body), (6, body), (6, body), (None, body), (None, None), (7, "Éa ß word")]
    d = spark.createDataFrame([(i, t, "en" if k % 2 else None, None if k == 5 else "s", 0, None, "x", "y", 1) for k, (i, t) in enumerate(rows)], DOCS)
    return d.coalesce(2)


def least_capacity(sizes, shards):
    def fits(c):
        used, room = 0, 0
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards
    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("blocks,shards", [(4, 5), (64, 3), (16384, 7)])
def test_sharding_is_minimax(spark, blocks, shards):
    rows = [(i, f"g{rng.randrange(60):02}", rng.choice([1, 5, 30, 200])) for i in range(300)]
    out = minimax_shards(spark.createDataFrame(rows, "doc_id long, grp string, bytes long"), "grp", "bytes", shards, ["doc_id"], blocks).collect()
    groups, of = Counter(), defaultdict(set)
    for r in out:
        groups[r.grp] += r.bytes
        of[r.grp].add(r.shard)
    load = Counter()
    for r in out:
        load[r.shard] += r.bytes
    assert len(out) == 300 and all(len(s) == 1 for s in of.values())
    assert max(load.values()) == least_capacity([groups[g] for g in sorted(groups)], shards) and max(load) < shards
    for s in load:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def test_sharding_odd_input(spark, odd):
    rows = odd.withColumn("g", F.sha2("text", 256)).withColumn("b", F.octet_length("text"))
    out = minimax_shards(rows, "g", "b", 4, ["doc_id"]).collect()
    assert len(out) == 10 and len({r.shard for r in out if r.text is None}) == 1 and all(0 <= r.shard < 4 for r in out)
    assert minimax_shards(rows.where("false"), "g", "b", 4, ["doc_id"]).count() == 0


def repeat_words(ws):
    c = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    return len({j for i in range(len(ws) - 2) if c[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)})


def test_base_measures():
    for t in ["", "a b c a b c", "x\nx\n \n \nx y\nX", "é#b $$\x0bc d \n é#b $$", " ".join(rng.choice("abc") for _ in range(60))]:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat_words(ws))
        assert divergence.base_measures(t.encode(), t.encode().split()) == want


def test_divergence_rules(spark, odd):
    junk = " ".join(w + "%%%" for w in prose(150, seed=9).split())
    d = documents(spark, *[prose(200, 300, seed=s) for s in range(40)], junk, "w1 " * 80, "short text")
    kept = {r.doc_id: r.kept for r in divergence.divergence_rules(d).collect()}
    assert [i for i, k in kept.items() if not k] == [40, 41, 42]
    out = divergence.divergence_rules(odd)
    assert out.count() == 10 and "shard" in out.columns and {r.doc_id: r.n_words for r in out.collect()}[1] == 0
    assert divergence.divergence_rules(odd.where("false")).count() == 0


def test_divergence_of_rare_languages(spark):
    """A rare language has its own reference, or none if it is too small; the share of all words doesn't matter."""
    def other(s, n):
        return " ".join(f"ñ{w}" for w in prose(n, 300, seed=s).split())

    junk = " ".join(w + "%%%" for w in other(9, 150).split())
    rows = [(i, prose(8000, 300, seed=i % 5), "en") for i in range(800)]
    rows += [(1000 + i, other(i, 200), "es") for i in range(40)] + [(1100, junk, "es")] + [(1200 + i, other(i, 200), "fr") for i in range(3)]
    rows += [(1300, other(1, 200), None)]
    got = {r.doc_id: r for r in divergence.divergence_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [i for i, r in got.items() if i >= 1000 and not r.kept] == [1100]
    assert all(got[i].word_distance is not None for i in range(1000, 1040))
    assert all(got[i].word_distance is None and got[i].class_distance is None for i in (1200, 1201, 1202, 1300))


def test_license_templates():
    a = licenses.compile_template("red <<beginOptional>>very <<beginOptional>>very<<endOptional>> big<<endOptional>> fox <<var;min=1;max=2>> end")
    for text, ok in [("red fox x end", 1), ("red very big fox x y end", 1), ("red very very big fox x end", 1), ("red fox end", 0),
                     ("red big fox x end", 0), ("red fox x y z end", 0)]:
        ws = text.encode().split()
        assert (a.longest(ws, 0) == len(ws)) == bool(ok), text


def test_license_scan(spark, odd):
    texts = ["Released under the MIT License.", "MIT license mit LICENSE", "gnu general public license, version 2", "x CC-BY y cc by-nc 4.0", "mitlicense"]
    out = licenses.license_scan(documents(spark, *texts)).collect()
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels) for r in sorted(out)] == [
        (1, 3, 3, "mit"), (2, 0, 2, "mit"), (1, 0, 0, "gpl"), (2, 1, 4, "cc-by"), (0, None, None, "")]
    assert sorted(out)[0].labels == "mit,mit-notice" and sorted(out)[2].labels == "gpl"
    assert licenses.license_scan(odd).count() == 10 and licenses.license_scan(odd.where("false")).count() == 0


def test_wand_finds_all_that_reach_the_threshold():
    items = [(i, prose(30, 80, seed=i).encode()) for i in range(150)]
    df = Counter(w for _, t in items for w in set(decontamination.words(t)))
    index = decontamination.Index(items, {w: 5 / n for w, n in df.items()}, 30, 16, 4)
    for q in range(20):
        terms = {index.number[w] for w in decontamination.words(prose(25, 80, seed=1000 + q).encode()) if w in index.number}
        scores = Counter()
        for t in terms:
            for e, s in zip(index.terms[t][0], index.terms[t][1]):
                scores[e] += s
        for threshold in (0.1, 0.4, 0.7):
            want = {e for e, s in scores.items() if s >= threshold}
            assert {e for e, _ in index.search(terms, threshold)} == want


def test_contamination(spark, odd):
    items = [(i, f"{prose(25, seed=100 + i)}. {prose(12, seed=200 + i)}") for i in range(30)] + [(30, None), (31, ""), (None, "lost item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    bodies = [prose(300, seed=300 + i) for i in range(20)]
    bodies[3] += " " + items[7][1].upper()
    bodies[8] = prose(50, seed=1) + " " + items[2][1] + " " + prose(400, seed=4) + items[9][1]
    bodies[11] += " " + " ".join(items[5][1].split()[:12])  # a part only
    for parts in (20_000, 10):
        got = contaminated(documents(spark, *bodies), bench, index_items=parts).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(3, 7), (8, 2), (8, 9)]
    assert contaminated(odd, bench).count() == 0 and contaminated(odd, bench.where("false")).count() == 0


def test_site_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fit, held = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    out = site_quality(docs, fit, F.col("source"), F.col("lang"))
    right = out.join(held, "doc_id").agg(F.avg((F.col("kept") == ((F.col("quality") == 1) & (F.col("toxic") == 0))).cast("double"))).first()[0]
    assert right >= 0.93, right
    assert out.count() == docs.count()
    assert out.where("path_quality < 0 or path_quality > 1").count() == 0
    assert site_quality(odd, labels.where("false"), F.col("source"), F.col("lang")).where("p_quality = 0.5").count() == 10
    assert site_quality(odd.where("false"), labels, F.col("source"), F.col("lang")).count() == 0


def test_span_dedup(spark, odd):
    shared = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen. Last of the shared ones here."
    out = {r.doc_id: r for r in spans.span_dedup(documents(spark, f"A first start here. {shared} Its own end.", f"Another begin. {shared}\nOther end now.",
                                                           "Nothing shared at all. Truly nothing. Not even this.")).collect()}
    assert out[0].n_removed == 0 and out[2].n_removed == 0
    assert out[1].text == "Another begin. Other end now." and (out[1].n_removed, out[1].n_spans) == (4, 1)
    got = spans.span_dedup(odd).collect()
    assert len(got) == 10 and [r.text for r in got if r.doc_id == 1] == [None] and [r.n_removed for r in got if r.doc_id == 5] == [0]
    assert [r.text for r in got if r.doc_id == 6] == ["", ""]
    assert spans.span_dedup(odd.where("false")).count() == 0


@pytest.mark.parametrize("passage", [
    " ".join(f"p{i}" for i in range(60)),
    " ".join(f"p{i}" + "." * (i in (17, 40)) for i in range(60)),
    " ".join(f"p{i}" + "." * (i in (12, 30, 47)) for i in range(60))])
def test_spans_find_a_passage_set_mid_sentence(spark, passage):
    """No, one and two whole sentences inside a repeated passage of 60 words."""
    texts = [f"{prose(20, seed=10 * k + 500).replace('.', '')} {passage} {prose(9 + k, seed=10 * k + 501).replace('.', '')}" for k in range(3)]
    got = sorted(spans.span_dedup(documents(spark, *texts)).collect())
    assert got[0].text == texts[0] and got[0].n_removed == 0
    for r, t in zip(got[1:], texts[1:]):
        left = r.text.split()
        assert r.n_spans == 1 and sum(w.startswith("p") for w in left) <= 35
        assert [w for w in left if w.startswith("w")] == [w for w in t.split() if w.startswith("w")]


def test_spans_of_short_and_unbroken_texts(spark):
    long = prose(3000, 10 ** 6, seed=12).replace(".", "")
    texts = [long, "Start " + long + " end", "one two three four five six seven eight nine ten eleven twelve thirteen"] + ["same " * 100]
    got = sorted(spans.span_dedup(documents(spark, *texts, texts[2])).collect())
    assert [r.text for r in got if r.doc_id in (0, 2, 4)] == [long, texts[2], ""]
    assert len(got[1].text.split()) <= 42 and got[1].text.startswith("Start ") and got[1].text.endswith("end")
    assert len(got[3].text.split()) >= 25  # the first occurrence stays whole


def brute_runs(text, size, min_words, long, reach):
    """(first word, word after the last, words) of each run, word by word."""
    hashes, ends, words = neardup.WordHashes(), [0], []
    for piece in spans.sentences(text.encode()):
        if w := piece.lower().split():
            words += w
            ends.append(len(words))
    cuts = set(ends)
    for a, b in zip(ends, ends[1:]):
        if b - a > reach:
            h = np.array([hashes[w] for w in words[a:b]], dtype=np.uint64)
            pairs = neardup.mix(h[:-1], h[1:]).tolist()
            cuts |= {a + 1 + min(range(k, k + reach), key=pairs.__getitem__) for k in range(len(pairs) - reach + 1)}
    cuts, out = sorted(cuts), []
    for k, a in enumerate(cuts):
        for b in cuts[k + 1:]:
            if b - a >= long or sum(a < e <= b for e in ends) >= size and b - a >= min_words:
                out.append((a, b))
                break
    if not out and len(words) >= min_words:
        out = [(0, len(words))]
    elif out and out[-1][1] < len(words):
        out.append((out[-1][0], len(words)))
    return [(a, b, tuple(words[a:b])) for a, b in out]


def test_repeated_spans_equal_brute_force(spark):
    r, texts = random.Random(21), []
    shared = [prose(r.choice([14, 30, 60, 90]), seed=50 + k) for k in range(6)]
    for k in range(40):
        parts = [prose(r.randrange(0, 60), seed=300 + k)] + r.sample(shared, r.randrange(0, 3)) + [prose(r.randrange(0, 20), seed=400 + k).replace(".", "")]
        texts.append(r.choice([" ", "\n"]).join(parts))
    texts += [texts[3], "", "again and again " * 40, "a. b. c. d. " * 9]
    at = defaultdict(list)
    for i, t in enumerate(texts):
        for a, b, words in brute_runs(t, 3, 12, 25, 13):
            at[words].append((i, a, b - 1))
    want = sorted(p for ps in at.values() for p in ps if p[0] != min(ps)[0] or p[1] > min(ps)[2])
    assert len(want) > 60 and sorted(tuple(x) for x in spans.repeated_spans(documents(spark, *texts).select("doc_id", "text")).collect()) == want


def test_join_hot_equals_a_join(spark):
    rows = spark.range(24_000).selectExpr("if(id < 11000, 0, id % 500) k", "id")
    keys = rows.groupBy("k").agg(F.count("*").alias("_n"), F.max("id").alias("top")).where("k % 2 = 0")
    got = spans.join_hot(rows, keys, ["k"])
    assert got.exceptAll(rows.join(keys.drop("_n"), "k")).isEmpty() and got.count() == rows.where("k % 2 = 0").count()


def brute_substrings(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = {j for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1 for j in range(i, i + length)}
        out.append((len(t), len(gone), sum(j - 1 not in gone for j in gone), bytes(c for j, c in enumerate(t) if j not in gone)))
    return out


@pytest.mark.parametrize("length,core,widths", [(200, 32, (16, 1)), (24, 4, (4, 1))])
def test_substring_dedup(spark, length, core, widths):
    base = [prose(150, 30 if length < 100 else 4000, seed=s) for s in range(12)]
    base += [base[0], base[1][:400] + "é" + base[1][400:], base[2][100:500] + base[3][50:380], "ab" * 400, "x" * 500 + base[4], "", None, "é" * 150, base[5][7:]]
    got = sorted(substring_dedup(documents(spark, *base), length, core, widths).collect())
    want = brute_substrings([(t or "").encode() for t in base], length)
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == want


def test_substring_dedup_odd_input(spark, odd):
    got = substring_dedup(odd).collect()
    assert len(got) == 10 and sum(r.n_removed == r.n_bytes > 200 for r in got) == 4  # body is there four times
    assert substring_dedup(odd.where("false")).count() == 0


def reshared(sizes, weights, share, epochs):
    left, target, open_ = share * sum(sizes.values()), {}, dict(zip(sizes, weights))
    while True:
        level = left / sum(open_.values())
        over = [s for s in open_ if level * open_[s] > epochs * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in open_.items()}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
            del open_[s]


def test_mixing(spark, odd):
    rows = [(i, rng.choice(["a", "b", "b", "b", "b", "c", None, "é"]), rng.randrange(0, 60)) for i in range(800)]
    d = spark.createDataFrame(rows, "doc_id long, source string, words long")
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    names = sorted(n for n in sizes if n is not None) + [None]
    want = reshared({n: sizes[n] for n in names}, [5, 2, 1, 5, 2], 1.5, 2)
    got = {r._source: r.target for r in source_targets(d, "source", "words", (5, 2, 1), 1.5, 2).collect()}
    assert got == pytest.approx(want)
    out = mix_sources(d, "source", F.col("words"), ["doc_id"]).collect()
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - want[s]) <= 30 for s in names)
    again = mix_sources(d.repartition(3), "source", F.col("words"), ["doc_id"]).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    assert mix_sources(odd, "source", words_of(F.col("text")), ["doc_id"]).count() == 10
    assert mix_sources(odd.where("false"), "source", words_of(F.col("text")), ["doc_id"]).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 100_000 + "end"
    rows = [(1, "http://a", "x"), (2, "http://b c\n", "y"), (3, None, "x"), (4, "u", None), (5, "u", ""), (6, "u", big), (7, "u", big), (8, "u", "z"),
            (8, "u", "z"), (None, "u", "x"), (None, None, "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(warc.round_trip(pages).collect(), key=lambda r: (r.page_id or 0, r.payload_bytes))
    keeper = {h or "": max((p for p, _, x in rows if (x or "") == (h or "") and p), default=None) for _, _, h in rows}
    want = []
    for p, _, h in sorted(rows, key=lambda r: (r[0] or 0, len(r[2] or ""))):
        b, k = (h or "").encode(), keeper[h or ""]
        first = k is None or p == k
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else k))
    assert [tuple(r) for r in got] == want
    folder = f"{tmp_path}/warc"
    files = warc.write_archives(warc.records(pages, "page_id", F.encode("html", "UTF-8"), F.col("url")), folder, max_bytes=1000)
    chunks = [r for r in warc.read_archives(files, folder).collect() if r.record_id == "<urn:record:7>"]
    data = b"".join(bytes(r.data) for r in sorted(chunks, key=lambda r: r.chunk_no))
    assert data == big.encode() and len(chunks) == 4 and max(r.n_bytes for r in chunks) == warc.CHUNK
    assert chunks[1].digest_so_far == base64.b32encode(hashlib.sha1(data[: 2 * warc.CHUNK]).digest()).decode()
    assert warc.round_trip(pages.where("false")).count() == 0


def linked(texts, size, percent):
    sets = []
    for t in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set())
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return [(len(s), p) for s, p in zip(sets, part)]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    texts = []
    for f in range(12):
        ws = prose(rng.choice([4, 15, 60, 200]), seed=f).split()
        for _ in range(rng.randrange(1, 14)):
            copy = list(ws)
            for _ in range(rng.randrange(0, max(1, len(ws) // 25) + 1)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10 ** 6)}"
            texts.append(" ".join(copy).upper() if rng.random() < 0.1 else "\n".join(copy))
    rng.shuffle(texts)
    texts += ["", None, "one", "One", "one two", "two one"]
    got = sorted(neardup.near_duplicates(documents(spark, *texts), size, percent).collect())
    want = linked(texts, size, percent)
    assert [(r.n_shingles, r.component_id) for r in got] == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_around_a_late_original(spark):
    """320 copies of a text, each like it but hardly like one another, and the text itself with the largest id."""
    r, original = random.Random(8), prose(400, seed=77).split()
    texts = []
    for _ in range(320):
        copy = list(original)
        for k in r.sample(range(0, 400, 4), 9):
            copy[k] = f"new{r.randrange(10 ** 9)}"
        texts.append(" ".join(copy))
    got = neardup.near_duplicates(documents(spark, *texts, " ".join(original))).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 321


def test_link_all_compares_each_pair_of_a_bucket(spark):
    """Links that no single centre gives: pairs, chains and lone members in one bucket."""
    r, texts = random.Random(4), []
    for _ in range(14):
        words = prose(100, seed=r.randrange(10 ** 6)).split()
        for _ in range(r.choice([1, 2, 5])):
            words = list(words)
            words[r.randrange(100)] = f"new{r.randrange(10 ** 9)}"
            words[r.randrange(100)] = f"new{r.randrange(10 ** 9)}"
            texts.append(" ".join(words))
    r.shuffle(texts)
    held = spark.createDataFrame(list(enumerate(texts)), "rep long, text string")
    live = held.selectExpr("1L as bucket", "rep", "98L as n_shingles", "1L as weight", "rep as label", "1L as n_label")
    got = dict(neardup.link_all(live, held, 3, 85).collect())
    assert [got.get(i, i) for i in range(len(texts))] == [p for _, p in linked(texts, 3, 85)]


def test_texts_with_a_passage_in_common_are_not_all_paired(spark, monkeypatch):
    """Pairs compared for texts that share a block but are not alike: in proportion to their number, and pairs of copies among them found."""
    made = {}
    for m in (60, 120):
        block = prose(120, 10 ** 6, seed=3)
        texts = [block + " " + prose(60, 10 ** 6, seed=100 + k) for k in range(m)]
        texts += [t + " end" for t in texts[:10]]
        seen = []
        confirmed = neardup.confirmed
        with monkeypatch.context() as mp:
            mp.setattr(neardup, "confirmed", lambda pairs, *rest: (seen.append(pairs.count()), confirmed(pairs, *rest))[1])
            got = sorted(neardup.near_duplicates(documents(spark, *texts), 3, 85).collect())
        assert [r.component_id for r in got] == [*range(m), *range(10)] == [p for _, p in linked(texts, 3, 85)]
        made[m] = sum(seen)
    assert made[60] < 60 * 20 and made[120] < 3 * made[60], made


def test_small_tables_of_the_rounds_are_few_files(spark, monkeypatch):
    """However many partitions a round's tables are made in; each file costs its writer time and child processes."""
    stored, store = [], common.store

    def noted(df, name, *rows):
        stored.append((name, out := store(df, name, *rows)))
        return out

    r, texts = random.Random(6), []
    for k in range(60):
        words = prose(100, 10 ** 6, seed=k).split()
        for _ in range(3):
            words[r.randrange(100)] = f"new{r.randrange(10 ** 9)}"
            texts.append(" ".join(words))
    monkeypatch.setattr(common, "store", noted)
    monkeypatch.setattr(neardup, "store", noted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = sorted(neardup.near_duplicates(documents(spark, *texts)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r.component_id for r in got] == [p for _, p in linked(texts, 3, 85)]
    small = [(name, len(t.inputFiles())) for name, t in stored if name in ("touched", "centres", "pairs", "links", "edges", "rest")]
    assert len(small) > 6 and max(n for _, n in small) <= spark.sparkContext.defaultParallelism, small


def test_stages_send_texts_in_small_batches(spark):
    """Batches of 10,000 texts, whatever their length, were held several times by each executor."""
    key, lines = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(3000).select(F.repeat(F.lit("abcd"), 1000).alias("text")).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        spark.conf.unset(key)
        stage(spark, docs, FOLDER)
        got = lines.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 4_300_000, (name, got)
    for mine in ("1m", "70000"):  # a lower limit of the user's stays
        spark.conf.set(key, mine)
        common.small_batches(spark)
        assert spark.conf.get(key) == mine
    spark.conf.unset(key)


def test_reference_counts_leave_in_small_batches():
    texts = [" ".join(f"w{i}" for i in range(25_000)), "w1 w2 w2", None]
    got = list(divergence.tally()(iter([pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en", "en", None])], ["text", "lang"])])))
    counts = {(r["lang"], r["token"]): r["n"] for b in got for r in b.to_pylist() if r["kind"] == "word"}
    assert max(b.num_rows for b in got) <= 10_000
    assert len(counts) == 25_000 and counts["en", b"w2"] == 3 and counts["en", b"w1"] == 2 and counts["en", b"w24999"] == 1


def test_empty_tables_need_no_python_workers(spark, monkeypatch):
    """A table made from an empty list is made by Python workers, with a daemon of their own beside that of the Arrow batches."""
    docs, bench = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "benchmark"))
    expected = sorted(contaminated(docs, bench).collect()), sorted(neardup.near_duplicates(docs).collect())

    def refuse(*_, **__):
        raise AssertionError("made from a list")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert (sorted(contaminated(docs, bench).collect()), sorted(neardup.near_duplicates(docs).collect())) == expected
    none = common.empty(spark, "a long, b string")
    assert none.dtypes == [("a", "bigint"), ("b", "string")] and none.count() == 0


def test_near_duplicates_odd_input(spark, odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == 10 and all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert {r.component_id for r in got if r.doc_id == 6} == {5}
    assert neardup.near_duplicates(odd.where("false")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100}


def test_pipeline_stages(spark, odd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        assert docs.columns == before.columns and 0 < docs.count()
        if name != "mixing":
            assert docs.count() <= before.count()
            if name == "near duplicates":
                groups = linked([r.text for r in before.orderBy("doc_id").collect()], 5, 80)
                assert docs.count() == len({p for _, p in groups})
    out = corpus_pipeline.shard(spark, docs, FOLDER)
    assert out.count() == docs.count() and out.where("shard < 0 or shard > 39").count() == 0
    for name, stage in corpus_pipeline.STAGES:  # odd rows, and columns that clash
        rows = stage(spark, odd, FOLDER)
        assert rows.count() <= 20 and (name == "sharding" or rows.columns == odd.columns)
        assert stage(spark, odd.where("false"), FOLDER).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_leaks_of_small_and_repetitive_benchmarks(spark, n):
    """Every word weighs something: few items, and one text under most ids, are found like any other."""
    texts = [f"Question: {prose(12, seed=50 + k)} Answer: {prose(6, seed=90 + k)}" for k in range(min(n, 3))]
    items = [(k, texts[min(k, len(texts) - 1)]) for k in range(n)] + [(None, texts[0])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, prose(80, seed=7) + " " + texts[0] + " " + prose(80, seed=8), prose(200, seed=9), texts[-1])
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert got == {(0, k) for k, t in items[:-1] if t == texts[0]} | {(2, k) for k, t in items[:-1] if t == texts[-1]}


CLASHING = ["_size", "_one", "_size_end", "_shard", "_bpart", "_b__size_base", "_in__size", "row", "one", "size", "of", "first", "key",
            "_key", "_source", "size_end", "one_end", "_part", "_t_size", "_in_size", "_b_of", "_b_size_base", "end",
            "ref_lang", "ref_classes", "ref_words", "ref_counts", "c0", "c1", "a.b"]


def test_columns_of_any_name_are_carried(spark):
    """op1, op2 and op8 leave columns alone that are named like their own ones inside."""
    body = prose(300, seed=8)
    rows = [(i, f"{body} x{i}", "en", "st"[i % 2], f"g{i // 2}", 10 + i, *[f"{c}{i}" for c in CLASHING]) for i in range(12)]
    names = ["doc_id", "text", "lang", "source", "grp", "bytes", *CLASHING]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, grp string, bytes long, " + ", ".join(f"`{c}` string" for c in CLASHING))
    for out, replaced in [(minimax_shards(d, "grp", "bytes", 3, ["doc_id"]), []), (divergence.divergence_rules(d), []),
                          (mix_sources(d, "source", F.length("text"), ["doc_id"]), ["size"])]:
        got = {r.doc_id: r for r in out.collect()}
        assert len(got) == 12 and len(set(out.columns)) == len(out.columns)
        for row in rows:
            assert all(got[row[0]][c] == x for c, x in zip(names, row) if c not in replaced)
    assert {r.shard for r in minimax_shards(d.withColumn("shard", F.lit("mine")), "grp", "bytes", 3, ["doc_id"]).collect()} == {0, 1, 2}


def test_license_places_equal_brute_force():
    """Phrases at every place of a text of many of them; the work grows with the text, not with its square."""
    words = [rng.choice("mit license cc by gnu general public apache a".split()) for _ in range(4000)]
    starts = [(i, label) for i in range(len(words)) for phrase, label in licenses.PHRASES.items()
              if words[i : i + phrase.count(" ") + 1] == phrase.split()]
    n_words, n, first, last, base, *_ = licenses.scan("-".join(words).upper().encode(), {})
    assert (n_words, n) == (4000, len(starts)) and (first, last) == (starts[0][0], starts[-1][0])
    assert base == ",".join(sorted({x[1] for x in starts}))
    began = time.process_time()
    assert licenses.scan(b"mit license " * 200_000, {})[1] == 200_000  # four minutes if counted from the start each time
    assert time.process_time() - began < 20


def plain_strength(groups, least):
    """Of sites given as (n, sum, n of the parent, rate of the parent)."""
    n = sum(g[0] for g in groups)
    spread = sum(k * r * (1 - r) for k, _, _, r in groups) / n
    noise = sum((1 - k / kp) * r * (1 - r) for k, _, kp, r in groups)
    scale = sum(k * (1 - k / kp) for k, _, kp, _ in groups)
    between = (sum(k * (s / k - r) ** 2 for k, s, _, r in groups) - noise) / scale if scale else 0
    return max(least, spread / between - 1 if between > spread * 1e-6 else 1e6)


def test_site_levels_equal_a_plain_computation(spark):
    """Hosts that differ, and paths that differ within some of them: paths are shrunk toward their own host's rate."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    good = labels.select(F.col("doc_id").alias("_d"), F.coalesce("quality", F.lit(0)).alias("_q"))
    placed = docs.join(good, F.col("doc_id") == F.col("_d"), "left").select(
        "doc_id", "text", F.when((F.col("doc_id") % 3 == 0) | (F.col("_q") == 0), "poor").otherwise("rich").alias("site"),
        F.when(F.col("_q") == 0, F.lit("bad")).otherwise(F.concat(F.lit("p"), (F.col("doc_id") % 4).cast("string"))).alias("dir"))
    rows = site_quality(placed, labels, F.col("site"), F.col("dir")).collect()
    rate = sum(r.p_quality for r in rows) / len(rows)
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r.host].append(r.p_quality)
        paths[r.host, r.path].append(r.p_quality)
    m = sum(len(v) * (sum(v) / len(v) - rate) ** 2 for v in hosts.values()) / len(rows)
    between = m - rate * (1 - rate) * len(hosts) / len(rows)
    at_host = max(20.0, rate * (1 - rate) / between - 1 if between > rate * (1 - rate) * 1e-6 else 1e6)
    host_rate = {h: (sum(v) + at_host * rate) / (len(v) + at_host) for h, v in hosts.items()}
    at_path = plain_strength([(len(v), sum(v), len(hosts[h]), sum(hosts[h]) / len(hosts[h])) for (h, _), v in paths.items()], 10.0)
    assert at_path < 1e5
    for r in rows:
        v = paths[r.host, r.path]
        assert r.host_quality == pytest.approx(host_rate[r.host], rel=1e-6)
        assert r.path_quality == pytest.approx((sum(v) + at_path * host_rate[r.host]) / (len(v) + at_path), rel=1e-6)
    found = {(r.host, r.path): r.path_quality for r in rows}
    assert found["poor", "bad"] < min(x for k, x in found.items() if k[1] != "bad")
