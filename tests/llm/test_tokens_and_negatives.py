"""Hard negatives, tokenizer alignment and packing against brute force, and on odd input."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventmart.llm import alignment, queries
from eventmart.llm.alignment import Aligner, align_tokenizers
from eventmart.llm.hardneg import Packed, hard_negatives
from eventmart.llm.packing import best_fit_decreasing, best_fit_pack, sequences, token_pieces
from eventmart.llm.tokens import file_bytes

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  two  blanks  ", "a\nb\n\n c \t d", "<|endoftext|> <|startoftext|>x", "café é  nbsp　wide", "piece ▁ mark",
       "\U0001f600 emoji\U0001f600s", "don't we'll I'm x's", "\x1c sep\x1dunit \x85 nel", "Σίσυφος ΟΔΟΣ straße 12345 1 2", "no" * 300, "word " * 400, " lead", "trail ",
       " og᠎m ham", "zero​width ﻿bom", "\x00nul \x00", "ﬁ ligature ½", "<0x41> <unk> <s> </s>"]


def negatives_by_force(rows, positives=5, negatives=5, percent=80):
    best = {}
    for i, v, lab in rows:
        if None in (i, v, lab) or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in best or (lab, v) < best[i]:
            best[i] = (lab, v)
    whole = {i: (lab, [math.floor(256 * x) if abs(x) < 2**44 else int(x) * 256 for x in v]) for i, (lab, v) in best.items()}

    def score(i, j):
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(whole[i][1], whole[j][1]))))

    out = set()
    for a in (i for i in whole if i % 10 == 0):
        scored = sorted(((-score(a, b), b) for b in whole if b != a))
        same = [(-s, b) for s, b in scored if whole[b][0] == whole[a][0]][:positives]
        for p, b in same:
            fit = [(-s, c) for s, c in scored if whole[c][0] != whole[a][0] and percent * p <= 100 * -s <= 100 * p][:negatives]
            out |= {(a, b, k, c, p, s) for k, (s, c) in enumerate(fit, 1)}
    return out


def vector_rows(seed, n=160, dims=6):
    r = random.Random(seed)
    rows = [(i, [r.choice([r.uniform(-1, 1), 0.5]) for _ in range(dims)], r.randrange(3)) for i in range(n)]
    rows += [(n + k, [0.5] * dims, k % 3) for k in range(40)]  # ties
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * dims, 0), (503, [float("inf")] * dims, 0), (None, [1.0] * dims, 0), (504, [1.0] * dims, None),
             (510, [0.4, 0.3], 1), (520, [], 2), (7, [9.0] * dims, 2), (7, [9.0] * dims, 2), (530, [0.2] * (dims + 3), 0)]
    return rows


@pytest.mark.parametrize("block", [16, 8192])
@pytest.mark.parametrize("huge", [False, True])
def test_hard_negatives_match_brute_force(spark, block, huge):
    rows = vector_rows(1) + ([(600, [1e30, -3.0], 0), (601, [2.0**40, 1.0], 1), (610, [3e9] * 6, 1)] if huge else [])
    d = spark.createDataFrame(rows, "vec_id long, vec array<double>, label int").withColumns({"rank": F.lit(1), "anchor_id": F.lit("x"), "c": F.lit(2)})
    out = [tuple(r) for r in hard_negatives(d, F.col("vec_id") % 10 == 0, block=block).collect()]
    assert len(out) == len(set(out)) > 100 and set(out) == negatives_by_force(rows)


def test_hard_negatives_of_nothing(spark):
    d = spark.createDataFrame(vector_rows(2), "vec_id long, vec array<double>, label int")
    assert hard_negatives(d.where("false"), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(d, F.lit(None).cast("boolean")).count() == 0
    assert hard_negatives(d.where("label = 1"), F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("largest", [0, 3, 700, 2**29, 2**50])
def test_packed_products_are_exact(largest):
    g = np.random.default_rng(4)
    rows, anchors = (g.integers(-largest, largest + 1, (n, 9)) for n in (37, 11))
    got = Packed(rows, largest, largest).scores(anchors)
    want = anchors.astype(object) @ rows.astype(object).T
    assert (got == np.clip(want, -(2**63), 2**63 - 1)).all()


@pytest.fixture(scope="module")
def tokenizers_ab():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def align_by_force(texts, a, b):
    """Whole texts tokenized at once, every pair of tokens of a text compared."""
    letters = {ord(c): c for c in map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)])}
    for x in range(256):
        letters.setdefault(x, chr(256 + sum(y not in range(33, 127) and y not in range(161, 173) and y not in range(174, 256) for y in range(x))))
    byte = {c: x for x, c in letters.items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for t in texts:
        docs.append(None)
        if not t:
            continue
        ids = [a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)]
        tokens = [[bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]]]
        if any(b"".join(x) != (" " + t).encode() for x in tokens):
            continue
        spans = []
        for side in tokens:
            ends = np.cumsum([len(x) for x in side]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends)))
        links = [(ids[0][i], ids[1][j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        said = ";".join("|".join(",".join(str(i) for i, (_, e) in zip(ids[k], spans[k]) if low < e <= high) for k in (0, 1)) for low, high in zip([0, *cuts], cuts))
        docs[-1] = (len(ids[0]), len(ids[1]), len(cuts), links, said)
    count = Counter(p for d in docs if d for p in set(d[3]))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if not d else (d[0], d[1], d[2], len(d[3]), sum(count[p] == top[p[0]] for p in d[3]), sum(count[p] for p in d[3]), d[4]) for d in docs]


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_alignment_matches_brute_force(spark, tokenizers_ab, broadcast_rows):
    given = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("n_chars").limit(120).collect()]
    texts = given + ODD + ODD[:4] + given[-2:]
    d = spark.createDataFrame([(None if i == 3 else i % 150, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string").withColumn("pairs", F.lit(1))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    want = align_by_force(texts, *tokenizers_ab)
    out = [tuple(r) for r in align_tokenizers(d, broadcast_rows=broadcast_rows).select("doc_id", *names).collect()]
    assert sorted(out, key=str) == sorted(((None if i == 3 else i % 150, *w) for i, w in enumerate(want)), key=str)
    digests = align_tokenizers(d, digest=True).select("groups").collect()
    assert sorted(r.groups for r in digests) == sorted(w[-1] and hashlib.sha256(w[-1].encode()).hexdigest() for w in want)
    assert align_tokenizers(d.where("false")).count() == 0


@pytest.mark.parametrize("digest", [False, True])
def test_alignment_in_windows(tokenizers_ab, monkeypatch, digest):
    texts = [t for t in ODD if t] + ["some longer text of words " * 50, "broken ▁ far on " + "x y " * 90 + "▁"]
    models = [file_bytes(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    whole = Aligner(*models, digest)
    want = [(x.n_a, x.n_b, x.n_groups, x.n_links, whole.groups(x), dict(zip(x.keys.tolist(), x.times.tolist()))) for x in whole.run(texts)]
    monkeypatch.setattr(alignment, "WINDOW", 24)
    cut = Aligner(*models, digest)
    assert [(x.n_a, x.n_b, x.n_groups, x.n_links, cut.groups(x), dict(zip(x.keys.tolist(), x.times.tolist()))) for x in cut.run(texts)] == want


def test_a_stretch_is_aligned_once(tokenizers_ab, monkeypatch):
    """Texts of words met before cost look-ups only; what was forgotten is learned again, with the same result."""
    models = [file_bytes(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    joined, join = [], alignment.pd.merge_asof
    monkeypatch.setattr(alignment.pd, "merge_asof", lambda left, *rest, **how: joined.append(len(left)) or join(left, *rest, **how))
    texts = ["some longer text, of words\nmet again and again " * 30 + f"é{k % 3}x" for k in range(60)]
    aligner = Aligner(*models, False)
    found = aligner.run(texts)
    assert found[0].n_a > 200 and sum(joined) < 100
    monkeypatch.setattr(alignment, "KEPT", 4)
    monkeypatch.setattr(alignment, "WINDOW", 100)
    again = Aligner(*models, False)
    said = [(x.n_a, x.n_b, x.n_groups, x.n_links, again.groups(x), x.keys.tolist(), x.times.tolist()) for x in again.run(texts)]
    assert said == [(x.n_a, x.n_b, x.n_groups, x.n_links, aligner.groups(x), x.keys.tolist(), x.times.tolist()) for x in found]
    assert len(again.known) < 100


def best_fit_by_force(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [(r, k) for k, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits)[1]] -= s
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 64, 2048])
    sizes = np.array([r.randint(0, max(1, capacity // r.choice([1, 2, 5]))) for _ in range(300)], dtype=np.int64)
    bins, offsets = best_fit_decreasing(sizes, capacity)
    load = Counter()
    for b, o, s in sorted(zip(bins.tolist(), offsets.tolist(), sizes.tolist())):
        assert o == load[b]
        load[b] += s
    assert sorted(capacity - x for x in load.values()) == best_fit_by_force(sizes.tolist(), capacity)
    assert best_fit_decreasing(np.array([5, 9, 3]), 8)[1].tolist() == [0, 0, 5]


def check_packed(rows, capacity):
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for x in inside.values():
        at = 0
        for o, n in sorted(x):
            assert o == at
            at += n
        assert at <= capacity
    return len(inside)


def test_token_pieces_and_packing(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*ODD, ODD[3], "word " * 5000, "é" * 3000]
    d = spark.createDataFrame([(None if i == 5 else i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, number string").withColumn("offset", F.lit(1))
    pieces = token_pieces(d)
    got = defaultdict(list)
    for r in pieces.collect():
        got[r.doc_id].append((r.piece, r.start, r.length, bytes(r.ids)))
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        cut = [ids[k : k + 2048] for k in range(0, len(ids), 2048)]
        assert sorted(got[None if i == 5 else i]) == [(k, 2048 * k, len(c), c.tobytes()) for k, c in enumerate(cut)]
    packed = best_fit_pack(pieces.withColumns({"number": F.lit("n"), "c0": F.lit(None)}), "length", group_rows=20)
    rows = packed.collect()
    assert packed.columns == [*pieces.columns, "number", "c0", "sequence_id", "offset"] and len(rows) == sum(map(len, got.values()))
    check_packed(rows, 2048)
    joined = {r.sequence_id: (r.n_pieces, bytes(r.ids)) for r in sequences(packed).collect()}
    for s, (n, ids) in joined.items():
        own = sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset)
        assert n == len(own) and ids == b"".join(bytes(r.ids) for r in own)
    assert token_pieces(d.where("false")).count() == best_fit_pack(pieces.where("false"), "length").count() == 0


def test_packing_of_odd_lengths(spark):
    d = spark.createDataFrame([(None,), (-3,), (0,), (8,), (9,), (4,), (4,)], "length int")
    rows = best_fit_pack(d, "length", capacity=8).collect()
    assert len(rows) == 7 and len({r.sequence_id for r in rows if (r.length or 0) > 0}) == 3


def test_registered_queries(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op13_best_fit_packing(spark, FOLDER).collect()
    want = {}
    for i, t in docs.items():
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want |= {(i, k): (2048 * k, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(ids[n : n + 2048] for n in range(0, len(ids), 2048))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert check_packed(rows, 2048) == len(best_fit_by_force([r.length for r in rows], 2048))
    out = queries.op12_token_alignment(spark, FOLDER)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and out.count() == len(docs)
    assert dict(queries.op11_hard_negatives(spark, FOLDER).dtypes)["rank"] == "int"
