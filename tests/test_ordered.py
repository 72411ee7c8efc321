"""The skew-proof forms equal the plain ones."""

import random

import pytest
from conftest import at, rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.functions.columns import number_slice, time_slice
from eventmart.operators.asof import asof_interval_join, asof_join, bracket_join
from eventmart.operators.ordered import HotKeys, measure_hot_keys, number_globally, number_rows, running_sum, with_following, with_next, with_previous
from eventmart.operators.peers import peer_standing, percentile


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    data = [(i, rng.choice("aaaabc"), at(rng.choice([0, 1, 1, 2, 50, 3600, 7200, 90_000]) + rng.randrange(3)), rng.randrange(9))
            for i in range(600)]
    return spark.createDataFrame(data, "id bigint, k string, ts timestamp, v bigint").cache()


@pytest.mark.parametrize("limit", [0, 100, 10_000])
@pytest.mark.parametrize("step", [with_previous, with_next])
def test_neighbours(log, limit, step, tmp_path):
    order = ["ts", "id"]
    plain = step(log, ["k"], order, {"v": F.col("v"), "id": F.col("id")}, "n")
    hot = measure_hot_keys(log, ["k"], str(tmp_path / "hot"), limit)
    assert hot.count == {0: 3, 100: 2 if log.where("k='b'").count() > 100 or log.where("k='c'").count() > 100 else 1, 10_000: 0}[limit] or limit == 100
    for given in (limit, hot):
        cut = step(log, ["k"], order, {"v": F.col("v"), "id": F.col("id")}, "n", time_slice("ts", 60), given)
        assert rows(cut, "id", "n.id", "n.v") == rows(plain, "id", "n.id", "n.v")


def test_hot_keys_cover_finer_keys_only(spark):
    hot = HotKeys(spark.range(0).toDF("k"), ("k",), 0)
    assert hot.covers(["k", "slot"]) and not hot.covers(["slot"])


@pytest.mark.parametrize("limit", [0, 150, 10_000])
def test_running_sum_and_numbers(log, limit):
    w = W.partitionBy("k").orderBy("ts", "id").rowsBetween(W.unboundedPreceding, W.currentRow)
    plain = log.withColumn("s", F.sum("v").over(w)).withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("ts", "id")))
    cut = running_sum(log, ["k"], ["ts", "id"], F.col("v"), "s", time_slice("ts", 10), limit)
    cut = number_rows(cut, ["k"], ["ts", "id"], "n", time_slice("ts", 10), limit)
    assert rows(cut, "id", "s", "n") == rows(plain, "id", "s", "n")


def test_global_numbers(log):
    nulls = log.withColumn("k", F.when(F.col("k") != "b", F.col("k")))
    order = ["ts", "k", "id"]
    plain = nulls.withColumn("n", F.row_number().over(W.orderBy(*order)))
    for coarse in (time_slice("ts", 60), [time_slice("ts", 1), time_slice("ts", 10), time_slice("ts", 120)]):
        got = number_globally(nulls, order, coarse, ["ts", "k"], "n")
        assert rows(got, "id", "n") == rows(plain, "id", "n")


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    data = [(k, at(rng.randrange(90_000)), lv) for k in "ab" for lv in range(20)] + [("a", at(1), 90), ("a", at(1), 91)]
    return spark.createDataFrame(data, "k string, since timestamp, level int").cache()


@pytest.mark.parametrize("limit", [0, 150, 10_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_equals_brute_force(spark, log, history, limit, how):
    left = log.unionByName(spark.createDataFrame([(9001, None, at(5), 1), (9002, "a", None, 1), (9003, "b", None, 1)], log.schema))
    known = [tuple(r) for r in history.collect()]
    want = []
    for r in left.collect():
        best = max(((s, lv) for k, s, lv in known if k == r.k and r.ts and s <= r.ts), default=None)
        if best or how == "left":
            want.append((r.id, best[1] if best else None))
    got = asof_join(left, history, ["k"], "ts", "since", ["level"], how, tie="level", slice_seconds=1800, hot=limit)
    assert rows(got, "id", "level") == sorted(want, key=str)
    assert got.columns == [*left.columns, "level"]


def test_interval_form_agrees(log, history):
    w = W.partitionBy("k").orderBy("since", "level")
    spans = history.withColumn("until", F.coalesce(F.lead("since").over(w), F.lit("2100-01-01").cast("timestamp")))
    a = asof_interval_join(log, spans, ["k"], "ts", ["level"], valid_from="since", valid_to="until")
    b = asof_join(log, history, ["k"], "ts", "since", ["level"], tie="level")
    assert rows(a, "id", "level") == rows(b, "id", "level")


def test_bracket_bounds_are_inclusive(spark):
    caps = spark.createDataFrame([(1, 10, 50), (11, 20, 90)], "lo int, hi int, cap int")
    people = spark.createDataFrame([(1,), (10,), (11,), (20,), (21,), (0,)], "level int")
    assert rows(bracket_join(people, caps, "level", "lo", "hi"), "level", "cap") == [(1, 50), (10, 50), (11, 90), (20, 90)]


@pytest.mark.parametrize("limit", [0, 2_000_000])
def test_peer_standing_equals_counting(spark, limit):
    rng = random.Random(1)
    people = [(i, rng.choice("xy"), rng.randrange(12), rng.random() < 0.8) for i in range(60)] + [(60, "lonely", 3, True)]
    df = spark.createDataFrame(people, "id int, g string, score int, honest boolean")
    got = peer_standing(df, ["g"], "score", F.col("honest"), 3, limit)
    want = []
    for i, g, s, _ in people:
        peers = [p for p in people if p[1] == g and p[0] != i and p[3]]
        below = sum(p[2] < s for p in peers)
        want.append((i, below, len(peers), float(int(100 * below / len(peers) + 0.5)) if peers else None))
    assert rows(got.withColumn("p", percentile()), "id", "peers_below", "peer_count", "p") == sorted(want, key=str)


def test_number_slice_never_decreases(spark):
    df = spark.createDataFrame([(float(v),) for v in range(-20, 20)], "v double").withColumn("s", number_slice("v", 7))
    got = [r.s for r in df.orderBy("v").collect()]
    assert got == sorted(got)


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_following_rows_across_slices(spark, n):
    """Slices shorter than what is looked ahead, empty stretches, and a second key."""
    given = [("a", t, i) for i, t in enumerate([0, 0, 1, 7, 7, 7, 7, 20, 21, 22, 40])] + [("b", 3, 50), ("b", 9, 51)]
    df = spark.createDataFrame(given, "k string, t int, id int")
    piece = F.floor(F.col("t") / 2).cast("bigint")
    out = with_following(df, ["k"], ["t", "id"], {"id": F.col("id")}, n, "ahead", piece, 1)
    want = []
    for k, t, i in given:
        ids = [j for q, _, j in sorted(given, key=lambda r: (r[1], r[2])) if q == k]
        want.append((i, ids[ids.index(i) + 1:][:n]))
    assert sorted((r.id, [x.id for x in r.ahead]) for r in out.collect()) == sorted(want)
    plain = with_following(df, ["k"], ["t", "id"], {"id": F.col("id")}, n)
    assert sorted((r.id, [x.id for x in r.ahead]) for r in plain.collect()) == sorted(want)
