"""Exact quantiles equal a sort of each group, however few rows a pass may rank."""

import math
import random

import pytest

from pyspark.sql import functions as F

from eventmart.operators.quantiles import exact_quantile


@pytest.mark.parametrize("small,bins", [(0, 2), (3, 7), (200_000, 1024)])
def test_quantiles_equal_sorting(spark, small, bins):
    r = random.Random(5)
    given = [("a", r.choice([1.0, 1.5, 2.0, 1e300, -1e300, 1e-300])) for _ in range(90)] + [("b", r.gauss(0, 1)) for _ in range(41)]
    given += [("c", 7.0)] * 9 + [("d", None), ("d", float("nan")), (None, 3.0), (None, 4.0), ("e", -0.5)]
    df = spark.createDataFrame(given, "k string, v double")
    for q in (0.0, 0.5, 0.9):
        want = {}
        for k in ("a", "b", "c", None, "e"):
            values = sorted(v for g, v in given if g == k)
            want[k] = values[max(1, math.ceil(q * len(values))) - 1]
        out = exact_quantile(df, ["k"], F.col("v"), "m", q, small, bins).collect()
        assert len(out) == len(want) and {x.k: x.m for x in out} == want
    assert exact_quantile(df.where("false"), ["k"], F.col("v"), "m").count() == 0
