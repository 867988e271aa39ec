"""Exact quantiles against sorting, for values that resist equal bins."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import quantiles

RNG = random.Random(1)
CASES = {
    "few": [3, 1, 2], "one": [5], "equal": [7] * 1000, "none": [None, None], "empty": [], "mixed": [None, 1.5, -2.0, 1.5, None, 1e300, -1e300],
    "tail": [RNG.paretovariate(0.2) for _ in range(3000)], "close": [1 + i * 2**-52 for i in range(2000)], "spread": [RNG.choice([-1, 1]) * 10.0 ** RNG.randint(-300, 300) for _ in range(2000)],
    "counts": [min(50, int(RNG.expovariate(0.7))) for _ in range(4001)], "signs": [-0.0, 0.0, -1.0, 1.0], "extremes": [-1.7e308, 1.7e308, 0.0, 5e-324],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_as_by_sorting(spark, name):
    xs = CASES[name]
    df = spark.createDataFrame([(None if x is None else float(x),) for x in xs], "v double").repartition(3)
    own = sorted(float(x) for x in xs if x is not None)
    got = quantiles.select(quantiles.values_of(df, "v"), [0, len(own) // 2, len(own) - 1, len(own), -1], bins=16, few=20)
    assert got == ({0: own[0], len(own) // 2: own[len(own) // 2], len(own) - 1: own[-1]} if own else {})
    if name not in ("extremes", "spread"):
        want = [None] * 3 if not own else np.quantile(own, [0.1, 0.5, 0.99]).tolist()
        assert quantiles.quantiles(df, "v", [0.1, 0.5, 0.99], bins=64, few=8) == pytest.approx(want) or want == [None] * 3


def test_million_distinct_values_and_odd_ones(spark):
    df = spark.range(1_000_001).select((F.col("id") * 7919 % 1_000_001).alias("v"))
    assert quantiles.quantiles(df, "v", [0.5, 0.25]) == [500_000.0, 250_000.0]
    odd = spark.sql("SELECT explode(array(double('nan'), double('inf'), double('-inf'), 1d, 2d, 3d, null)) AS v")
    assert quantiles.quantiles(odd, "v", [0.5]) == [2.0]
