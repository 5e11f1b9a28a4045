import math
import random

import numpy as np
import pytest

from casewatch.operators import long_trend as L
from casewatch.operators import statistics as A

POINTS = "series string, at long, value double"


def pair_sum(values):
    v = np.asarray(values, float)
    return int(sum(np.sign(v[j] - v[:j]).sum() for j in range(len(v))))


def result(spark, series, **options):
    rows = [(name, i, v) for name, values in series.items() for i, v in enumerate(values)]
    random.Random(0).shuffle(rows)
    return {r["series"]: r for r in L.long_trend(spark.createDataFrame(rows, POINTS).repartition(3), **options).collect()}


def sample():
    rng = random.Random(1)
    return {
        "ties": [float(rng.randrange(5)) for _ in range(700)],
        "hot": [1.0 if rng.random() < 0.4 else rng.random() * 2 for _ in range(900)],
        "rising": [i + rng.gauss(0, 40) for i in range(400)],
        "falling": [-float(i) for i in range(120)],
        "equal": [2.0] * 50, "two": [1.0, 2.0], "one": [1.0], "gaps": [None, 3.0, None, 1.0, 2.0, 0.0],
    }


@pytest.mark.parametrize("block", [L.BLOCK, 200, 37])
def test_s_is_the_sum_over_all_pairs(spark, block):
    series = sample()
    got = result(spark, series, block=block)
    for name, values in series.items():
        known = [v for v in values if v is not None]
        n, s = len(known), pair_sum(known)
        assert got[name]["n"] == n and got[name]["s_statistic"] == (s if n >= 3 else None), name
        if n < 3:
            assert got[name]["trend"] == "short"
            continue
        ties = sum(g * (g - 1) * (2 * g + 5) for g in (known.count(v) for v in set(known)))
        for column, less in (("p_value", 0), ("tied_p_value", ties)):
            variance = (n * (n - 1) * (2 * n + 5) - less) / 18
            z = (s - np.sign(s)) / math.sqrt(variance) if variance and s else 0.0
            assert got[name][column] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-6, abs=1e-12), (name, column)
    assert (got["rising"]["trend"], got["falling"]["trend"], got["equal"]["trend"]) == ("up", "down", "none")


def test_agrees_with_the_test_of_short_series(spark):
    rng = random.Random(2)
    rows = [(f"s{k}", i, float(rng.randrange(4, 12) + i * k // 9)) for k in range(12) for i in range(30)]
    series = spark.createDataFrame(rows, POINTS)
    short = {r["series"]: r for r in A.mann_kendall(series.selectExpr("series", "date_add(date'2020-01-01', cast(at as int)) as month_end", "value")).collect()}
    for r in L.long_trend(series, block=50).collect():
        assert r["s_statistic"] == short[r["series"]]["s_statistic"] and round(r["p_value"], 9) == round(short[r["series"]]["p_value"], 9)


def test_a_long_series_in_blocks(spark):
    n = 400_000
    points = spark.range(n).selectExpr("'x' as series", "id as at", "cast(pmod(xxhash64(id), 1000) + id / 2000 as double) as value")
    row = L.long_trend(points, block=1 << 14).first()
    values = np.array([r["value"] for r in points.orderBy("at").collect()])
    assert row["n"] == n and row["s_statistic"] == L.signed_pairs(values, np.ones(n, np.int64))


def test_no_points(spark):
    assert L.long_trend(spark.createDataFrame([], POINTS)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_signed_pairs_with_weights(seed):
    rng = np.random.default_rng(seed)
    v, w = rng.integers(0, 9, 60), rng.integers(1, 5, 60)
    assert L.signed_pairs(v, w) == sum(int(w[i] * w[j] * np.sign(v[j] - v[i])) for j in range(60) for i in range(j))
