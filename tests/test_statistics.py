import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from casewatch.functions.quantiles import exact_quantiles, weighted_quantiles
from casewatch.functions.tails import f_upper, incomplete_beta, normal_two_sided, t_two_sided
from casewatch.operators import statistics as A
from casewatch.plans.sample_queries import BASELINES, SampleTables
from tests.frames import series, wide


def test_tails_closed_forms(spark):
    rows = spark.createDataFrame([(0.5,), (2.0,), (-12.7,)], "t double").select(
        "t",
        t_two_sided("t", F.lit(1.0)).alias("t1"), t_two_sided("t", F.lit(2.0)).alias("t2"), t_two_sided("t", F.lit(1e7)).alias("tn"),
        normal_two_sided("t").alias("z"), f_upper(F.col("t") * F.col("t"), F.lit(1.0), F.lit(7.0)).alias("f"), t_two_sided("t", F.lit(7.0)).alias("t7"),
    ).collect()
    for r in rows:
        assert r.t1 == pytest.approx(1 - 2 / math.pi * math.atan(abs(r.t)), abs=1e-13)
        assert r.t2 == pytest.approx(1 - abs(r.t) / math.sqrt(2 + r.t**2), abs=1e-13)
        assert r.tn == pytest.approx(r.z, abs=1e-6)
        assert r.z == pytest.approx(math.erfc(abs(r.t) / math.sqrt(2)), rel=1e-12)
        assert r.f == pytest.approx(r.t7, rel=1e-10)  # F(1, n) is the square of t(n)
    assert incomplete_beta(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert spark.range(1).select(t_two_sided(F.lit(None).cast("double"), F.lit(3.0)).alias("p")).first().p is None


def test_welch_against_formula(spark):
    a, b = [3.0, 5.0, 9.0, 11.0], [10.0, 14.0, 13.0]
    df = wide(spark, *[(1, {"resolution_days": v}) for v in a], *[(1, {"resolution_days": v, "bank_type": "Private Sector"}) for v in b],
              (1, {"resolution_days": None}))
    row = A.welch_t(df).first()
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 3
    assert row.t_statistic == round((np.mean(a) - np.mean(b)) / math.sqrt(va + vb), 4)
    assert row.df == pytest.approx((va + vb) ** 2 / (va**2 / 3 + vb**2 / 2))
    assert not row.reject_null and "between public and private sector banks (p-value >= 0.05)" in row.interpretation
    wide_gap = wide(spark, *[(5, {"resolution_days": v}) for v in a], *[(5, {"resolution_days": v + 50, "bank_type": "Private Sector"}) for v in b])
    row = A.welch_t(wide_gap).first()
    assert row.reject_null and row.interpretation.startswith("Reject Null Hypothesis: Public sector banks take significantly longer")
    assert row.interpretation.endswith("than private sector banks (p-value < 0.05).")


def test_descriptive_against_numpy(spark):
    xs = [1.0, 2.0, 2.0, 7.0, 30.0]
    row = A.descriptive_stats(wide(spark, *[(1, {"resolution_days": v}) for v in xs])).first()
    n, x = len(xs), np.array(xs)
    m2, m3 = ((x - x.mean()) ** 2).mean(), ((x - x.mean()) ** 3).mean()
    skew = m3 / m2**1.5 * math.sqrt(n * (n - 1)) / (n - 2)
    assert (row["mean"], row["median"], row["count"]) == (8.4, 2.0, 5)
    assert row["std"] == round(x.std(ddof=1), 2) and row["skew"] == round(skew, 2)


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_with_a_hot_group(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [("hot", float(v)) for v in rng.normal(40, 30, 3000).round(2)] + [("hot", 7.0)] * 3000
    rows += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.exponential(20, 6000))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: [r[k] for k in probs] for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in {r[0] for r in rows}:
        want = np.quantile([v for k, v in rows if k == g], list(probs.values()))
        assert got[g] == pytest.approx(want, abs=1e-9), g
    whole = exact_quantiles(df, [], "v", {"m": 0.5}).first().m
    assert whole == pytest.approx(np.median([v for _, v in rows]))


def test_weighted_quantiles_with_a_value_in_several_rows(spark):
    counts = spark.createDataFrame([("a", 5.0, 3), ("b", 5.0, 4), ("a", 9.0, 2), ("b", 1.0, 1)], "s string, v double, n long")
    probs = {"p20": 0.2, "p50": 0.5, "p90": 0.9}
    want = np.quantile([5.0] * 7 + [9.0] * 2 + [1.0], list(probs.values()))
    assert list(weighted_quantiles(counts, [], "v", probs).first()) == pytest.approx(want)


def test_quantiles_of_a_null_group_and_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None)], "g string, v double")
    assert [(r["g"], r["m"]) for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [(None, 2.0)]
    assert exact_quantiles(df.filter("g = 'a'"), [], "v", {"m": 0.5}).first().m is None


def test_ols_against_spark_ml(spark, sf_dir):
    cases = SampleTables(spark, sf_dir).wide.filter("resolution_days IS NOT NULL")
    levels = [(c, r[0]) for c, base in BASELINES.items() for r in cases.select(c).distinct().orderBy(c).collect() if r[0] != base]
    dummies = cases.select(F.col("resolution_days").alias("y"), *[(F.col(c) == v).cast("double").alias(f"x{i}") for i, (c, v) in enumerate(levels)])
    ready = VectorAssembler(inputCols=[f"x{i}" for i in range(len(levels))], outputCol="features").transform(dummies)
    fit = LinearRegression(labelCol="y", solver="normal", regParam=0.0).fit(ready)
    names = [A.OLS_LABELS[c] + str(v) for c, v in levels] + ["Intercept"]
    coefficients = dict(zip(names, [*fit.coefficients, fit.intercept]))
    t_values, p_values = dict(zip(names, fit.summary.tValues)), dict(zip(names, fit.summary.pValues))
    rows = A.ols_days(cases, BASELINES).collect()
    assert {r.variable for r in rows} == set(names)
    for r in rows:
        assert r.coefficient == pytest.approx(coefficients[r.variable], abs=1e-4)
        assert r.t_statistic == pytest.approx(t_values[r.variable], abs=1e-4)
        assert r.p_value == pytest.approx(p_values[r.variable], abs=1e-9)
        assert r.r_squared == pytest.approx(fit.summary.r2, abs=1e-4) and r.adj_r_squared == pytest.approx(fit.summary.r2adj, abs=1e-4)


def test_ols_without_its_baseline_fails(spark, sf_dir):
    with pytest.raises(Exception, match="no case has the baseline bank_type=nowhere"):
        A.ols_days(SampleTables(spark, sf_dir).wide, {**BASELINES, "bank_type": "nowhere"}).collect()


def kendall(xs):
    return int(sum(np.sign(xs[j] - xs[i]) for i in range(len(xs)) for j in range(i + 1, len(xs))))


def test_mann_kendall_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    data = {"up": list(range(20)), "down": list(range(20, 0, -1)), "noise": rng.integers(0, 9, 30).tolist(), "gap": [1, None, 3, 2, None, 5]}
    rows = {r["series"]: r for r in A.mann_kendall(series(spark, **data, flat=[4] * 8, short=[1, 2])).collect()}
    for name, xs in data.items():
        xs = [x for x in xs if x is not None]
        s, n = kendall(xs), len(xs)
        var = n * (n - 1) * (2 * n + 5) / 18
        z = (s - np.sign(s)) / math.sqrt(var)
        r = rows[name]
        assert r.s_statistic == s and r.z_score == round(z, 4) and r.tau == round(s / (n * (n - 1) / 2), 4)
        assert r.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
        assert r.monthly_counts == xs
    assert rows["up"].trend == "Statistically Significant Upward Trend" and rows["down"].trend.endswith("Downward Trend")
    assert rows["up"].interpretation.startswith("The Mann-Kendall test confirms a statistically significant upward trend in up monthly counts (Tau = 1.0, p-value = ")
    assert (rows["flat"].s_statistic, rows["flat"].z_score, rows["flat"].p_value) == (0, 0.0, 1.0)
    short = rows["short"]
    assert (short.trend, short.p_value, short.tau, short.s_statistic) == ("Insufficient Data", 1.0, 0.0, None)


def test_mann_kendall_tie_correction(spark):
    xs = [1, 1, 1, 2, 2, 3, 4, 4, 5, 6]
    plain, tied = (A.mann_kendall(series(spark, s=xs), tie_correction=flag).first() for flag in (False, True))
    n, ties = 10, sum(g * (g - 1) * (2 * g + 5) for g in (3, 2, 2))
    var = (n * (n - 1) * (2 * n + 5) - ties) / 18
    assert plain.s_statistic == tied.s_statistic == kendall(xs)
    assert tied.z_score == round((kendall(xs) - 1) / math.sqrt(var), 4)


def test_box_and_mean(spark):
    df = wide(spark, *[(1, {"resolution_days": float(v)}) for v in range(1, 6)], (1, {"status": "Escalated", "resolution_days": 99.0}))
    r = A.box_summary(df).first()
    assert (r.minimum, r.q1, r["median"], r.q3, r.maximum) == (1.0, 2.0, 3.0, 4.0, 5.0)
    assert A.overall_mean(df).first().avg_resolution_days == 19.0


@pytest.mark.parametrize("t, normal", [(0.1, 0.920344325445942), (2.0, 0.0455002638963584)])
def test_tails_keep_their_digits_at_large_degrees_of_freedom(t, normal):
    from casewatch.functions.tails import incomplete_beta

    for df in (1e9, 1e12, 1e15):
        assert abs(incomplete_beta(df / 2, 0.5, df / (df + t * t), t * t / (df + t * t)) - normal) < 1e-8


def test_quantiles_of_close_values_and_odd_names(spark):
    rows = [(f"g {i % 3}", 0.5 + i / 10_000) for i in range(1000)]
    got = exact_quantiles(spark.createDataFrame(rows, ["bank type", "bucket"]), ["bank type"], "bucket", {"the median": 0.5, "q": 0.25}).collect()
    for r in got:
        values = sorted(v for g, v in rows if g == r["bank type"])
        assert abs(r["the median"] - float(np.quantile(values, 0.5))) < 1e-12 and abs(r["q"] - float(np.quantile(values, 0.25))) < 1e-12


def test_a_tail_is_found_where_rounding_outweighs_the_last_terms():
    a, x = 3988972.5, 0.9999975344829451  # a coefficient over eight million rows
    assert incomplete_beta(a, 0.5, x) == pytest.approx(math.erfc(math.sqrt(a * (1 - x) / x)), rel=1e-4)
