"""Descriptive statistics and hypothesis tests.

Cases are reduced to sufficient statistics (counts, means, variances, cross-products) with
map-side combining; tests are arithmetic on those few rows.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.fixed_values import TREND_LABELS, TREND_SHORT_TEXT, TREND_TEXT, WELCH_TEXTS
from casewatch.functions.columns import fill_template, number_text
from casewatch.functions.quantiles import exact_quantiles, value_counts_of, weighted_quantiles
from casewatch.functions.tails import f_upper, normal_two_sided, t_two_sided

DAYS = "resolution_days"


def descriptive_stats(wide: DataFrame, by: str = "bank_type") -> DataFrame:
    """Mean, median, sample deviation, bias-corrected skewness and count of days per group.

    All of them come from how often each value occurs, which is counted in one read.
    """
    values = value_counts_of(wide, [by], DAYS)
    means = values.groupBy(by).agg(F.sum("n").alias("count"), (F.sum(F.col("n") * F.col(DAYS)) / F.sum("n")).alias("_mean")).withColumnRenamed(by, "_of")
    gap, n = F.col(DAYS) - F.col("_mean"), F.col("count").cast("double")
    centred = values.join(means, F.col(by).eqNullSafe(F.col("_of"))).groupBy(by, "count", "_mean").agg(
        F.sum(F.col("n") * F.pow(gap, 2)).alias("_m2"), F.sum(F.col("n") * F.pow(gap, 3)).alias("_m3")
    )
    skew = F.try_divide(F.sqrt(n) * F.col("_m3"), F.pow("_m2", 1.5))
    unbiased = F.when(F.col("count") > 2, skew * F.sqrt(n * (n - 1)) / (n - 2))
    medians = weighted_quantiles(values, [by], DAYS, {"_median": 0.5}).withColumnRenamed(by, "_by")
    return centred.join(medians, F.col(by).eqNullSafe(F.col("_by"))).select(
        by,
        F.bround("_mean", 2).alias("mean"),
        F.bround("_median", 2).alias("median"),
        F.bround(F.sqrt(F.try_divide(F.col("_m2"), n - 1)), 2).alias("std"),
        F.bround(unbiased, 2).alias("skew"),
        "count",
    )


def box_summary(wide: DataFrame, by: str = "bank_type") -> DataFrame:
    """Minimum, quartiles and maximum of resolved days per group."""
    probs = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    return exact_quantiles(wide.filter(F.col("status") == "Resolved"), [by], DAYS, probs)


def overall_mean(wide: DataFrame) -> DataFrame:
    return wide.agg(F.count("*").alias("total_complaints"), F.avg(DAYS).alias("avg_resolution_days"))


def _pair_words(a: str, b: str) -> str:
    """``public and private sector`` for names that share their last word."""
    left, right = a.lower().split(), b.lower().split()
    if len(left) > 1 and left[-1] == right[-1]:
        left = left[:-1]
    return f"{' '.join(left)} and {' '.join(right)}"


def welch_t(wide: DataFrame, a: str = "Public Sector", b: str = "Private Sector", alpha: float = 0.05, by: str = "bank_type") -> DataFrame:
    """Welch's two-sided t-test of mean days between two groups; one aggregate, one row."""

    def of(group: str) -> Column:
        return F.when(F.col(by) == group, F.col(DAYS))

    sums = wide.filter(F.col(by).isin(a, b) & F.col(DAYS).isNotNull()).agg(
        *[
            column
            for tag, group in (("a", a), ("b", b))
            for column in (
                F.avg(of(group)).alias(f"mean_{tag}"),
                F.try_divide(F.var_samp(of(group)), F.count(of(group))).alias(f"se2_{tag}"),
                F.count(of(group)).alias(f"n_{tag}"),
            )
        ]
    )
    se2 = F.col("se2_a") + F.col("se2_b")
    shrink = sum(F.try_divide(F.col(f"se2_{g}") * F.col(f"se2_{g}"), F.col(f"n_{g}") - 1) for g in "ab")
    df = F.try_divide(se2 * se2, shrink)
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(se2))
    tested = sums.select(t.alias("t"), df.alias("df")).withColumn("p_value", t_two_sided("t", "df"))
    words = {"first": a.capitalize(), "second": b.lower(), "pair": _pair_words(a, b), "alpha": str(alpha)}
    reject = F.coalesce(F.col("p_value") < alpha, F.lit(False))
    return tested.select(
        F.bround("t", 4).alias("t_statistic"),
        "df",
        "p_value",
        reject.alias("reject_null"),
        F.when(reject, WELCH_TEXTS[True].format(**words)).otherwise(WELCH_TEXTS[False].format(**words)).alias("interpretation"),
    )


# --- ordinary least squares on categorical predictors -------------------------------------

# Labels of the model terms; fixed values. Keys are columns of the wide table.
OLS_BASELINES = {"bank_type": "Private Sector", "channel": "Online", "category_name": "Other"}
OLS_LABELS = {"bank_type": "Bank Type: ", "channel": "Channel: ", "category_name": "Category: "}
INTERCEPT = "Intercept"

_COEF_SCHEMA = "variable string, coefficient double, std_error double, n bigint, k int, r_squared double"


def _solve(gram: pd.DataFrame) -> pd.DataFrame:
    """Solve one normal-equation system, given as rows (i, j, n, sum_y, sum_yy)."""
    terms = sorted(gram["i"].unique(), key=lambda v: (v != INTERCEPT, v))
    at = {term: i for i, term in enumerate(terms)}
    xx = np.zeros((len(terms), len(terms)))
    xx[gram["i"].map(at), gram["j"].map(at)] = gram["n"]
    inverse = np.linalg.pinv(xx, hermitian=True)  # of collinear levels, the solution of least norm
    rank = np.linalg.matrix_rank(xx, hermitian=True)
    diagonal = gram[gram["i"] == gram["j"]].set_index("i").loc[terms]
    n, center = xx[0, 0], diagonal["sum_y"].iloc[0] / xx[0, 0]
    xy = diagonal["sum_y"].to_numpy() - center * xx[0]  # y is centred
    spread = diagonal["sum_yy"].iloc[0] - n * center**2
    beta = inverse @ xy
    residual = max(spread - float(beta @ xy), 0.0)
    free = n - rank
    error = np.sqrt(np.maximum(np.diag(inverse), 0.0) * residual / free) if free > 0 else np.full(len(terms), np.nan)
    beta[0] += center
    return pd.DataFrame(
        {
            "variable": terms, "coefficient": beta, "std_error": error, "n": int(n), "k": int(rank) - 1,
            "r_squared": 1.0 - residual / spread if spread > 0 else np.nan,
        }
    )


def ols_days(wide: DataFrame, baselines: Mapping[str, str] = OLS_BASELINES, alpha: float = 0.05, labels: Mapping[str, str] = OLS_LABELS) -> DataFrame:
    """Treatment-coded regression of days on categorical predictors.

    With only categorical predictors the design matrix has one distinct row per combination
    of levels. Cases are therefore aggregated once to combinations (map-side combined),
    whose cross-products give the normal equations: one entry per pair of levels,
    independent of the number of cases. Solving that small matrix is the only Python step.

    One row per term, each with the model's fit. A baseline that no case has is an error.
    """
    cells = (
        wide.filter(F.col(DAYS).isNotNull())
        .groupBy(*baselines)
        .agg(F.count("*").alias("n"), F.sum(DAYS).alias("sum_y"), F.sum(F.col(DAYS) * F.col(DAYS)).alias("sum_yy"))
    )
    has = {f"has_{c}": (F.col(c) == level).cast("int") for c, level in baselines.items()}
    terms = F.array_compact(
        F.array(
            F.lit(INTERCEPT),
            *[F.when(F.col(c) != level, F.concat(F.lit(labels.get(c, f"{c}: ")), F.col(c).cast("string"))) for c, level in baselines.items()],
        )
    )
    missing = F.concat_ws(", ", *[F.when(F.col(f"has_{c}") == 0, F.lit(f"{c}={level}")) for c, level in baselines.items()])
    checked = F.when((F.col("i") != INTERCEPT) | (F.col("j") != INTERCEPT) | (missing == ""), F.col("n")).otherwise(
        F.raise_error(F.concat(F.lit("no case has the baseline "), missing)).cast("double")
    )
    gram = (
        cells.withColumns({"terms": terms, **has})
        .withColumn("i", F.explode("terms"))
        .withColumn("j", F.explode("terms"))
        .groupBy("i", "j")
        .agg(F.sum("n").cast("double").alias("n"), F.sum("sum_y").alias("sum_y"), F.sum("sum_yy").alias("sum_yy"),
             *[F.max(c).alias(c) for c in has])
        .select("i", "j", checked.alias("n"), "sum_y", "sum_yy")
    )
    solved = gram.groupBy().applyInPandas(_solve, _COEF_SCHEMA)
    freedom = (F.col("n") - F.col("k") - 1).cast("double")
    r2, k = F.col("r_squared"), F.col("k").cast("double")
    fitted = solved.withColumns(
        {
            "t": F.try_divide("coefficient", "std_error"),
            "f": F.try_divide(r2 / k, (1 - r2) / freedom),
            "df": freedom,
            "adj": 1 - (1 - r2) * (F.col("n") - 1) / freedom,
        }
    ).withColumns({"p_value": t_two_sided("t", "df"), "f_pvalue": f_upper("f", F.col("k").cast("double"), "df")})
    return fitted.select(
        "variable",
        F.bround("coefficient", 4).alias("coefficient"),
        F.bround("t", 4).alias("t_statistic"),
        "p_value",
        (F.col("p_value") < alpha).alias("significant"),
        F.bround("r_squared", 4).alias("r_squared"),
        F.bround("adj", 4).alias("adj_r_squared"),
        F.bround("f", 4).alias("f_statistic"),
        "f_pvalue",
    )


def ols_simple(df: DataFrame, y: str, x: str, by: str | None = None) -> DataFrame:
    """Slope, intercept and R² of a one-predictor regression, per group if asked."""
    keys = [by] if by else []
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r_squared")
    )


# --- Mann-Kendall ---------------------------------------------------------------------------


def _decimal_text(value: Column, digits: int) -> Column:
    """Plain decimal text without trailing zeros (``0.05``, ``0.0``)."""
    trimmed = F.regexp_replace(F.bround(value, digits).cast(f"decimal(18,{digits})").cast("string"), r"0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def _signed_text(value: Column, digits: int) -> Column:
    """Rounded number as text; a small negative one stays ``-0.0``, as IEEE rounding has it."""
    text = number_text(value, digits)
    return F.when((value < 0) & (text == "0.0"), F.lit("-0.0")).otherwise(text)


def mann_kendall(series: DataFrame, alpha: float = 0.05, tie_correction: bool = False, min_n: int = 3) -> DataFrame:
    """Monotonic-trend test for every series of ``series, month_end, value``.

    A series is one array (one entry per calendar month), and S is summed inside that row;
    pairs are never materialised. Any number of series run in parallel.
    """
    points = F.sort_array(F.collect_list(F.struct("month_end", "value")))
    arrays = series.groupBy("series").agg(points.alias("p")).select(
        "series", F.transform("p", lambda x: x["value"]).alias("x")
    )
    n, s = F.col("n").cast("double"), F.col("s")
    score = F.aggregate(
        F.sequence(F.lit(2), F.size("x")),
        F.lit(0).cast("long"),
        lambda total, j: total
        + F.aggregate(
            F.slice("x", F.lit(1), j - 1),
            F.lit(0).cast("long"),
            lambda inner, earlier: inner + F.signum(F.element_at("x", j) - earlier).cast("long"),
        ),
    )
    ties = F.aggregate(
        F.array_distinct("x"),
        F.lit(0.0),
        lambda total, v: total + (lambda g: g * (g - 1) * (2 * g + 5))(F.size(F.filter("x", lambda e: e == v)).cast("double")),
    ) if tie_correction else F.lit(0.0)
    enough = F.col("n") >= min_n
    scored = (
        arrays.withColumn("n", F.size("x"))
        .withColumn("s", F.when(enough, score))
        .withColumn("var_s", F.when(enough, (n * (n - 1) * (2 * n + 5) - ties) / 18))
        .withColumn(
            "z",
            F.when(s > 0, F.try_divide(s - 1, F.sqrt("var_s")))
            .when(s < 0, F.try_divide(s + 1, F.sqrt("var_s")))
            .when(enough, F.lit(0.0)),
        )
        .withColumn("tau", F.when(enough, s / (n * (n - 1) / 2)).otherwise(0.0))
        .withColumn("p", F.when(enough, normal_two_sided("z")).otherwise(1.0))
    )
    reject = F.coalesce(F.col("p") < alpha, F.lit(False))
    trend = (
        F.when(~enough, TREND_LABELS["short"])
        .when(reject & (s > 0), TREND_LABELS["up"])
        .when(reject & (s < 0), TREND_LABELS["down"])
        .otherwise(TREND_LABELS["none"])
    )
    text = fill_template(
        TREND_TEXT,
        {
            "trend_lower": F.lower("trend"),
            "series": F.col("series"),
            "tau_3": _signed_text(F.col("tau"), 3),
            "p_6": _decimal_text(F.col("p"), 6),
        },
    )
    return scored.withColumn("trend", trend).select(
        "series",
        "trend",
        F.bround("tau", 4).alias("tau"),
        F.col("s").alias("s_statistic"),
        F.bround("z", 4).alias("z_score"),
        F.col("p").alias("p_value"),
        reject.alias("reject_null"),
        F.when(enough, text).otherwise(TREND_SHORT_TEXT).alias("interpretation"),
        F.transform("x", lambda v: v.cast("long")).alias("monthly_counts"),
    )


def monthly_count_series(wide: DataFrame, by: str) -> DataFrame:
    """``series, month_end, value`` over the months that have cases (no filled gaps)."""
    return wide.groupBy(F.col(by).alias("series"), F.last_day("date").alias("month_end")).agg(
        F.count("*").cast("double").alias("value")
    )


# --- one JSON document of all results -------------------------------------------------------


def statistics_document(descriptive: DataFrame, welch: DataFrame, ols: DataFrame, trend: DataFrame, by: str = "bank_type") -> DataFrame:
    """The four results as one JSON text.

    Each result becomes one row of JSON (one entry per group, term or series, never cases);
    the four rows are then joined to one object.
    """

    def entries(key: str, fields: list[str]) -> Column:
        pairs = F.collect_list(F.struct(F.col(key).alias("key"), F.struct(*fields).alias("value")))
        return F.map_from_entries(F.sort_array(pairs))

    def section(name: str, df: DataFrame, body: Column) -> DataFrame:
        return df.select(F.lit(name).alias("name"), F.to_json(body).alias("body"))

    fit = ["r_squared", "adj_r_squared", "f_statistic", "f_pvalue"]
    trend_fields = ["trend", "tau", "s_statistic", "z_score", "p_value", "reject_null", "interpretation", "monthly_counts"]
    parts = [
        section(
            "descriptive_statistics",
            descriptive.agg(entries(by, ["mean", "median", "std", "skew", "count"]).alias("m")), F.col("m"),
        ),
        section("welch_t_test", welch, F.struct("t_statistic", "p_value", "reject_null", "interpretation")),
        section(
            "ols_regression",
            ols.agg(*[F.max(c).alias(c) for c in fit],
                    entries("variable", ["coefficient", "t_statistic", "p_value", "significant"]).alias("coefficients")),
            F.struct(*fit, "coefficients"),
        ),
        section("mann_kendall_trend_test", trend.agg(entries("series", trend_fields).alias("m")), F.col("m")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    member = F.concat(F.lit('"'), "name", F.lit('":'), "body")
    return rows.agg(
        F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(member)), ","), F.lit("}")).alias("document")
    )
