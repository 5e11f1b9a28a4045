"""Mann-Kendall trend test of series of any length.

S, the sum of the signs of all later-minus-earlier differences, is counted without pairs. Points are cut into blocks that
follow each other in time. Inside a block, a task counts by halving the range of values: at each level, points of the upper half that follow points
of the lower one, and the reverse. Across blocks only (value, block, count) matters: it is cut into ranges of values, within which
a task counts in the same way, and what lies between ranges follows from the numbers of points by range and block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.functions.tails import normal_two_sided
from casewatch.sources.files import stored

#: Points of a block or range, about; blocks and ranges at most, so that their table stays small.
BLOCK, MOST = 1 << 18, 1024


def signed_pairs(values: np.ndarray, weights: np.ndarray) -> int:
    """Sum over i < j of weights[i] * weights[j] * sign(values[j] - values[i])."""
    if len(values) < 2:
        return 0
    ranks = np.unique(values, return_inverse=True)[1].astype(np.int64)
    weights = weights.astype(np.int64)
    half, total = np.zeros(len(ranks), np.int64), 0  # half: number of the range of ranks; its points are neighbours, in order of time
    for bit in reversed(range(int(ranks.max()).bit_length())):
        upper = (ranks >> bit) & 1
        low, high = np.where(upper == 0, weights, 0), np.where(upper == 1, weights, 0)
        before_low, before_high = np.cumsum(low) - low, np.cumsum(high) - high
        first = np.flatnonzero(np.concatenate([[True], half[1:] != half[:-1]]))
        size = np.diff(np.append(first, len(half)))
        total += int((high * (before_low - np.repeat(before_low[first], size))).sum()) - int((low * (before_high - np.repeat(before_high[first], size))).sum())
        half = half * 2 + upper
        order = np.argsort(half, kind="stable")
        ranks, weights, half = ranks[order], weights[order], half[order]
    return total


def _equal_pairs(values: np.ndarray, weights: np.ndarray) -> int:
    """Sum of the products of the weights of pairs with one value; the values are sorted."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    weights = weights.astype(np.int64)
    sums, squares = np.add.reduceat(weights, first) if len(first) else weights, np.add.reduceat(weights * weights, first) if len(first) else weights
    return int(((sums * sums - squares) // 2).sum())


def _within_block(points: pd.DataFrame) -> pd.DataFrame:
    points = points.sort_values("at", kind="stable")
    s = signed_pairs(points["value"].to_numpy(), np.ones(len(points), np.int64))
    return pd.DataFrame({"series": points["series"].iloc[:1], "s": [s]})


def _across(column: str):
    """Pairs of different blocks of a table in which ``column`` orders the values: blocks take the part of values, values that of time."""

    def work(counts: pd.DataFrame) -> pd.DataFrame:
        counts = counts.sort_values([column, "block"], kind="stable")
        n = counts["n"].to_numpy()
        s = signed_pairs(counts["block"].to_numpy(), n) - _equal_pairs(counts[column].to_numpy(), n)
        return pd.DataFrame({"series": counts["series"].iloc[:1], "s": [s]})

    return work


def long_trend(points: DataFrame, alpha: float = 0.05, block: int = BLOCK) -> DataFrame:
    """``series, n, s_statistic, tau, z_score, p_value, tied_p_value, trend`` of (series, at, value).

    ``at`` orders a series and is distinct in it. ``tied_p_value`` uses the variance corrected for ties. Null values are left out; a series of
    fewer than three points has no result but its length.
    """
    known = stored(points.select("series", "at", F.col("value").cast("double").alias("value")).filter("value is not null and not isnan(value)"), "points")
    parts = max(1, min(MOST, -(-known.count() // block)))
    placed = stored(known.repartitionByRange(parts, "series", "at").withColumn("block", F.spark_partition_id()), "blocks")
    result = f"series {placed.schema['series'].dataType.simpleString()}, s long"
    within = placed.groupBy("series", "block").applyInPandas(_within_block, result)

    counts = placed.groupBy("series", "value", "block").agg(F.count(F.lit(1)).alias("n"))
    ranged = stored(counts.repartitionByRange(parts, "series", "value").withColumn("range", F.spark_partition_id()), "ranges")
    inside = ranged.groupBy("series", "range").applyInPandas(_across("value"), result)
    between = ranged.groupBy("series", "range", "block").agg(F.sum("n").alias("n")).groupBy("series").applyInPandas(_across("range"), result)
    s = within.unionByName(inside).unionByName(between).groupBy("series").agg(F.sum("s").alias("s"))

    ties = ranged.groupBy("series", "value").agg(F.sum("n").cast("double").alias("g"))
    tied = ties.groupBy("series").agg(F.sum("g").cast("long").alias("n"), F.sum(F.expr("g * (g - 1) * (2 * g + 5)")).alias("ties"))
    n = F.col("n").cast("double")
    spread = n * (n - 1) * (2 * n + 5)
    z = lambda variance: F.when(F.col("s") > 0, F.try_divide(F.col("s") - 1, F.sqrt(variance))).when(F.col("s") < 0, F.try_divide(F.col("s") + 1, F.sqrt(variance))).otherwise(0.0)
    enough = F.col("n") >= 3
    tested = s.join(tied, "series").withColumns({"z": F.when(enough, z(spread / 18)), "tied_z": F.when(enough, z((spread - F.col("ties")) / 18))})
    tested = tested.withColumns({"p": normal_two_sided("z"), "tied_p": normal_two_sided("tied_z")})
    trend = F.when(~enough, "short").when(F.coalesce(F.col("p") >= alpha, F.lit(True)), "none").when(F.col("s") > 0, "up").otherwise("down")
    return tested.select(
        "series", "n", F.when(enough, F.col("s")).alias("s_statistic"), F.when(enough, F.col("s") / (n * (n - 1) / 2)).alias("tau"),
        F.col("z").alias("z_score"), F.col("p").alias("p_value"), F.col("tied_p").alias("tied_p_value"), trend.alias("trend"),
    )
