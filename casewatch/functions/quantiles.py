"""Exact quantiles without gathering a group's values in one task.

Values are first counted (``group, value -> n``), which combines on the map side, so a
group with a third of all rows costs no more than its number of distinct values. The
wanted rank is then located among buckets of equal relative width, and only the bucket that holds it
is looked at value by value. The largest thing one task orders is therefore the list of
buckets of a group, or the distinct values within one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts_of(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by..., value, n`` over the non-null values."""
    return df.filter(F.col(_quoted(value)).isNotNull()).groupBy(*[_quoted(c) for c in [*by, value]]).agg(F.count("*").alias("n"))


STEPS = 4096  # buckets per doubling of a value: one is a fiftieth of a percent wide, whatever the unit
_BEYOND = 5_000_000  # more than any bucket number, so that negative, zero and positive values keep their order

_BUCKET = (
    f"CASE WHEN _v > 0 THEN floor(log2(_v) * {STEPS}) + {_BEYOND} WHEN _v < 0 THEN -floor(log2(-_v) * {STEPS}) - {_BEYOND} ELSE 0 END"
)

_QUANTILES = """
    WITH buckets AS (
        SELECT {by} {bucket} AS _bucket, sum(_n) AS _inside FROM {{counts}} GROUP BY {by} {bucket}
    ), placed AS (
        SELECT *, sum(_inside) OVER ({group} ORDER BY _bucket) AS _upto, sum(_inside) OVER ({group}) AS _total FROM buckets
    ), wanted AS (
        SELECT *, (_total - 1) * _p AS _place
        FROM placed LATERAL VIEW explode(map({probs})) AS _name, _p
    ), targets AS (
        SELECT {by} _bucket, _upto - _inside AS _before, _name, _side, _place - floor(_place) AS _frac, _rank
        FROM wanted LATERAL VIEW explode(map('lo', floor(_place), 'hi', ceil(_place))) AS _side, _rank
        WHERE _upto - _inside <= _rank AND _rank < _upto
    ), inside AS (
        SELECT {c_by} c._v, c._n, t._name, t._side, t._frac, t._rank,
               t._before + sum(c._n) OVER (PARTITION BY {c_by} t._bucket, t._name, t._side ORDER BY c._v
                                        ROWS UNBOUNDED PRECEDING) AS _upto
        FROM {{counts}} c JOIN targets t ON {on} {bucket} = t._bucket
    )
    SELECT {by} {picks} FROM inside WHERE _upto - _n <= _rank AND _rank < _upto {grouping}
"""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def weighted_quantiles(counts: DataFrame, by: list[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Linear-interpolation quantiles of a ``by..., value, n`` table, one row per group.

    ``probs`` maps result column names to probabilities. A value may occur in several rows.
    """
    def pick(name: str) -> str:
        text = name.replace("'", "\\'")
        at = {side: f"max(CASE WHEN _name = '{text}' AND _side = '{side}' THEN _v END)" for side in ("lo", "hi")}
        return f"{at['lo']} + ({at['hi']} - {at['lo']}) * max(CASE WHEN _name = '{text}' THEN _frac END) AS {_quoted(name)}"

    keys = [_quoted(c) for c in by]
    query = _QUANTILES.format(
        by="".join(f"{c}, " for c in keys),
        c_by="".join(f"c.{c}, " for c in keys),
        on="".join(f"c.{c} <=> t.{c} AND " for c in keys),
        group=f"PARTITION BY {', '.join(keys) or '0'}",
        grouping=f"GROUP BY {', '.join(keys)}" if keys else "",
        bucket=_BUCKET,
        probs=", ".join("'" + name.replace("'", "\\'") + f"', {float(p)}D" for name, p in probs.items()),
        picks=", ".join(pick(name) for name in probs),
    )
    known = counts.select(*[F.col(c) for c in keys], F.col(_quoted(value)).cast("double").alias("_v"), F.col("n").alias("_n")).filter("_v IS NOT NULL")
    return counts.sparkSession.sql(query, counts=known)


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    return weighted_quantiles(value_counts_of(df, by, value), by, value, probs)
