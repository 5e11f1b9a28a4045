"""Column expressions shared by the operators. All run inside generated JVM code."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_status(status: str) -> Column:
    """Conditional count of one status; combines on the map side like any count."""
    return F.count_if(F.col("status") == status)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def growth_percent(now: Column, before: Column) -> Column:
    """Relative change in percent; null where there is no earlier value or it is 0."""
    return F.try_divide((now - before).cast("double"), before.cast("double")) * 100


def resolved_days() -> Column:
    """Days of resolved cases only (closed-by-escalation cases carry days too)."""
    return F.when(F.col("status") == "Resolved", F.col("resolution_days"))


def age_days(ref_date: str, date: str = "date") -> Column:
    return F.date_diff(F.lit(ref_date).cast("date"), F.col(date))


def number_text(value: Column, digits: int | None = None) -> Column:
    """Shortest text of a double, rounded half-even first when ``digits`` is given."""
    return (value if digits is None else F.bround(value, digits)).cast("string")


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """``concat`` of a text with ``{name}`` places; a null value makes the text null."""
    parts = re.split(r"\{(\w+)\}", template)
    columns = [
        (F.lit(part) if i % 2 == 0 else values[part].cast("string"))
        for i, part in enumerate(parts)
        if i % 2 == 1 or part
    ]
    return F.concat(*columns)


def first_match(rules: list[tuple[str, Column]], default: str) -> Column:
    """Label of the first condition that holds."""
    chain = reduce(
        lambda acc, rule: acc.when(rule[1], F.lit(rule[0])),
        rules[1:],
        F.when(rules[0][1], F.lit(rules[0][0])),
    )
    return chain.otherwise(F.lit(default))


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def quarter_label(year: str = "year", quarter: str = "quarter") -> Column:
    return F.concat(F.col(year).cast("string"), F.lit("-Q"), F.col(quarter).cast("string"))
