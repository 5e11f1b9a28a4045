"""Rule-based supervisory flags per institution and quarter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.fixed_values import FLAG_TEXTS, FLAG_TYPES, SEVERITIES
from casewatch.functions.columns import count_status, fill_template, growth_percent, number_text, percent


def _flag(rule: str, when: Column, severity: Column, **places: Column) -> Column:
    return F.when(
        when,
        F.struct(
            F.lit(FLAG_TYPES[rule]).alias("flag_type"),
            fill_template(FLAG_TEXTS[rule], places).alias("flag_description"),
            severity.alias("severity"),
        ),
    )


def policy_flags(fact: DataFrame, **rules: float) -> DataFrame:
    """Delay, escalation and spike flags; ``rules`` are those of ``flags_of_quarters``.

    One aggregate per institution and quarter carries everything the three rules read, so cases are read once, not once per rule.
    """
    return flags_of_quarters(fact.groupBy("bank_id", "year", "quarter").agg(
        F.count("*").alias("total"),
        count_status("Escalated").alias("escalated"),
        F.avg("resolution_days").alias("avg_days"),
    ), **rules)


def flags_of_quarters(
    quarters: DataFrame,
    min_n: int = 50,
    delay_days: float = 75,
    escalation_pct: float = 15,
    spike_pct: float = 25,
    high_spike_pct: float = 40,
) -> DataFrame:
    """Flags from one row per institution and quarter: total, escalated, avg_days.

    The rules are an array of optional flags per row. ``min_n`` applies to delay and escalation only. Spikes compare with the previous
    quarter that has cases. Groups are unique per rule, so no flag can repeat.
    """
    by_quarter = Window.partitionBy("bank_id").orderBy("year", "quarter")
    measured = quarters.withColumns(
        {
            "escalation_pct": percent(F.col("escalated"), F.col("total")),
            "growth_pct": growth_percent(F.col("total"), F.lag("total").over(by_quarter)),
        }
    )
    enough = F.col("total") >= min_n
    growth = F.col("growth_pct")
    flags = F.array(
        _flag("delay", enough & (F.col("avg_days") > delay_days), F.lit("High"),
              avg_days=number_text(F.col("avg_days"), 1)),
        _flag("escalation", enough & (F.col("escalation_pct") > escalation_pct), F.lit("Medium"),
              escalation_pct=number_text(F.col("escalation_pct"), 1)),
        _flag("spike", growth > spike_pct, F.when(growth > high_spike_pct, "High").otherwise("Medium"),
              growth_pct=number_text(growth, 1), total=F.col("total")),
    )
    return measured.select("bank_id", "year", "quarter", F.inline(F.array_compact(flags)))


def severity_order(severity: str = "severity") -> Column:
    """Position of a severity in rising order, for sorting."""
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col(severity))


def _named(flags: DataFrame, institutions: DataFrame) -> DataFrame:
    return flags.join(institutions.select("bank_id", "bank_name"), "bank_id")


def flag_register(flags: DataFrame, institutions: DataFrame) -> DataFrame:
    """Flags with institution names, most severe and newest first."""
    return (
        _named(flags, institutions)
        .orderBy(severity_order().desc(), F.desc("year"), F.desc("quarter"), "bank_name", "flag_type")
        .select("bank_name", "year", "quarter", "flag_type", "flag_description", "severity")
    )


def flag_sample(flags: DataFrame, institutions: DataFrame, k: int = 3) -> DataFrame:
    """The first k flags by institution and time."""
    first = flags.orderBy("bank_id", "year", "quarter", "flag_type").limit(k)
    return _named(first, institutions).select("bank_name", "flag_type", "flag_description", "severity")


def flag_key(*keys: str) -> Column:
    """Surrogate key: a hash of the natural key, so no global numbering is needed."""
    return F.xxhash64(*keys)
