import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from casewatch.operators import case_queries as Q
from casewatch.operators import flags as FL
from casewatch.operators import refresh as RF
from casewatch.operators import star_tables as ST
from casewatch.operators import summary as G
from casewatch.schemas import COMPLAINTS
from casewatch.session import new_table_path
from tests.test_scale import input_records


def cases(spark, rows):
    """(id, bank, category, year, month, status, days)"""
    made = [
        (str(i), date(y, m, 1 + i % 28), b, c, c, "text", f"S{i % 5}", "Online", status, days, "Retail", y, m, (m + 2) // 3)
        for i, b, c, y, m, status, days in rows
    ]
    return spark.createDataFrame(made, COMPLAINTS).repartition(3)


def sample(n, seed=1, months=range(1, 13), start=0):
    rng = random.Random(seed)
    return [
        (start + i, rng.randrange(1, 7), rng.choice([1, 1, 1, 2, 3, None, 99]), 2023 + rng.randrange(2), rng.choice(months),
         rng.choice(["Resolved", "Pending", "Escalated"]), rng.choice([None, float(rng.randrange(1, 200))]))
        for i in range(n)
    ]


CATEGORIES = [(1, "Cards", 10, "a"), (1, "Cards", 11, "b"), (2, "Loans", 20, "c"), (3, "Fraud", 30, "d"), (3, "Fraud", 31, "e")]


@pytest.fixture(scope="module")
def star(spark):
    fact = cases(spark, sample(3000))
    categories = spark.createDataFrame(CATEGORIES, "category_id int, category_name string, subcategory_id int, subcategory_name string")
    path = new_table_path(spark, "star")
    ST.save_star(fact, categories, path, buckets=16)
    return fact, path


def test_each_case_is_counted_once_at_category_grain(spark, star):
    fact, path = star
    named = ST.category_cases(ST.open_star(spark, path))
    assert named.count() == fact.count() and set(named.columns) == {*fact.columns, "category_name"}
    names = {1: "Cards", 2: "Loans", 3: "Fraud"}
    wanted = {}
    for r in fact.collect():
        key = (r.state, names.get(r.category_id, "Unknown"))
        wanted[key] = wanted.get(key, 0) + 1
    assert {(r.state, r.category_name): r.complaint_count for r in Q.state_heatmap(named).collect()} == wanted
    assert Q.category_trends(named).agg(F.sum("complaint_count")).first()[0] == 3000


def test_the_join_shuffles_neither_side(spark, star):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a dimension that is too large to send
    try:
        result = Q.category_trends(ST.category_cases(ST.open_star(spark, star[1])))
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan[plan.index("SortMergeJoin"):]  # the only one is above it, of partial counts


def test_a_hot_category_is_spread_over_buckets(spark, star):
    spread = spark.read.parquet(f"{star[1]}/fact").filter("category_id = 1").groupBy(F.input_file_name()).count().collect()
    assert len(spread) > 5 and max(r["count"] for r in spread) < 0.4 * sum(r["count"] for r in spread)


def test_opened_in_a_session_that_knows_only_the_path(spark, star):
    other = spark.newSession()
    assert ST.category_cases(ST.open_star(other, star[1])).count() == 3000


def test_a_category_with_two_names_is_an_error(spark):
    twice = spark.createDataFrame([(1, "A", 1, "x"), (1, "B", 2, "y")], "category_id int, category_name string, subcategory_id int, subcategory_name string")
    with pytest.raises(Exception, match="not unique"):
        ST.category_grain(twice).collect()


RULES = {"min_n": 5, "delay_days": 90, "escalation_pct": 30}


def rounded(df):
    names = sorted(df.columns)
    return sorted((tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in names) for r in df.collect()), key=str)


def tables(spark, path):
    return rounded(spark.read.parquet(f"{path}/monthly_summary")), rounded(spark.read.parquet(f"{path}/policy_flags"))


def rebuilt(fact):
    return rounded(G.monthly_summary(fact)), rounded(FL.policy_flags(fact, **RULES))


def test_added_months_equal_a_full_rebuild(spark):
    path = new_table_path(spark, "refresh")
    everything = cases(spark, sample(1500, months=[1, 2, 3, 5, 6, 9, 12]))
    loads = [F.col("month").isin(1, 6, 12), F.col("month") == 3, (F.col("month") == 5) & (F.col("bank_id") < 3), F.col("month").isin(2, 9), (F.col("month") == 5) & (F.col("bank_id") >= 3)]
    done = F.lit(False)
    for load in loads:
        RF.refresh(everything.filter(load), path, **RULES)
        done = done | load
        assert tables(spark, path) == rebuilt(everything.filter(done))
    assert RF.refresh(everything.limit(0), path, **RULES)["complaints"] == []


def test_replaced_months_equal_a_full_rebuild_and_leave_no_old_flags(spark):
    path = new_table_path(spark, "refresh")
    first = cases(spark, sample(1200, seed=2, months=range(1, 7)))
    RF.refresh(first, path, **RULES)
    n_flags = len(tables(spark, path)[1])
    # One bank vanishes from the month, and the quarter loses all its flags.
    better = cases(spark, [(9000 + i, 1 + i % 4, 1, 2023, m, "Resolved", 1.0) for i in range(40) for m in (4, 5, 6)])
    RF.refresh(better, path, replace=True, **RULES)
    months = (F.col("year") == 2023) & F.col("month").isin(4, 5, 6)
    assert tables(spark, path) == rebuilt(first.filter(~months).unionByName(better))
    assert 0 < len(tables(spark, path)[1]) < n_flags


def test_only_the_changed_month_is_read_and_rewritten(spark):
    path = new_table_path(spark, "refresh")
    RF.refresh(cases(spark, sample(20_000, seed=3)), path, **RULES)
    new = cases(spark, sample(50, seed=4, months=[7], start=10**6)).filter("year = 2023")
    before = input_records(spark)
    periods = RF.refresh(new, path, **RULES)
    month = spark.read.parquet(f"{path}/complaints").filter("year = 2023 and month = 7").count()
    time.sleep(0.2)
    assert input_records(spark) - before < 3 * month + 3000  # 20,000 cases are there
    assert periods == {"complaints": [(2023, 7)], "monthly_summary": [(2023, 7), (2023, 8)], "policy_flags": [(2023, 3), (2023, 4)]}


def test_refresh_can_be_repeated_when_it_replaces(spark):
    path = new_table_path(spark, "refresh")
    fact = cases(spark, sample(400, seed=5))
    RF.refresh(fact, path, **RULES)
    RF.refresh(fact.filter("month = 4"), path, replace=True, **RULES)
    RF.refresh(fact.filter("month = 4"), path, replace=True, **RULES)
    assert tables(spark, path) == rebuilt(fact)


def test_a_refresh_without_any_flag_leaves_an_empty_table(spark):
    path = new_table_path(spark, "refresh")
    fact = cases(spark, [(i, 1, 1, 2023, m, "Resolved", 1.0) for i in range(40) for m in (1, 2, 3, 4)])
    RF.refresh(fact.filter("month < 4"), path, **RULES)
    assert rounded(RF.refreshed(spark, path, "policy_flags")) == []
    RF.refresh(fact.filter("month = 4"), path, **RULES)
    found = RF.refreshed(spark, path, "policy_flags"), RF.refreshed(spark, path, "monthly_summary")
    assert (rounded(found[1]), rounded(found[0])) == rebuilt(fact)
    late = cases(spark, [(900 + i, 1, 1, 2023, 7, "Escalated", 1.0) for i in range(40)])
    RF.refresh(late, path, **RULES)
    assert rounded(RF.refreshed(spark, path, "policy_flags")) == rebuilt(fact.unionByName(late))[1] != []
    assert sorted(RF.refreshed(spark, path, "policy_flags").dtypes) == sorted(spark.read.parquet(f"{path}/policy_flags").dtypes)
