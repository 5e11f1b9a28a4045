"""What plans do with large inputs: how often they read it, how they join, what one task sees."""

import os
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.functions.quantiles import exact_quantiles
from casewatch.operators import case_queries as Q
from casewatch.operators import flags as FL
from casewatch.operators import forecast as FC
from casewatch.operators import quality as V
from casewatch.operators import reports as R
from casewatch.operators import risk as K
from casewatch.operators import statistics as A
from casewatch.operators import summary as G
from casewatch.operators import text_classes as M
from casewatch.plans import sample_queries as P
from casewatch.sources import files


def input_records(spark) -> int:
    """Rows read from files by all stages so far."""
    time.sleep(0.4)
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = store.stageList(None, False, False, none, None)
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    t = P.SampleTables(spark, sf_dir)
    stored = {name: files.stored(df, name) for name, df in (("raw", t.raw), ("wide", t.wide), ("fact", t.fact))}
    many = stored["raw"].withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("_copy")
    return stored | {"many": files.stored(many, "many")}


READS = {  # times the input is read; with the small table of day counts a fifth more
    "resolution_efficiency": (1, "wide", lambda w: Q.resolution_efficiency(w)),
    "rising_categories": (1, "wide", lambda w: Q.rising_categories(w, **P.RISING)),
    "value_counts": (1, "wide", lambda w: Q.value_counts_of_all(w, ["channel", "state", "bank_name"])),
    "top_state_trend": (1, "wide", Q.top_state_trend),
    "risk_scores": (1, "wide", lambda w: K.risk_scores(w, **P.RISK_RULES)),
    "monthly_summary": (1, "fact", G.monthly_summary),
    "policy_flags": (1, "fact", lambda f: FL.policy_flags(f, **P.FLAG_RULES)),
    "quantiles": (1, "wide", lambda w: exact_quantiles(w, ["bank_type"], "resolution_days", {"m": 0.5, "q": 0.9})),
    "box_summary": (1, "wide", A.box_summary),
    "descriptive_stats": (1, "wide", A.descriptive_stats),
    "welch_t": (1, "wide", lambda w: A.welch_t(w, **P.WELCH)),
    "ols_days": (1, "wide", lambda w: A.ols_days(w, P.BASELINES)),
    "mann_kendall": (1, "wide", lambda w: A.mann_kendall(A.monthly_count_series(w, "bank_name"))),
    "monthly_series": (1, "wide", lambda w: G.monthly_series(w, "bank_name")),
    "compound_growth_forecast": (1, "wide", lambda w: FC.compound_growth_forecast(G.monthly_series(w, "bank_name"))),
    "seasonal_forecast": (1, "wide", lambda w: FC.seasonal_forecast(G.monthly_series(w, "bank_name"))),
    "summary_row": (1, "wide", lambda w: R.with_summary_row(R.mis_bank(w), "bank_name")),
    "clean_cases": (2, "raw", lambda r: V.clean_cases(r, **P.WINDOW)),
    "dq_report": (1.2, "many", lambda r: V.dq_report(r, **P.WINDOW)),
    "zscore_outliers": (2, "wide", V.zscore_outliers),
}


@pytest.mark.parametrize("name", READS)
def test_times_the_input_is_read(spark, tables, name):
    times, source, build = READS[name]
    size = tables[source].count()
    before = input_records(spark)
    build(tables[source]).collect()
    assert (input_records(spark) - before) <= times * size


# ALL_QUERIES=1 looks at every plan that can be built without training a model.
EAGER = """run_pipeline score_stream score_classifier class_probabilities train_classifier read_cases_csv results_json flatten_results_json
narrative_search embed_corpus tfidf_vectors report_tables mis_tables corpus_table write_table""".split()
PLANS = "clean_cases dq_report zscore_outliers load_fact wide_cases risk_scores policy_flags ols_days knn_topk_blocks top_state_trend".split()


@pytest.mark.parametrize("name", sorted(set(P.QUERIES) - set(EAGER)) if os.environ.get("ALL_QUERIES") else PLANS)
def test_no_plan_has_a_cross_join(spark, sf_dir, name):
    plan = P.QUERIES[name](P.SampleTables(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark, tables):
    plan = Q.category_top_states(tables["wide"], "ECONOMY")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category_name,ECONOMY)" in plan
    assert re.search(r"ReadSchema: struct<category_name:string,state:string>", plan)
    plan = R.report_headline(tables["wide"], 2001, 6)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(year,2001)" in plan and "complaint_text" not in plan


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 cases; one institution, category and day value hold a third of them."""
    n = F.col("id")
    heavy = n % 3 == 0
    return files.stored(
        spark.range(60_000).select(
            n.alias("complaint_id"),
            F.expr("date_add(date'2023-01-01', cast(id % 730 as int))").alias("date"),
            F.when(heavy, "hot").otherwise(F.concat(F.lit("bank"), (n % 500).cast("string"))).alias("bank_name"),
            F.when(heavy, "Public Sector").otherwise("Private Sector").alias("bank_type"),
            F.when(heavy, "hot").otherwise(F.concat(F.lit("c"), (n % 11).cast("string"))).alias("category_name"),
            F.when(n % 10 < 8, "Resolved").when(n % 10 == 8, "Pending").otherwise("Escalated").alias("status"),
            F.when(n % 10 != 8, F.when(heavy, 7.0).otherwise((n % 997) / 3.0)).alias("resolution_days"),
        ).withColumns({"year": F.year("date"), "month": F.month("date"), "quarter": F.quarter("date")}),
        "hot",
    )


def test_hot_groups_give_whole_results(spark, hot):
    pdf = hot.toPandas()
    rows = {r["bank_name"]: r for r in Q.resolution_efficiency(hot).collect()}
    assert len(rows) == pdf["bank_name"].nunique() and sum(r["total_complaints"] for r in rows.values()) == 60_000
    assert rows["hot"]["total_complaints"] == 20_000
    got = {r["bank_type"]: r for r in A.descriptive_stats(hot).collect()}
    for name, group in pdf.dropna(subset=["resolution_days"]).groupby("bank_type")["resolution_days"]:
        assert got[name]["count"] == len(group)
        assert got[name]["median"] == pytest.approx(np.median(group), abs=0.006)
        assert got[name]["mean"] == pytest.approx(group.mean(), abs=0.006)


def test_hot_values_shrink_before_the_shuffle(spark, hot):
    """Value counts are combined in the map tasks: the shuffle sees distinct values, not cases."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def written():
        time.sleep(0.4)
        stages = store.stageList(None, False, False, none, None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = written()
    exact_quantiles(hot, ["bank_type"], "resolution_days", {"m": 0.5}).collect()
    assert written() - before < 20_000


def test_split_joins_the_hot_class_in_place(spark, hot):
    split = M.stratified_split(hot, "category_name", "complaint_id")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    sizes = {(r["category_name"], r["is_train"]): r["count"] for r in split.groupBy("category_name", "is_train").count().collect()}
    assert sizes["hot", True] == 16_000 and sizes["hot", False] == 4_000


def test_wide_join_without_broadcast_gives_the_same(spark, sf_dir):
    t = P.SampleTables(spark, sf_dir)
    with_broadcast = Q.category_trends(P.S.wide_cases(t.fact, t.banks, t.categories)).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = Q.category_trends(P.S.wide_cases(t.fact, t.banks, t.categories)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, with_broadcast)) == sorted(map(tuple, shuffled))
