"""Flags, summary, risk and query edges."""

from datetime import date

from casewatch.operators import case_queries as Q
from casewatch.operators import flags as FL
from casewatch.operators import reports as R
from casewatch.operators import risk as K
from casewatch.operators import summary as G
from tests.frames import fact, wide


def flags_of(df, **rules):
    return {(r["quarter"], r["flag_type"]): (r["severity"], r["flag_description"]) for r in FL.policy_flags(df, **rules).collect()}


DELAY, ESCALATION, SPIKE = FL.FLAG_TYPES["delay"], FL.FLAG_TYPES["escalation"], FL.FLAG_TYPES["spike"]


def test_delay_bound_and_sample_size(spark):
    slow = {"resolution_days": 75.0}
    assert flags_of(fact(spark, (50, slow))) == {}
    slower = {"resolution_days": 76.0}
    assert flags_of(fact(spark, (49, slower))) == {}
    assert flags_of(fact(spark, (50, slower))) == {
        (1, DELAY): ("High", "Average resolution days reached 76.0 days, exceeding supervision SLA (60 days).")
    }


def test_delay_averages_all_closed_cases(spark):
    df = fact(spark, (25, {"resolution_days": 60.0}), (25, {"status": "Escalated", "resolution_days": 100.0}))
    assert (1, DELAY) in flags_of(df, escalation_pct=90)


def test_escalation_bound(spark):
    at = fact(spark, (85, {}), (15, {"status": "Escalated"}))
    assert flags_of(at) == {}
    above = fact(spark, (84, {}), (16, {"status": "Escalated"}))
    assert flags_of(above)[(1, ESCALATION)] == (
        "Medium", "Complaint escalation rate is 16.0%, indicating inadequate internal grievance redressal."
    )


def test_spike_bounds_have_no_minimum(spark):
    def grown(a, b):
        return flags_of(fact(spark, (a, {}), (b, {"quarter": 2, "month": 4})))

    assert grown(4, 5) == {}
    assert grown(20, 26)[(2, SPIKE)] == ("Medium", "QoQ complaints volume spiked by 30.0% (26 total). Investigation recommended.")
    assert grown(10, 14)[(2, SPIKE)][0] == "Medium"
    assert grown(10, 15)[(2, SPIKE)][0] == "High"


def test_spike_compares_with_the_previous_present_quarter(spark):
    df = fact(spark, (2, {}), (3, {"quarter": 4, "month": 12}))
    assert (4, SPIKE) in flags_of(df)


def test_register_puts_high_before_medium(spark):
    flags = FL.policy_flags(fact(spark, (84, {"resolution_days": 90.0}), (16, {"status": "Escalated", "resolution_days": 90.0})))
    banks = spark.createDataFrame([(1, "A")], "bank_id int, bank_name string")
    assert [r["severity"] for r in FL.flag_register(flags, banks).collect()] == ["High", "Medium"]


def test_summary_growth_and_conservation(spark):
    df = fact(spark, (2, {}), (3, {"month": 2, "status": "Pending", "resolution_days": None}), (3, {"month": 5, "status": "Escalated"}))
    rows = {r["month"]: r for r in G.monthly_summary(df).collect()}
    assert [rows[m]["complaint_growth_pct"] for m in (1, 2, 5)] == [0.0, 50.0, 0.0]
    assert rows[2]["avg_resolution_days"] is None
    for r in rows.values():
        assert r["total_complaints"] == r["resolved_count"] + r["pending_count"] + r["escalated_count"]


def test_risk_bounds(spark):
    """Days only: score is 0.4 * days / cap * 100, so 60 and 35 need full backlog parts."""
    old = {"status": "Pending", "resolution_days": None, "date": date(2024, 1, 1)}
    # backlog 25 % and ageing 100 % give 30 + 30; mean days 0 is impossible, so use the cap.
    red = wide(spark, (75, {"resolution_days": 0.0}), (25, old))
    row = K.risk_scores(red).first()
    assert (row.risk_score, row.risk_level) == (60.0, "Red")
    just_below = wide(spark, (751, {"resolution_days": 0.0}), (249, old))
    assert K.risk_scores(just_below).first().risk_level == "Amber"
    amber = wide(spark, (100, {"resolution_days": 105.0}))
    row = K.risk_scores(amber).first()
    assert (row.risk_score, row.risk_level) == (35.0, "Amber")
    green = wide(spark, (100, {"resolution_days": 104.9}))
    assert K.risk_scores(green).first().risk_level == "Green"


def test_risk_without_resolved_cases(spark):
    row = K.risk_scores(wide(spark, (3, {"status": "Escalated"}))).first()
    assert row.no_resolved and row.avg_resolution_days == 0.0 and row.risk_score == 0.0


def test_efficiency_puts_unresolved_last(spark):
    df = wide(spark, (2, {}), (2, {"bank_name": "B", "status": "Pending", "resolution_days": None}), (1, {"bank_name": "C", "resolution_days": 10.0}))
    ranks = {r["bank_name"]: r["efficiency_rank"] for r in Q.resolution_efficiency(df).collect()}
    assert ranks == {"A": 1, "C": 1, "B": 3}


def test_yoy_without_earlier_year(spark):
    row = Q.top_banks_yoy(wide(spark, (3, {}))).first()
    assert (row.count_prev, row.count_curr, row.yoy_change_pct) == (0, 3, 0.0)


def test_rising_uses_the_raw_ratio(spark):
    df = wide(
        spark,
        (5, {"quarter": 3}), (6, {"quarter": 4}),
        (100, {"quarter": 3, "category_name": "Y"}), (121, {"quarter": 4, "category_name": "Y"}),
        (4, {"quarter": 4, "category_name": "new"}),
    )
    assert [(r["category_name"], r["qoq_growth_pct"]) for r in Q.rising_categories(df).collect()] == [("Y", 21.0)]


def test_aging_cuts_are_strict(spark):
    def pending(d):
        return {"status": "Pending", "resolution_days": None, "date": d}

    df = wide(spark, (1, pending(date(2024, 12, 1))), (1, pending(date(2024, 11, 30))), (1, pending(date(2024, 10, 1))))
    row = Q.pendency_aging(df).first()
    assert (row.total_pending, row.pending_30_days, row.pending_60_days, row.pending_90_days) == (3, 2, 1, 1)
    assert R.attention_banks(df, period=(2024, 12)).count() == 0 and R.attention_banks(df).count() == 1


def test_heatmap_sums_to_the_cases(spark, sf_dir):
    from casewatch.plans.sample_queries import CATEGORIES, SampleTables

    t = SampleTables(spark, sf_dir)
    total = t.plain.count()
    assert Q.state_heatmap(t.counted).groupBy().sum("complaint_count").first()[0] == total
    for listed in (CATEGORIES, CATEGORIES[:2]):
        assert sum(Q.heatmap_pivot(t.counted, listed).groupBy().sum(*listed, "other").first()) == total
    assert t.fact.count() == total and Q.category_trends(t.counted).groupBy().sum("complaint_count").first()[0] == total


def test_drill_down_and_search(spark):
    df = spark.createDataFrame([(1, "A", "X", "UPI fraud"), (2, "A", "Y", "card (lost)"), (3, "B", "X", None)], "complaint_id int, bank_name string, category_name string, complaint_text string")
    assert [r[0] for r in Q.drill_down(df, search="upi|LOST").select("complaint_id").orderBy("complaint_id").collect()] == [1, 2]
    assert Q.drill_down(df, bank="A", category="Y").count() == 1
    assert Q.text_search(df, "(LOST)", "complaint_text", literal=True).count() == 1


def test_kpi_needs_two_years_for_growth(spark):
    assert Q.kpi_cards(wide(spark, (2, {})), [2024]).first().yoy_growth_pct is None


def test_mis_risk_cut_and_summary_row(spark):
    df = wide(
        spark,
        (1, {"resolution_days": 40.0}), (1, {"bank_name": "B", "resolution_days": 40.1}),
        (2, {"bank_name": "C", "status": "Pending", "resolution_days": None}),
    )
    rows = {r["bank_name"]: r for r in R.with_summary_row(R.mis_bank(df), "bank_name").collect()}
    assert [rows[b]["risk_level"] for b in "ABC"] == ["Medium", "High", "Low"]
    total = rows["Total / System Average"]
    assert total["total_complaints"] == 4 and abs(total["resolution_rate_pct"] - 200 / 3) < 1e-9
    assert R.with_headers(R.mis_bank(df)).columns[:3] == ["Bank Name", "Bank Type", "Total Complaints"]


def test_display_order(spark):
    df = wide(spark, (1, {}), (3, {"state": "T"}), (3, {"state": "R"}))
    assert [r["state"] for r in Q.in_display_order(Q.state_volume(df), "state_volume").collect()] == ["R", "T", "S"]
