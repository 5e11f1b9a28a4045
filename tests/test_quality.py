import pytest
from pyspark.sql import functions as F

from casewatch.fixed_values import CHANNELS, STATUSES
from casewatch.operators import quality as V
from casewatch.operators import star as S
from casewatch.session import new_table_path
from casewatch.sources.files import stored
from tests.frames import raw
from tests.test_scale import input_records


def by_id(df, column):
    return {r["complaint_id"]: r[column] for r in df.collect()}


def test_fill_and_window(spark):
    df = raw(
        spark,
        {"date": "2020-01-01"},
        {"date": "2024-12-31"},
        {"date": "2019-12-31"},
        {"date": "2025-01-01"},
        {"date": "no date"},
        {"date": None},
        {"status": None, "channel": None},
    )
    cleaned = V.clean_cases(df)
    assert sorted(by_id(cleaned, "status")) == ["C0", "C1", "C6"]
    row = cleaned.filter("complaint_id = 'C6'").first()
    assert (row["status"], row["channel"]) == ("Unknown", "Unknown")
    assert {r["outcome"]: r["record_count"] for r in V.date_window(df).collect()} == {"kept": 3, "out_of_range": 2, "unparseable": 2}
    report = V.dq_report(df).first()
    assert (report.total_records_ingested, report.total_records_processed, report.invalid_dates_dropped) == (7, 3, 4)
    assert report.overall_null_percentage == round(3 / 33 * 100, 4)
    nulls = {r["column_name"]: r["null_count"] for r in V.null_profile(df).collect()}
    assert nulls["date"] == nulls["status"] == nulls["channel"] == 1 and nulls["state"] == 0
    # unknown values left by filling are reported, not fatal
    bad = V.domain_violations(cleaned, {"status": STATUSES, "channel": CHANNELS}).collect()
    assert sorted((r["column_name"], r["value"], r["record_count"]) for r in bad) == [("channel", "Unknown", 1), ("status", "Unknown", 1)]


def test_repair_uses_median_of_positive_days_of_non_pending(spark):
    df = raw(
        spark,
        {"resolution_days": 4.0},
        {"resolution_days": 8.0, "status": "Escalated"},
        {"resolution_days": 99.0, "status": "Pending"},
        {"resolution_days": None},
        {"resolution_days": 0.0},
        {"resolution_days": -1.0, "status": "Escalated"},
        {"resolution_days": None, "status": "Escalated"},
    )
    days = by_id(V.clean_cases(df), "resolution_days")
    assert days == {"C0": 4.0, "C1": 8.0, "C2": None, "C3": 6.0, "C4": 6.0, "C5": -1.0, "C6": None}
    assert V.dq_report(df).first().invalid_resolution_days_fixed == 3


@pytest.mark.parametrize("options", [{}, {"start": "2024-03-01", "end": "2024-03-31"}, {"fallback_days": 12}])
def test_a_cleaning_run_equals_its_parts(spark, options):
    df = stored(raw(
        spark,
        {"resolution_days": 4.0}, {"resolution_days": 8.0, "status": "Escalated"}, {"resolution_days": 99.0, "status": "Pending"},
        {"resolution_days": None}, {"resolution_days": 0.0, "date": "2020-01-01"}, {"status": None, "channel": None}, {"date": "no date"},
        {"date": None}, {"date": "2030-01-01", "state": None}, *[{"resolution_days": float(i % 5)} for i in range(400)], {"resolution_days": 900.0},
    ), "raw")
    rows = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    before = input_records(spark)
    done = V.clean_to(df, new_table_path(spark, "cleaned"), **options)
    assert input_records(spark) - before <= 2 * df.count() + 60  # two scans, and the small table of counts
    assert rows(done.cases) == rows(V.clean_cases(df, **options)) and done.cases.columns == df.columns
    assert rows(done.report) == rows(V.dq_report(df, **options))
    assert rows(done.nulls) == rows(V.null_profile(df))


def test_a_cleaning_run_of_nothing(spark):
    df = raw(spark, {}).limit(0)
    done = V.clean_to(df, new_table_path(spark, "cleaned"))
    assert done.cases.count() == 0 and done.report.first().total_records_ingested == 0
    assert {r["null_count"] for r in done.nulls.collect()} == {0}


def test_repair_falls_back_without_usable_days(spark):
    df = raw(spark, {"resolution_days": None}, {"resolution_days": None})
    assert set(by_id(V.clean_cases(df), "resolution_days").values()) == {30.0}
    assert set(by_id(V.clean_cases(df, fallback_days=12), "resolution_days").values()) == {12.0}


def test_repair_by_group(spark):
    df = raw(
        spark,
        {"resolution_days": 4.0},
        {"resolution_days": None},
        {"resolution_days": 50.0, "bank_type": "Private Sector"},
        {"resolution_days": None, "bank_type": "Private Sector"},
        {"resolution_days": None, "bank_type": "Small Finance Bank"},
    )
    days = by_id(V.repair_days(df, group_col="bank_type"), "resolution_days")
    assert days == {"C0": 4.0, "C1": 4.0, "C2": 50.0, "C3": 50.0, "C4": 30.0}


def test_z_score_bound_is_strict(spark):
    # 0 x 9, one at distance: with n = 11 values 0*10 and v, z of v is 10/sqrt(11) = 3.015
    over = raw(spark, *[{"resolution_days": 1.0}] * 10, {"resolution_days": 100.0})
    assert V.zscore_outliers(over).count() == 1
    assert V.dq_report(over).first().resolution_days_outliers_flagged == 1
    assert V.flag_outliers(over).filter("is_outlier").count() == 1 and V.flag_outliers(over).count() == 11
    # n = 10: z of v is 9/sqrt(10) = 2.846
    under = raw(spark, *[{"resolution_days": 1.0}] * 9, {"resolution_days": 100.0})
    assert V.zscore_outliers(under).count() == 0
    constant = raw(spark, *[{"resolution_days": 5.0}] * 4)
    assert V.zscore_outliers(constant).count() == 0
    assert V.dq_report(constant).first().resolution_days_outliers_flagged == 0


def test_z_of_exactly_three_is_no_outlier(spark):
    # Symmetric values +-3 and 16 zeros: the sample variance is 18 / 17... scaled so that |z| = 3
    # holds exactly: 2 values at +-3, and 17 zeros give variance 18 / 18 = 1.
    df = raw(spark, {"resolution_days": 3.0}, {"resolution_days": -3.0}, *[{"resolution_days": 0.0}] * 17)
    assert V.zscore_outliers(df).count() == 0
    assert V.zscore_outliers(df, z=2.999).count() == 2


def test_empty_input(spark):
    empty = raw(spark, {}).filter("1 = 0")
    report = V.dq_report(empty).first()
    assert report.total_records_ingested == 0 and report.outlier_percentage == 0.0 and report.overall_null_percentage == 0.0
    assert V.clean_cases(empty).count() == 0


def test_report_text(spark):
    lines = [r["line"] for r in V.dq_report_text(V.dq_report(raw(spark, {}, {}))).orderBy("line_no").collect()]
    assert lines[0] == "Total Records Ingested: 2" and lines[-1] == "Invalid Records %: 0.0%"


def test_constraints(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    facts = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    assert {(r["k"], r["record_count"]) for r in V.fk_orphans(facts, dim, "k").collect()} == {(3, 2), (None, 1)}
    assert [(r["k"], r["record_count"]) for r in V.dup_keys(facts, ["k"]).collect()] == [(3, 2)]


def test_repeated_dimension_key_fails_instead_of_fanning_out(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    facts = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(Exception, match="not unique"):
        facts.join(V.unique_dimension(dim, ["k"]), "k").collect()


def test_literal_dimensions(spark):
    banks = S.institution_dimension(spark)
    assert banks.count() == 20 and banks.filter("bank_id = 1").first().bank_name == "SBI"
    categories = S.category_dimension(spark)
    assert categories.count() == 36
    row = categories.filter("subcategory_id = 35").first()
    assert (row.category_id, row.category_name, row.subcategory_name) == (12, "Other", "Long Wait Times at Branch")
    uneven = S.category_dimension(spark, {"a": ["x"], "b": ["y", "z"], "c": ["w"]})
    assert {r["subcategory_name"]: r["subcategory_id"] for r in uneven.collect()} == {"x": 1, "y": 2, "z": 3, "w": 4}


def test_load_fact_keeps_unknown_names(spark):
    df = raw(spark, {"bank_name": "SBI", "complaint_subcategory": "SIM Clone Fraud", "resolution_days": float("nan")},
             {"bank_name": "nobody", "complaint_subcategory": "nothing"})
    fact = S.load_fact(V.keep_window(df), S.institution_dimension(spark), S.category_dimension(spark))
    rows = {r["complaint_id"]: r for r in fact.collect()}
    assert (rows["C0"].bank_id, rows["C0"].category_id, rows["C0"].subcategory_id, rows["C0"].resolution_days) == (1, 1, 3, None)
    assert rows["C1"].bank_id is None and len(fact.columns) == 14
    wide = S.wide_cases(fact, S.institution_dimension(spark), S.category_dimension(spark))
    named = {r["complaint_id"]: (r["bank_name"], r["category_name"]) for r in wide.collect()}
    assert named == {"C0": ("SBI", "Digital Banking Fraud"), "C1": ("Unknown", "Unknown")}


def test_derived_category_ids_are_dense(spark, sf_dir):
    from casewatch.sources.sample_tables import category_pairs

    dim = S.category_dimension_from(category_pairs(spark, sf_dir))
    n = dim.count()
    ids = sorted(r[0] for r in dim.select("subcategory_id").collect())
    assert ids == list(range(1, n + 1))
    assert dim.select(F.max("category_id")).first()[0] == dim.select("category_name").distinct().count()
