"""Sources, sinks, the batch run, the stream, and the registered queries."""

import os

import pytest

import __spark_entry__ as entry_point
from casewatch.operators import quality as V
from casewatch.plans import pipeline
from casewatch.plans import sample_queries as P
from casewatch.session import new_table_path, scratch, shared_dir
from casewatch.sources import files
from casewatch.streaming import scoring
from tests.frames import raw
from tools.compare import compare, connect


def test_csv_keeps_malformed_lines(spark, tmp_path):
    header = "complaint_id,date,bank_name,bank_type,complaint_category,complaint_subcategory,complaint_text,state,channel,status,resolution_days,customer_segment,year,month,quarter"
    good = 'C1,2024-01-05,A,Public Sector,X,X1,"text, quoted",S,Online,Resolved,12.0,Retail,2024,1,1'
    no_date = "C2,soon,A,Public Sector,X,X1,t,S,Online,Pending,,Retail,2024,1,1"
    broken = "C3,2024-01-05,A,Public Sector,X,X1,t,S,Online,Resolved,many,Retail,2024,1,1"
    path = tmp_path / "cases.csv"
    path.write_text("\n".join([header, good, no_date, broken]) + "\n")
    rows, corrupt = files.split_corrupt(files.read_cases_csv(spark, str(path)))
    assert {r.complaint_id for r in rows.collect()} == {"C1", "C2"} and [r[0] for r in corrupt.collect()] == [broken]
    assert rows.filter("complaint_id = 'C1'").first().complaint_text == "text, quoted"
    assert V.clean_cases(rows).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_cases_csv(spark, str(tmp_path / "missing.csv")).count()


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_round_trip_of_odd_texts(spark, tmp_path, multi_line):
    texts = ['said "stop", then left', 'said "stop" loudly', '"', "", "a,b", "back\\slash", "tab\t end "] + ["line one\nline two"] * multi_line
    cases = raw(spark, *[{"complaint_id": f"C{i}", "complaint_text": t} for i, t in enumerate(texts)])
    files.write_cases_csv(cases, str(tmp_path / "cases"))
    good, bad = files.split_corrupt(files.read_cases_csv(spark, str(tmp_path / "cases"), multi_line=multi_line))
    assert bad.count() == 0
    assert {r.complaint_id: (r.complaint_text or "").strip() for r in good.collect()} == {f"C{i}": t.strip() for i, t in enumerate(texts)}
    assert good.select("state").count() == len(texts)


def test_csv_reports_every_line_whatever_is_read(spark, tmp_path):
    names = files.RAW_CASES.fieldNames()
    whole = ",".join(["C1", "2024-01-05"] + ["x"] * 8 + ["12.0", "Retail", "2024", "1", "1"])
    broken_text = whole.replace("x", '"line one', 1)
    (tmp_path / "cases.csv").write_text("\n".join([",".join(names), whole, "C2,2024-01-05,short", broken_text, whole + ",more"]) + "\n")
    good, bad = files.split_corrupt(files.read_cases_csv(spark, str(tmp_path / "cases.csv")))
    assert good.count() == good.select("complaint_id").count() == 1
    assert bad.count() == 3 and {r[0] for r in bad.collect()} == {"C2,2024-01-05,short", broken_text, whole + ",more"}


def test_tables_overwrite_append_and_partitions(spark):
    df = raw(spark, {}, {"year": 2023}, {"year": 2023})
    path = new_table_path(spark, "t")
    files.write_table(df, path, partition_by=["year"])
    files.write_table(df, path, partition_by=["year"])
    assert files.read_table(spark, path).count() == 3
    files.write_table(df, path, mode="append", partition_by=["year"])
    assert files.read_table(spark, path).filter("year = 2023").count() == 4


def test_shared_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert new_table_path(spark, "a") != new_table_path(spark, "a")


class FakeSession:
    """A session on a cluster without a named folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_scratch_deletes_what_was_made_within(spark):
    kept = new_table_path(spark, "kept")
    with scratch(spark):
        files.write_table(spark.range(3), kept)
        with scratch(spark):
            inner = files.stored(spark.range(5), "inner").inputFiles()
        assert not any(os.path.exists(f.removeprefix("file://")) for f in inner)
        outer = files.stored(spark.range(7), "outer")
        assert outer.count() == 7
    assert not any(os.path.exists(f.removeprefix("file://")) for f in outer.inputFiles())
    assert spark.read.parquet(kept).count() == 3


def test_a_cluster_without_a_shared_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession())


def test_run_writes_every_table(spark, sf_dir):
    t = P.SampleTables(spark, sf_dir)
    out = new_table_path(spark, "run")
    settings = P._settings()
    settings.train = True
    log = pipeline.run(spark, t.raw, t.banks, t.categories, out, settings).collect()
    assert all(r.status == "ok" for r in log), log
    names = set(os.listdir(out.removeprefix("file:")))
    assert {"cases", "dq_report", "dq_report_text", "split", "classifier", "classification_report", "null_profile", "banks", "categories", "complaints", "violations", "monthly_summary", "policy_flags",
            "statistics", "forecast", "forecast_documents", "risk_scores", "risk_documents", "narratives", "corpus", "embedder",
            "report_headline", "report_rising_categories", "mis_bank_performance", "mis_geographic_analysis"} <= names
    found = spark.read.parquet(f"{out}/violations")
    assert {r.check_name for r in found.select("check_name").distinct().collect()} == {"domain"}
    summary = spark.read.parquet(f"{out}/monthly_summary")
    assert summary.select("summary_id").distinct().count() == summary.count()


def test_failing_step_stops_the_run(spark, sf_dir):
    t = P.SampleTables(spark, sf_dir)
    with pytest.raises(Exception, match="cannot be resolved"):
        pipeline.run(spark, t.raw.drop("status"), t.banks, t.categories, new_table_path(spark, "run"), P._settings())


def test_a_stopped_run_resumes_at_its_step(spark, sf_dir, monkeypatch):
    t, out = P.SampleTables(spark, sf_dir), new_table_path(spark, "run")
    settings = P._settings()
    settings.train = False
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.A, "welch_t", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run(spark, t.raw, t.banks, t.categories, out, settings)
    written = {f: spark.read.parquet(f"{out}/{f}").inputFiles() for f in ("cases", "complaints", "monthly_summary")}
    again = {r["step"]: r["status"] for r in pipeline.run(spark, t.raw, t.banks, t.categories, out, settings, resume=True).collect()}
    assert [s for s, status in again.items() if status == "kept"] == ["clean", "load", "aggregate"]
    assert again["statistics"] == again["management"] == "ok"
    assert written == {f: spark.read.parquet(f"{out}/{f}").inputFiles() for f in written}
    settings.ref_date = "2001-01-31"  # other settings: nothing is kept
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.V, "clean_to", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run(spark, t.raw, t.banks, t.categories, out, settings, resume=True)


def test_stream_scores_equal_batch_scores(spark, sf_dir):
    t = P.SampleTables(spark, sf_dir)
    batch = P.QUERIES["score_classifier"](t).select("doc_id", "predicted_category", "confidence")
    stream = P.QUERIES["score_stream"](t)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect()))
    report = {r.label: r for r in P.QUERIES["train_classifier"](t).collect()}
    assert report["accuracy"].f1 > 0.8


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_streams_from_a_file_or_a_folder(spark, tmp_path, parts):
    folder = str(tmp_path / "documents.parquet")
    spark.range(0, 30, 1, parts).selectExpr("id AS doc_id", "concat('text ', id) AS text").write.parquet(folder)
    if parts == 1:  # the one file lies beside others, as a table of the samples does
        spark.range(5).write.parquet(str(tmp_path / "flat" / "other.parquet"))
        (found,) = (tmp_path / "documents.parquet").glob("*.parquet")
        folder = str(tmp_path / "flat" / "documents.parquet")
        os.link(found, folder)
    texts = scoring.read_table_stream(spark, folder, spark.read.parquet(folder).schema)
    scoring.write_scores(texts, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(30))


def test_a_single_file_streams_beside_folders_of_other_tables(spark, tmp_path):
    spark.range(0, 30, 1, 1).selectExpr("id AS doc_id", "concat('text ', id) AS text").write.parquet(str(tmp_path / "made"))
    (found,) = (tmp_path / "made").glob("*.parquet")
    for folder in ("flat", "flat/sub"):  # what lies in a folder below is another table
        (tmp_path / folder).mkdir()
        os.link(found, tmp_path / folder / "documents.parquet")
    for name in ("events", "orders"):
        spark.range(6).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(str(tmp_path / "flat" / f"{name}.parquet"))
    path = str(tmp_path / "flat" / "documents.parquet")
    texts = scoring.read_table_stream(spark, path, spark.read.parquet(path).schema)
    scoring.write_scores(texts, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(30))


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


# One query per family here; ALL_QUERIES=1 compares every one.
SOME = [
    "dim_category", "wide_cases", "null_profile", "repair_days", "dq_report", "domain_violations", "top_banks_yoy", "resolution_efficiency",
    "rising_categories", "kpi_cards", "value_counts", "top_state_trend", "monthly_summary", "policy_flags", "risk_scores", "ols_days",
    "mann_kendall", "compound_growth_forecast", "stratified_split", "classification_report", "tfidf_vectors", "corpus_table",
    "knn_topk_blocks", "retrieval_context", "route_lines", "mis_with_total",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()) if os.environ.get("ALL_QUERIES") else SOME)
def test_query_matches_sql(spark, duck, sf_dir, name):
    verdict = compare(duck, entry_point.oracle_sql()[name], entry_point.queries()[name](spark, sf_dir))
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def test_every_sql_has_its_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_the_registered_run_trains_with_the_defaults():
    assert P._settings().classifier == {}
