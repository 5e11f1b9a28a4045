"""The batch run: raw case file to tables, analyses, models, corpus and report tables.

Steps hand over through written tables in ``out``, and every later step reads only the columns it needs. A step that has ended
leaves a mark with the settings it ran under, so that a run that was stopped can be resumed at the step that had not.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.fixed_values import CHANNELS, SEGMENTS, STATUSES
from casewatch.operators import case_queries as Q
from casewatch.operators import flags as FL
from casewatch.operators import forecast as FC
from casewatch.operators import quality as V
from casewatch.operators import reports as R
from casewatch.operators import retrieval as N
from casewatch.operators import risk as K
from casewatch.operators import star as S
from casewatch.operators import statistics as A
from casewatch.operators import summary as G
from casewatch.operators import text_classes as M
from casewatch.operators.text_features import embed, fit_tfidf
from casewatch.sources import results
from casewatch.sources.files import read_documents_json, write_documents_json, write_table
from casewatch.schemas import KEYS
from casewatch.session import remove, scratch


@dataclass
class Settings:
    """Keyword parameters of the operators; empty means their defaults."""

    window: dict = field(default_factory=dict)
    flags: dict = field(default_factory=dict)
    risk: dict = field(default_factory=dict)
    welch: dict = field(default_factory=dict)
    baselines: dict = field(default_factory=lambda: dict(A.OLS_BASELINES))
    rising: dict = field(default_factory=dict)
    ref_date: str = "2024-12-31"
    report_month: tuple[int, int] = (2024, 12)
    series_by: str | None = None
    domains: Mapping[str, list[str]] = field(
        default_factory=lambda: {"channel": CHANNELS, "status": STATUSES, "customer_segment": SEGMENTS}
    )
    train: bool = True
    classifier: dict = field(default_factory=dict)


def report_tables(wide: DataFrame, forecast: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """The tables behind the monthly executive report."""
    year, month = settings.report_month
    return {
        "headline": R.report_headline(wide, year, month),
        "top_categories": R.report_top_categories(wide, year, month),
        "attention_banks": R.attention_banks(wide, settings.ref_date),
        "rising_categories": Q.rising_categories(wide, **settings.rising, k=2),
        "next_month": R.next_month_forecast(forecast),
    }


def _shaped(df: DataFrame, check: str, *keys: str) -> DataFrame:
    value = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return df.select(F.lit(check).alias("check_name"), value.alias("key_value"), "record_count")


def _together(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def dimension_violations(banks: DataFrame, categories: DataFrame) -> DataFrame:
    """``check_name, key_value, record_count`` of repeated dimension keys, which would stop the load."""
    return _together([
        _shaped(V.dup_keys(df, keys), f"unique {name}({','.join(keys)})", *keys)
        for name, df in (("banks", banks), ("categories", categories)) for keys in KEYS[name]
    ])


def fact_violations(fact: DataFrame, banks: DataFrame, categories: DataFrame, domains: Mapping[str, list[str]]) -> DataFrame:
    """The same columns for the fact's keys, references and domains."""
    found = [_shaped(V.dup_keys(fact, keys), f"unique complaints({','.join(keys)})", *keys) for keys in KEYS["complaints"]]
    found.append(_shaped(V.fk_orphans(fact, banks, "bank_id"), "reference bank_id", "bank_id"))
    found.append(_shaped(V.fk_orphans(fact, categories, "subcategory_id"), "reference subcategory_id", "subcategory_id"))
    if domains:
        found.append(_shaped(V.domain_violations(fact, domains), "domain", "column_name", "value"))
    return _together(found)


def violations(fact: DataFrame, banks: DataFrame, categories: DataFrame, domains: Mapping[str, list[str]]) -> DataFrame:
    """All broken keys, references and domains."""
    return dimension_violations(banks, categories).unionByName(fact_violations(fact, banks, categories, domains))


def _mark(spark: SparkSession, marks: str, name: str) -> str | None:
    """The settings under which a step ended, if it has."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{marks}/{name}/_SUCCESS")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return read_documents_json(spark, f"{marks}/{name}").first()[0]


def run(
    spark: SparkSession, raw: DataFrame, institutions: DataFrame, categories: DataFrame, out: str, settings: Settings | None = None,
    resume: bool = False,
) -> DataFrame:
    """Run all steps and return their log (``step, status, seconds``).

    A failing retrieval step is logged and skipped; any other failure stops the run. With ``resume`` the steps that an earlier run on
    the same input ended in ``out`` under the same settings are kept; from the first other one on, all run.
    """
    settings = settings or Settings()
    log: list[tuple[str, str, float]] = []

    def path(name: str) -> str:
        return f"{out.rstrip('/')}/{name}"

    def table(name: str) -> DataFrame:
        return spark.read.parquet(path(name))

    def save(name: str, df: DataFrame) -> None:
        write_table(df, path(name))

    resuming = resume

    def step(name: str, work: Callable[[], None], may_fail: bool = False) -> None:
        nonlocal resuming
        begin = time.monotonic()
        resuming = resuming and _mark(spark, path("marks"), name) == repr(settings)
        if resuming:
            log.append((name, "kept", 0.0))
            return
        remove(spark, f"{path('marks')}/{name}")
        status = "ok"
        try:
            with scratch(spark):
                work()
        except Exception as problem:
            if not may_fail:
                raise
            status = f"skipped: {type(problem).__name__}"
        else:
            write_documents_json(spark.createDataFrame([(repr(settings),)], "document string"), f"{path('marks')}/{name}")
        log.append((name, status, round(time.monotonic() - begin, 3)))

    def wide() -> DataFrame:
        return table("wide")

    def series() -> DataFrame:
        return G.monthly_series(wide(), settings.series_by)

    def clean() -> None:
        save("raw", raw)  # the incoming file is parsed once
        landed = table("raw")
        done = V.clean_to(landed, path("cases"), **settings.window)
        save("dq_report", done.report)
        lines = V.dq_report_text(table("dq_report")).orderBy("line_no").select("line")  # eight lines
        lines.coalesce(1).write.mode("overwrite").text(path("dq_report_text"))
        save("null_profile", done.nulls)

    def load() -> None:
        save("banks", institutions)
        save("categories", categories)
        save("violations", dimension_violations(table("banks"), table("categories")))  # before a repeated key stops the load
        save("complaints", S.load_fact(table("cases"), table("banks"), table("categories")))
        broken = fact_violations(table("complaints"), table("banks"), table("categories"), settings.domains)
        write_table(broken, path("violations"), mode="append")
        write_table(S.wide_cases(table("complaints"), table("banks"), table("categories")), path("wide"), partition_by=["year"])

    def aggregate() -> None:
        summary = G.monthly_summary(table("complaints"))
        save("monthly_summary", summary.withColumn("summary_id", FL.flag_key("bank_id", "year", "month")))
        flags = FL.policy_flags(table("complaints"), **settings.flags)
        save("policy_flags", flags.withColumn("flag_id", FL.flag_key("bank_id", "year", "quarter", "flag_type")))

    def analyse() -> None:
        cases = wide()
        document = A.statistics_document(
            A.descriptive_stats(cases), A.welch_t(cases, **settings.welch), A.ols_days(cases, settings.baselines),
            A.mann_kendall(A.monthly_count_series(cases, "category_name")),
        )
        write_documents_json(document, path("statistics"))

    def forecast() -> None:
        save("forecast", FC.seasonal_forecast(series()))
        write_documents_json(FC.forecast_document(series(), table("forecast")), path("forecast_documents"))

    def score_risk() -> None:
        save("risk_scores", K.risk_scores(wide(), **settings.risk))
        write_documents_json(results.risk_document(table("risk_scores")), path("risk_documents"))

    def classify() -> None:
        save("split", M.stratified_split(table("cases"), "complaint_category", "complaint_id"))
        split = table("split")
        model = M.train_classifier(split.filter("is_train"), **settings.classifier)
        model.write().overwrite().save(path("classifier"))
        loaded = PipelineModel.load(path("classifier"))
        report = M.classification_report(M.score(loaded, split.filter("NOT is_train")), "complaint_category")
        report.write.mode("overwrite").option("header", True).csv(path("classification_report"))

    def index() -> None:
        docs = N.narrative_corpus(table("monthly_summary"), table("policy_flags"), table("banks"))
        save("narratives", docs)
        model = fit_tfidf(table("narratives"), "page_content", 128)
        model.write().overwrite().save(path("embedder"))
        save("corpus", embed(model, table("narratives")))

    def report() -> None:
        for name, df in report_tables(wide(), table("forecast"), settings).items():
            save(f"report_{name}", df)

    def manage() -> None:
        for name, df in R.mis_tables(wide()).items():
            save(f"mis_{name}", df)

    step("clean", clean)
    step("load", load)
    step("aggregate", aggregate)
    step("statistics", analyse)
    step("forecast", forecast)
    step("risk", score_risk)
    if settings.train:
        step("classifier", classify)
    step("retrieval", index, may_fail=True)
    step("report", report)
    step("management", manage)
    return spark.createDataFrame(log, "step string, status string, seconds double")
