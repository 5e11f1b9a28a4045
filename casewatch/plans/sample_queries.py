"""Every operator applied to the sample tables.

``SampleTables`` derives the library's tables lazily from the sample parquet files;
``QUERIES`` names one frame per operator. Parameters fit the sample's dates and values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.functions.columns import contains_any, first_match
from casewatch.operators import case_queries as Q
from casewatch.operators import flags as FL
from casewatch.operators import forecast as FC
from casewatch.operators import long_trend as LT
from casewatch.operators import quality as V
from casewatch.operators import refresh as RF
from casewatch.operators import reports as R
from casewatch.operators import retrieval as N
from casewatch.operators import risk as K
from casewatch.operators import star as S
from casewatch.operators import star_tables as ST
from casewatch.operators import statistics as A
from casewatch.operators import summary as G
from casewatch.operators import text_classes as M
from casewatch.operators import text_index as TI
from casewatch.operators import vector_store as VS
from casewatch.operators.text_features import embed, fit_tfidf, tfidf_weights
from casewatch.plans import pipeline
from casewatch.session import new_table_path
from casewatch.sources import files, results
from casewatch.sources import sample_tables as sample
from casewatch.streaming import scoring

WINDOW = sample.WINDOW
REF = sample.REF_DATE
FLAG_RULES = {"min_n": 20, "delay_days": 120, "escalation_pct": 15, "spike_pct": 25, "high_spike_pct": 40}
RISK_RULES = {"ref_date": REF, "days_cap": 240}
RISING = {"prev": (2001, 1), "curr": (2001, 2)}
WELCH = {"a": "ASIA", "b": "EUROPE"}
BASELINES = {"bank_type": "AFRICA", "channel": "5-LOW", "category_name": "Unknown"}
KPI_YEARS = [1999, 2000]
CATEGORY = "ECONOMY"
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "Unknown"]
REPORT_MONTH = (2001, 6)
# Values allowed by the sample's own domain check; '5-LOW' and 'Escalated' are left out so
# that the check has something to find.
DOMAINS = {"channel": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"], "status": ["Resolved", "Pending"]}
LETTER_RULES = [("de", ["ß", "ä", "ö", "ü"]), ("es", ["ñ", "¿", "í", "ó"]), ("fr", ["ç", "è", "ê", "é"])]
SEARCH = r"licen[sc]e|copyright"


class SampleTables:
    """The library's tables over one folder of sample files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return sample.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return sample.raw_cases(self.spark, self.sf_dir)

    @cached_property
    def cases(self) -> DataFrame:
        return V.clean_cases(self.raw, **WINDOW)

    @cached_property
    def kept(self) -> DataFrame:
        """Cases inside the window with days not yet repaired."""
        return V.keep_window(V.fill_required(self.raw), **WINDOW)

    @cached_property
    def wide(self) -> DataFrame:
        return S.as_wide(self.cases)

    def _kept(self, **parts: bool) -> DataFrame:
        return S.as_wide(V.keep_window(V.fill_required(sample.raw_cases(self.spark, self.sf_dir, **parts)), **WINDOW))

    @cached_property
    def counted(self) -> DataFrame:
        """The wide table for queries that do not read days: no repair is needed."""
        return self._kept(days=False)

    @cached_property
    def plain(self) -> DataFrame:
        """The wide table for queries that read neither days nor category: no order lines."""
        return self._kept(days=False, category=False)

    @cached_property
    def timed(self) -> DataFrame:
        """The wide table for queries that read days but no category."""
        raw = sample.raw_cases(self.spark, self.sf_dir, category=False)
        return S.as_wide(V.clean_cases(raw, **WINDOW))

    @cached_property
    def banks(self) -> DataFrame:
        return sample.institutions(self.spark, self.sf_dir)

    @cached_property
    def categories(self) -> DataFrame:
        return S.category_dimension_from(sample.category_pairs(self.spark, self.sf_dir))

    @cached_property
    def fact(self) -> DataFrame:
        return S.load_fact(self.cases, self.banks, self.categories)

    @cached_property
    def summary(self) -> DataFrame:
        return G.monthly_summary(self.fact)

    @cached_property
    def flags(self) -> DataFrame:
        return FL.policy_flags(self.fact, **FLAG_RULES)

    @cached_property
    def narratives(self) -> DataFrame:
        return N.narrative_corpus(self.summary, self.flags, self.banks)

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", F.col("text"), F.col("source").alias("channel"), F.col("lang").alias("label"))

    @cached_property
    def split(self) -> DataFrame:
        return M.stratified_split(self.documents, "label", "doc_id")

    @property
    def train(self) -> DataFrame:
        return self.split.filter("is_train").drop("is_train")

    @property
    def held_out(self) -> DataFrame:
        return self.split.filter("NOT is_train").drop("is_train")

    @property
    def model(self) -> PipelineModel:
        """The classifier, trained once per session and folder, saved and loaded again."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _MODELS:
            path = new_table_path(self.spark, "classifier")
            train = files.stored(self.train, "train")
            M.train_classifier(train, "text", "channel", "label").write().save(path)
            _MODELS[key] = path
        return PipelineModel.load(_MODELS[key])

    @property
    def questions(self) -> DataFrame:
        """One question per institution, from the institution table."""
        text = F.concat(F.lit("Which months had the highest complaint growth for "), "bank_name", F.lit("?"))
        return self.banks.select(F.col("bank_id").alias("question_id"), text.alias("question"))


_MODELS: dict[tuple[str, str], str] = {}


def _letter_prediction(t: SampleTables) -> DataFrame:
    rules = [(name, contains_any(F.col("text"), letters)) for name, letters in LETTER_RULES]
    return t.table("documents").select("doc_id", F.col("lang").alias("label"), first_match(rules, "en").alias("predicted_category"))


def _csv_round_trip(t: SampleTables) -> DataFrame:
    path = new_table_path(t.spark, "raw-csv")
    files.write_cases_csv(t.raw, path)
    good, _ = files.split_corrupt(files.read_cases_csv(t.spark, path))
    return V.clean_cases(good, **WINDOW).withColumn("complaint_id", F.col("complaint_id").cast("long"))


def _vectors(t: SampleTables, key: str) -> DataFrame:
    return t.table("embeddings").select(F.col("vec_id").alias(key), "embedding")


def _knn(t: SampleTables, **options) -> DataFrame:
    return N.knn_topk(_vectors(t, "question_id"), _vectors(t, "doc_id"), k=5, exclude_self=True, **options)


def _document_corpus(t: SampleTables) -> DataFrame:
    meta = F.create_map(F.lit("source"), F.col("source"), F.lit("bank_name"), F.col("lang"))
    return t.table("documents").select("doc_id", F.col("text").alias("page_content"), meta.alias("metadata"))


def _narrative_search(t: SampleTables) -> DataFrame:
    docs = files.stored(t.narratives, "narratives")
    model = fit_tfidf(docs, "page_content", 128)
    corpus = embed(model, docs)
    asked = embed(model, t.questions.withColumnRenamed("question", "page_content")).select("question_id", "embedding")
    hits = N.knn_topk(asked, corpus, k=5)
    return N.template_answers(t.questions, N.retrieval_context(hits, docs))


def _index_search(t: SampleTables) -> DataFrame:
    path = new_table_path(t.spark, "text-index")
    TI.build_index(t.table("documents").select("doc_id", "text"), path)
    return TI.index_search(t.spark, path, SEARCH).select("doc_id")


def _long_trend(t: SampleTables) -> DataFrame:
    """The prices of orders, by priority in the order of keys."""
    points = t.table("orders").selectExpr("o_orderpriority AS series", "o_orderkey AS at", "o_totalprice AS value")
    return LT.long_trend(points).select("series", "n", "s_statistic", "tau")


def _by_date(t: SampleTables) -> DataFrame:
    """One month of the cases, read from files in the order of dates."""
    path = new_table_path(t.spark, "by-date")
    files.write_sorted(t.cases, path, ["date"], ["complaint_id"])
    return files.read_table(t.spark, path).filter("date BETWEEN '2000-03-01' AND '2000-03-31'")


def _clean_run(t: SampleTables) -> V.CleanRun:
    """Cleaning with its metrics, from the landed case file."""
    return V.clean_to(files.stored(t.raw, "landed"), new_table_path(t.spark, "cleaned"), **WINDOW)


def _star(t: SampleTables) -> DataFrame:
    """The fact with category names, joined in bucketed tables."""
    path = new_table_path(t.spark, "star")
    ST.save_star(t.fact, t.categories, path)
    return ST.category_cases(ST.open_star(t.spark, path))


def _refreshed(t: SampleTables, table: str) -> DataFrame:
    """A table after a load of all cases but those of one month, and a refresh by these."""
    path = new_table_path(t.spark, "refreshed")
    fact = files.stored(t.fact, "fact")
    late = (F.col("year") == 2000) & (F.col("month") == 3)
    RF.refresh(fact.filter(~late), path, **FLAG_RULES)
    RF.refresh(fact.filter(late), path, **FLAG_RULES)
    return RF.refreshed(t.spark, path, table)


def _store(t: SampleTables, docs: DataFrame, **options) -> VS.Store:
    """The corpus written as a vector store and opened again."""
    path = new_table_path(t.spark, "vectors")
    VS.create_store(docs, path, **options)
    return VS.open_store(t.spark, path)


def _store_search(t: SampleTables) -> DataFrame:
    store = _store(t, _vectors(t, "doc_id"))
    return VS.search(store, _vectors(t, "question_id"), exact=True, exclude_self=True)


def _narrative_store(t: SampleTables) -> VS.Store:
    docs = files.stored(t.narratives, "narratives")
    return _store(t, docs, embedder=fit_tfidf(docs, "page_content", 128))


def _store_answers(t: SampleTables) -> DataFrame:
    store = _narrative_store(t)
    hits = VS.ask(store, t.questions, "page_content")
    return N.template_answers(t.questions, N.retrieval_context(hits, store.docs))


def _bucket_neighbours(t: SampleTables) -> DataFrame:
    """Narratives most like each narrative, by hash buckets."""
    docs = _narrative_store(t).docs
    return VS.bucket_topk(docs.select(F.col("doc_id").alias("question_id"), "embedding"), docs, exclude_self=True)


def _embedded_corpus(t: SampleTables) -> DataFrame:
    docs = files.stored(t.narratives, "narratives")
    return tfidf_weights(fit_tfidf(docs, "page_content", 128), docs, "doc_id")


def _statistics(t: SampleTables) -> DataFrame:
    wide = files.stored(t.wide, "wide")
    return A.statistics_document(
        A.descriptive_stats(wide), A.welch_t(wide, **WELCH), A.ols_days(wide, BASELINES),
        A.mann_kendall(A.monthly_count_series(wide, "category_name")),
    )


def _forecast_rows(t: SampleTables) -> DataFrame:
    series = G.monthly_series(t.plain, "bank_type")
    documents = FC.forecast_document(series, FC.compound_growth_forecast(series))
    return results.forecast_rows(documents)


def _stream(t: SampleTables) -> DataFrame:
    path, checkpoint = new_table_path(t.spark, "scores"), new_table_path(t.spark, "scores-checkpoint")
    schema = t.table("documents").schema
    texts = scoring.read_table_stream(t.spark, f"{t.sf_dir.rstrip('/')}/documents.parquet", schema).withColumnsRenamed({"source": "channel"})
    scoring.write_scores(scoring.score_stream(t.model, texts.select("doc_id", "text", "channel")), path, checkpoint).awaitTermination()
    return files.read_table(t.spark, path).select("doc_id", "predicted_category", "confidence")


def _settings() -> pipeline.Settings:
    return pipeline.Settings(
        window=WINDOW, flags=FLAG_RULES, risk=RISK_RULES, welch=WELCH, baselines=BASELINES, rising=RISING,
        ref_date=REF, report_month=REPORT_MONTH, series_by="bank_type", domains=DOMAINS,
    )


def _pipeline(t: SampleTables) -> DataFrame:
    """Rows of the tables that a whole run, training included, leaves behind."""
    out = new_table_path(t.spark, "run")
    pipeline.run(t.spark, t.raw, t.banks, t.categories, out, _settings())
    counts = [
        files.read_table(t.spark, f"{out}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("record_count"))
        for name in ("raw", "cases", "banks", "complaints", "wide", "split", "monthly_summary", "policy_flags", "risk_scores")
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def _report(t: SampleTables) -> DataFrame:
    """The report bundle in long form: ``table_name, row_json``."""
    wide = files.stored(t.wide, "wide")
    forecast = FC.compound_growth_forecast(G.monthly_series(wide, "bank_type"))
    parts = [
        df.select(F.lit(name).alias("table_name"), F.to_json(F.struct(*df.columns)).alias("row_json"))
        for name, df in pipeline.report_tables(wide, forecast, _settings()).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _mis(t: SampleTables) -> DataFrame:
    """The management bundle in long form, with presentation headers."""
    wide = files.stored(t.wide, "wide")
    parts = []
    for name, df in R.mis_tables(wide).items():
        shown = R.with_headers(df)
        parts.append(shown.select(F.lit(name).alias("table_name"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in shown.columns])).alias("row_json")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _routes(t: SampleTables) -> DataFrame:
    """Routes of questions read from the conversations, with the canned lines' texts."""
    asked = t.table("conversations").filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    return N.route_questions(asked).select("conv_id", "turn", "route")


def _route_lines(t: SampleTables) -> DataFrame:
    growth = N.route_lines("growth", G.high_growth_months(t.summary, t.banks))
    states = N.route_lines("fraud_states", Q.category_top_states(t.counted, CATEGORY))
    return growth.unionByName(states).unionByName(N.route_lines("flags", FL.flag_sample(t.flags, t.banks)))


QUERIES: dict[str, Callable[[SampleTables], DataFrame]] = {
    # sources and sinks
    "read_cases_csv": _csv_round_trip,
    "write_table": lambda t: files.stored(t.cases, "cases"),
    "dim_institution": lambda t: t.banks,
    "dim_category": lambda t: t.categories,
    "load_fact": lambda t: t.fact,
    "wide_cases": lambda t: S.wide_cases(t.fact, t.banks, t.categories),
    "results_json": _statistics,
    "flatten_results_json": lambda t: results.statistics_rows(_statistics(t)),
    "flatten_forecast_json": _forecast_rows,
    "flatten_risk_json": lambda t: results.risk_rows(results.risk_document(K.risk_scores(t.timed, **RISK_RULES))),
    # validation and cleaning
    "null_profile": lambda t: V.null_profile(t.raw),
    "date_window": lambda t: V.date_window(t.raw, **WINDOW),
    "repair_days": lambda t: V.repair_days(t.kept).select("complaint_id", "status", "resolution_days"),
    "clean_cases": lambda t: t.cases,
    "dq_report": lambda t: V.dq_report(t.raw, **WINDOW),
    "clean_run_cases": lambda t: _clean_run(t).cases,
    "clean_run_report": lambda t: _clean_run(t).report,
    "clean_run_nulls": lambda t: _clean_run(t).nulls,
    "flag_outliers": lambda t: V.flag_outliers(t.cases).select("complaint_id", "resolution_days", "is_outlier"),
    "zscore_outliers": lambda t: V.zscore_outliers(t.cases),
    "calendar_parts": lambda t: V.calendar_parts(t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))),
    "dup_keys": lambda t: V.dup_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"]),
    "domain_violations": lambda t: V.domain_violations(t.plain, DOMAINS),
    # Orders against the customers in credit, so that there is something to find.
    "fk_orphans": lambda t: V.fk_orphans(t.table("orders").select("o_custkey"), t.table("customer").filter("c_acctbal > 0"), "o_custkey", "c_custkey"),
    # queries
    "top_banks_yoy": lambda t: Q.top_banks_yoy(t.plain, 1999, 2000),
    "category_trends": lambda t: Q.category_trends(t.counted),
    "resolution_efficiency": lambda t: Q.resolution_efficiency(t.timed),
    "state_heatmap": lambda t: Q.state_heatmap(t.counted),
    "heatmap_pivot": lambda t: Q.heatmap_pivot(t.counted, [c for c in CATEGORIES if c != "Unknown"]),
    "pendency_aging": lambda t: Q.pendency_aging(t.plain, REF),
    "rising_categories": lambda t: Q.rising_categories(t.counted, **RISING),
    "kpi_cards": lambda t: Q.kpi_cards(t.timed, KPI_YEARS, ["ASIA", "EUROPE"]),
    "monthly_trend": lambda t: Q.monthly_trend(t.plain),
    "value_counts": lambda t: Q.value_counts_of_all(t.counted, ["category_name", "channel", "customer_segment", "bank_name"]),
    "distinct_values": lambda t: Q.distinct_values(t.plain, "bank_name"),
    "status_share": lambda t: Q.value_share(t.plain),
    "quarter_category_volumes": lambda t: Q.quarter_category_volumes(Q.drill_down(t.counted, bank="NATION_7", search="order .*1")),
    "top_subcategories": lambda t: Q.top_subcategories(t.counted),
    "state_volume": lambda t: Q.state_volume(t.plain),
    "top_state_trend": lambda t: Q.top_state_trend(t.plain),
    "top_banks_typed": lambda t: Q.top_banks_typed(t.plain),
    "category_monthly": lambda t: Q.category_monthly(t.counted, CATEGORY),
    "category_top_states": lambda t: Q.category_top_states(t.counted, CATEGORY),
    "text_search": lambda t: Q.text_search(t.table("documents").select("doc_id", "text"), SEARCH).select("doc_id"),
    "text_index_search": _index_search,
    "write_sorted": _by_date,
    # the star in bucketed tables
    "star_category_trends": lambda t: Q.category_trends(_star(t)),
    "star_state_heatmap": lambda t: Q.state_heatmap(_star(t)),
    "star_rising_categories": lambda t: Q.rising_categories(_star(t), **RISING),
    "star_report_top_categories": lambda t: R.report_top_categories(_star(t), *REPORT_MONTH),
    # summary, flags, risk
    "refreshed_summary": lambda t: _refreshed(t, "monthly_summary"),
    "refreshed_flags": lambda t: _refreshed(t, "policy_flags"),
    "monthly_summary": lambda t: t.summary,
    "high_growth_months": lambda t: G.high_growth_months(t.summary, t.banks),
    "policy_flags": lambda t: t.flags,
    "flag_register": lambda t: FL.flag_register(t.flags, t.banks),
    "flag_sample": lambda t: FL.flag_sample(t.flags, t.banks),
    "risk_scores": lambda t: K.risk_scores(t.timed, **RISK_RULES),
    # statistics
    "descriptive_stats": lambda t: A.descriptive_stats(t.timed),
    "box_summary": lambda t: A.box_summary(t.timed),
    "overall_mean": lambda t: A.overall_mean(t.timed),
    "welch_t": lambda t: A.welch_t(t.timed, **WELCH),
    "ols_days": lambda t: A.ols_days(t.wide, BASELINES),
    "ols_simple": lambda t: A.ols_simple(t.timed.filter("resolution_days IS NOT NULL"), "resolution_days", "month", "bank_type"),
    "mann_kendall": lambda t: A.mann_kendall(A.monthly_count_series(t.plain, "bank_name")),
    "long_trend": _long_trend,
    # series and forecasts
    "monthly_series": lambda t: G.monthly_series(t.plain),
    "series_arrays": lambda t: G.series_arrays(G.monthly_series(t.plain, "bank_name")),
    "compound_growth_forecast": lambda t: FC.compound_growth_forecast(G.monthly_series(t.plain, "bank_name")),
    "seasonal_forecast": lambda t: FC.seasonal_forecast(G.monthly_series(t.plain, "bank_name")),
    # text classification
    "stratified_split": lambda t: t.split.select("doc_id", "label", "is_train"),
    "keyword_classify": lambda t: M.keyword_classify(t.table("documents"), "doc_id", "text"),
    "classification_report": lambda t: M.classification_report(_letter_prediction(t)),
    "confusion_matrix": lambda t: M.confusion_matrix(_letter_prediction(t), ["de", "en", "es"]),
    "tfidf_vectors": lambda t: tfidf_weights(fit_tfidf(t.documents, "text", 500), t.documents, "doc_id"),
    "train_classifier": lambda t: M.classification_report(M.score(t.model, t.held_out)),
    "score_classifier": lambda t: M.score(t.model, t.documents).select("doc_id", "label", "predicted_category", "confidence"),
    "class_probabilities": lambda t: M.class_probabilities(t.model, t.documents, "doc_id"),
    "score_stream": _stream,
    # narratives and retrieval
    "summary_narratives": lambda t: N.summary_narratives(t.summary, t.banks),
    "flag_narratives": lambda t: N.flag_narratives(t.flags, t.banks),
    "corpus_table": lambda t: files.stored(t.narratives, "corpus"),
    "embed_corpus": _embedded_corpus,
    "knn_topk": _knn,
    "knn_topk_blocks": lambda t: _knn(t, questions_per_block=100, docs_per_block=150),
    "vector_store_search": _store_search,
    "corpus_store": lambda t: _narrative_store(t).docs.select("doc_id", "page_content", "metadata"),
    "store_answers": _store_answers,
    "bucket_topk": _bucket_neighbours,
    "retrieval_context": lambda t: N.retrieval_context(_knn(t), _document_corpus(t)),
    "narrative_search": _narrative_search,
    "question_routes": _routes,
    "route_lines": _route_lines,
    # reports
    "mis_bank": lambda t: R.mis_bank(t.timed),
    "category_breakdown": lambda t: R.category_breakdown(t.counted),
    "mis_geo": lambda t: R.mis_geo(t.plain),
    "mis_with_total": lambda t: R.with_summary_row(R.mis_bank(t.timed), "bank_name"),
    "report_headline": lambda t: R.report_headline(t.timed, *REPORT_MONTH),
    "report_top_categories": lambda t: R.report_top_categories(t.counted, *REPORT_MONTH),
    "attention_banks": lambda t: R.attention_banks(t.plain, REF),
    "report_tables": _report,
    "mis_tables": _mis,
    "run_pipeline": _pipeline,
}


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types for comparison with another engine: doubles to six places, dates
    and nested values as text."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[SampleTables], DataFrame]):
        return lambda spark, sf_dir: comparable(build(SampleTables(spark, sf_dir)))

    return {name: bind(build) for name, build in QUERIES.items()}
