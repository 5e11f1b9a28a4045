"""The queries of ``casewatch.plans.sample_queries`` written independently in DuckDB SQL.

Doubles are rounded to six places, dates are text, nested values are JSON text, as in
``comparable``.
"""

from __future__ import annotations

RAW = """raw AS (
  SELECT o_orderkey AS complaint_id, CAST(o_orderdate AS DATE) AS date, n_nationkey AS bank_id,
         n_name AS bank_name, r_name AS bank_type, p_type AS complaint_category,
         p_type || '/' || p_brand AS complaint_subcategory,
         'Order ' || CAST(o_orderkey AS VARCHAR) || ' of ' || c_name AS complaint_text,
         'STATE_' || CAST(o_custkey % 36 AS VARCHAR) AS state, o_orderpriority AS channel,
         CASE WHEN o_orderkey % 100 < 82 THEN 'Resolved' WHEN o_orderkey % 100 < 92 THEN 'Pending' ELSE 'Escalated' END AS status,
         c_mktsegment AS customer_segment,
         CASE WHEN o_orderkey % 100 BETWEEN 82 AND 91 AND o_orderkey % 3 <> 0 THEN NULL
              ELSE CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(last_ship AS DATE)) % 220
                        + CASE WHEN o_orderkey % 67 = 0 THEN 400 ELSE 0 END AS DOUBLE) END AS resolution_days,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(quarter(o_orderdate) AS INTEGER) AS quarter
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS first_part, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey
  LEFT JOIN part ON first_part = p_partkey
)"""

CASES = RAW + """, kept AS (
  SELECT * REPLACE (coalesce(complaint_category, 'Unknown') AS complaint_category,
                    coalesce(complaint_subcategory, 'Unknown') AS complaint_subcategory)
  FROM raw WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-06-30'
), mid AS (
  SELECT coalesce(median(resolution_days), 30.0) AS m FROM kept WHERE status <> 'Pending' AND resolution_days > 0
), cases AS (
  SELECT * REPLACE (CASE WHEN status = 'Pending' THEN NULL
                         WHEN status = 'Resolved' AND (resolution_days IS NULL OR resolution_days <= 0) THEN m
                         ELSE resolution_days END AS resolution_days)
  FROM kept, mid
), wide AS (
  SELECT * EXCLUDE (m) RENAME (complaint_category AS category_name, complaint_subcategory AS subcategory_name) FROM cases
)"""

DIM = """pairs AS (
  SELECT DISTINCT p_type AS category_name, p_type || '/' || p_brand AS subcategory_name FROM part
  UNION ALL SELECT 'Unknown', 'Unknown'
), categories AS (
  SELECT CAST(dense_rank() OVER (ORDER BY category_name) AS INTEGER) AS category_id, category_name,
         CAST(row_number() OVER (ORDER BY category_name, subcategory_name) AS INTEGER) AS subcategory_id, subcategory_name
  FROM pairs
)"""

SUMMARY = CASES + """, monthly AS (
  SELECT bank_id, year, month, count(*) AS total_complaints,
         count(*) FILTER (status = 'Resolved') AS resolved_count, count(*) FILTER (status = 'Pending') AS pending_count,
         count(*) FILTER (status = 'Escalated') AS escalated_count, avg(resolution_days) AS avg_resolution_days
  FROM cases GROUP BY ALL
), summary AS (
  SELECT *, coalesce(round_even((total_complaints - before) / CAST(before AS DOUBLE) * 100, 2), 0.0) AS complaint_growth_pct
  FROM (SELECT *, lag(total_complaints) OVER (PARTITION BY bank_id ORDER BY year, month) AS before FROM monthly)
)"""

FLAGS = CASES + """, q AS (
  SELECT bank_id, year, quarter, count(*) AS total, avg(resolution_days) AS avg_days,
         count(*) FILTER (status = 'Escalated') / CAST(count(*) AS DOUBLE) * 100 AS esc
  FROM cases GROUP BY ALL
), g AS (
  SELECT *, (total - before) / CAST(before AS DOUBLE) * 100 AS growth
  FROM (SELECT *, lag(total) OVER (PARTITION BY bank_id ORDER BY year, quarter) AS before FROM q)
), flags AS (
  SELECT bank_id, year, quarter, 'Supervisory Delay Alert' AS flag_type,
         'Average resolution days reached ' || CAST(round_even(avg_days, 1) AS VARCHAR)
         || ' days, exceeding supervision SLA (60 days).' AS flag_description, 'High' AS severity
  FROM g WHERE total >= 20 AND avg_days > 120
  UNION ALL
  SELECT bank_id, year, quarter, 'High Escalation Rate Alert',
         'Complaint escalation rate is ' || CAST(round_even(esc, 1) AS VARCHAR)
         || '%, indicating inadequate internal grievance redressal.', 'Medium'
  FROM g WHERE total >= 20 AND esc > 15
  UNION ALL
  SELECT bank_id, year, quarter, 'Complaint Spike Warning',
         'QoQ complaints volume spiked by ' || CAST(round_even(growth, 1) AS VARCHAR) || '% (' || CAST(total AS VARCHAR)
         || ' total). Investigation recommended.', CASE WHEN growth > 40 THEN 'High' ELSE 'Medium' END
  FROM g WHERE growth > 25
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_CASE_COLUMNS = """complaint_id, CAST(date AS VARCHAR) AS date, bank_name, bank_type, complaint_category, complaint_subcategory,
  complaint_text, state, channel, status, round(resolution_days, 6) AS resolution_days, customer_segment, year, month, quarter"""

_RATE = "CASE WHEN count(*) > 0 THEN count(*) FILTER (status = 'Resolved') / CAST(count(*) AS DOUBLE) * 100 END"
_RESOLVED = "avg(resolution_days) FILTER (status = 'Resolved')"

_MIS_BANK = f"""SELECT bank_name, bank_type, count(*) AS total_complaints, count(*) FILTER (status = 'Resolved') AS resolved_count,
  round({_RATE}, 1) AS resolution_rate_pct, round({_RESOLVED}, 1) AS avg_resolution_days,
  CASE WHEN round({_RESOLVED}, 1) > 40 THEN 'High' WHEN round({_RESOLVED}, 1) > 29 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM wide GROUP BY 1, 2"""

_RISK = """, base AS (
  SELECT bank_name, bank_type, count(*) AS total_complaints, count(*) FILTER (status = 'Pending') AS pending_count,
         coalesce(avg(resolution_days) FILTER (status = 'Resolved'), 0.0) AS mean_days,
         count(*) FILTER (status = 'Resolved' AND resolution_days IS NOT NULL) = 0 AS no_resolved,
         count(*) FILTER (status = 'Pending' AND date_diff('day', date, DATE '2001-06-30') > 60) AS pending_gt_60
  FROM wide GROUP BY 1, 2
), risk AS (
  SELECT *, round_even(least(mean_days / 240 * 100, 100.0) * 0.4
      + least(CAST(pending_count AS DOUBLE) / total_complaints * 100 / 25 * 100, 100.0) * 0.3
      + least(CASE WHEN pending_count > 0 THEN CAST(pending_gt_60 AS DOUBLE) / pending_count * 100 ELSE 0.0 END / 50 * 100, 100.0) * 0.3, 2)
      AS risk_score
  FROM base
)
SELECT bank_name, bank_type, total_complaints, pending_count, round_even(mean_days, 1) AS avg_resolution_days, pending_gt_60,
       risk_score, CASE WHEN risk_score >= 60 THEN 'Red' WHEN risk_score >= 35 THEN 'Amber' ELSE 'Green' END AS risk_level"""

_SERIES = """, counted AS (
  SELECT {key} AS series, last_day(date) AS month_end, count(*) AS n FROM cases GROUP BY 1, 2
), spine AS (
  SELECT series, last_day(CAST(unnest(generate_series(date_trunc('month', min(month_end)), date_trunc('month', max(month_end)), INTERVAL 1 MONTH)) AS DATE)) AS month_end
  FROM counted GROUP BY 1
), series AS (
  SELECT s.series, s.month_end, CAST(coalesce(n, 0) AS DOUBLE) AS value
  FROM spine s LEFT JOIN counted c ON s.series = c.series AND s.month_end = c.month_end
)"""

_FORECAST = """, change AS (
  SELECT *, value / nullif(lag(value) OVER (PARTITION BY series ORDER BY month_end), 0) - 1 AS change FROM series
), tail AS (
  SELECT series, coalesce(avg(change), 0) AS growth, arg_max(value, month_end) AS last_value, max(month_end) AS last_month FROM change GROUP BY 1
), forecast AS (
  SELECT series, last_day(CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE)) AS forecast_date,
         last_value * pow(1 + growth, step) AS f
  FROM tail, (SELECT unnest(generate_series(1, 6)) AS step)
)"""

# Two-sided tail of Student's t by Simpson's rule: ``tests`` has name, t, df.
_T_TAIL = """, grid AS (SELECT i, CASE WHEN i IN (0, 4000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END AS w FROM generate_series(0, 4000) r(i)
), tails AS (
  SELECT name, greatest(0.0, 1 - 2 * sum(w * exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi())
             - (df + 1) / 2 * ln(1 + pow(i * abs(t) / 4000, 2) / df))) * abs(t) / 4000 / 3) AS p_value
  FROM tests, grid GROUP BY name, t, df
)"""

_OLS = """, y AS (SELECT bank_type, channel, category_name, resolution_days AS y FROM wide WHERE resolution_days IS NOT NULL
), whole AS (SELECT avg(y) AS center, var_pop(y) * count(*) AS spread, count(*) AS size FROM y
), cells AS (
  SELECT row_number() OVER () AS cell, n, s - n * center AS sum_y, list_filter(['Intercept',
      CASE WHEN bank_type <> 'AFRICA' THEN 'Bank Type: ' || bank_type END,
      CASE WHEN channel <> '5-LOW' THEN 'Channel: ' || channel END,
      CASE WHEN category_name <> 'Unknown' THEN 'Category: ' || category_name END], lambda v: v IS NOT NULL) AS terms
  FROM (SELECT bank_type, channel, category_name, count(*) AS n, sum(y) AS s FROM y GROUP BY ALL), whole
), long AS (SELECT cell, n, sum_y, unnest(terms) AS term FROM cells
), ids AS (SELECT term, row_number() OVER (ORDER BY term <> 'Intercept', term) AS id FROM (SELECT DISTINCT term FROM long)
), entries AS (
  SELECT a.term AS ti, b.term AS tj, CAST(sum(a.n) AS DOUBLE) AS v FROM long a JOIN long b USING (cell) GROUP BY ALL
), side AS (SELECT term AS ti, sum(sum_y) AS v FROM long GROUP BY 1
), cols AS (
  SELECT i.id AS i, j.id AS j, coalesce(e.v, 0.0) AS v FROM ids i CROSS JOIN ids j LEFT JOIN entries e ON e.ti = i.term AND e.tj = j.term
  UNION ALL SELECT i.id, (SELECT count(*) FROM ids) + 1, s.v FROM ids i JOIN side s ON s.ti = i.term
  UNION ALL SELECT i.id, (SELECT count(*) FROM ids) + 1 + j.id, CASE WHEN i.id = j.id THEN 1.0 ELSE 0.0 END FROM ids i CROSS JOIN ids j
), elimination AS (
  WITH RECURSIVE step(k, m) AS (
    SELECT CAST(1 AS BIGINT), (SELECT list(r ORDER BY i) FROM (SELECT i, list(v ORDER BY j) AS r FROM cols GROUP BY i))
    UNION ALL
    SELECT k + 1, list_transform(m, lambda r, i: CASE
        WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
        ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END)
    FROM step WHERE k <= (SELECT count(*) FROM ids)
  ) SELECT m, k - 1 AS p FROM step WHERE k = (SELECT count(*) FROM ids) + 1
), beta AS (
  SELECT term AS variable, id, m[id][p + 1] AS b, m[id][p + 1 + id] AS inv, v AS xy, p FROM ids, elimination, side WHERE side.ti = term
), fit AS (
  SELECT spread - (SELECT sum(b * xy) FROM beta) AS sse, spread, size, center, (SELECT max(p) FROM beta) AS p FROM whole
), tests AS (
  SELECT variable AS name, CASE WHEN variable = 'Intercept' THEN b + center ELSE b END AS coef,
         CASE WHEN variable = 'Intercept' THEN b + center ELSE b END / sqrt(inv * sse / (size - fit.p)) AS t,
         CAST(size - fit.p AS DOUBLE) AS df, 1 - sse / spread AS r2, CAST(fit.p - 1 AS DOUBLE) AS k, size
  FROM beta, fit
)"""

_F_TAIL = """, model AS (SELECT any_value(r2 / k / ((1 - r2) / df)) AS f, any_value(k) AS d1, any_value(df) AS d2 FROM tests
), f_tail AS (
  SELECT f, greatest(0.0, 1 - sum(w * CASE WHEN i = 0 THEN 0.0 ELSE exp(lgamma((d1 + d2) / 2) - lgamma(d1 / 2) - lgamma(d2 / 2) + d1 / 2 * ln(d1 / d2)
       + (d1 / 2 - 1) * ln(i * f / 4000) - (d1 + d2) / 2 * ln(1 + d1 / d2 * i * f / 4000)) END) * f / 4000 / 3) AS f_pvalue
  FROM model, grid GROUP BY f, d1, d2
)"""

_MK = """, m AS (SELECT bank_name AS series, last_day(date) AS month_end, count(*) AS value FROM cases GROUP BY 1, 2
), sums AS (
  SELECT a.series, CAST(sum(sign(b.value - a.value)) AS BIGINT) AS s FROM m a JOIN m b ON a.series = b.series AND a.month_end < b.month_end GROUP BY 1
), sized AS (
  SELECT series, CAST(count(*) AS DOUBLE) AS n, to_json(list(value ORDER BY month_end)) AS monthly_counts FROM m GROUP BY 1
), scored AS (
  SELECT *, n * (n - 1) * (2 * n + 5) / 18 AS var_s, s / (n * (n - 1) / 2) AS tau,
         CASE WHEN s > 0 THEN (s - 1) / sqrt(n * (n - 1) * (2 * n + 5) / 18) WHEN s < 0 THEN (s + 1) / sqrt(n * (n - 1) * (2 * n + 5) / 18) ELSE 0.0 END AS z
  FROM sized JOIN sums USING (series)
), grid AS (SELECT i, CASE WHEN i IN (0, 2000) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END AS w FROM generate_series(0, 2000) r(i)
), tail AS (
  SELECT series, greatest(0.0, 1 - 2 * sum(w * exp(-pow(i * abs(z) / 2000, 2) / 2)) * abs(z) / 2000 / 3 / sqrt(2 * pi())) AS p FROM scored, grid GROUP BY series, z
), named AS (
  SELECT scored.*, p, CASE WHEN p < 0.05 AND s > 0 THEN 'Statistically Significant Upward Trend'
                           WHEN p < 0.05 AND s < 0 THEN 'Statistically Significant Downward Trend'
                           ELSE 'No Statistically Significant Trend' END AS trend
  FROM scored JOIN tail USING (series)
)"""

_LETTER = """pred AS (
  SELECT doc_id, lang AS label, CASE WHEN regexp_matches(text, '[ßäöü]') THEN 'de' WHEN regexp_matches(text, '[ñ¿íó]') THEN 'es'
         WHEN regexp_matches(text, '[çèêé]') THEN 'fr' ELSE 'en' END AS predicted
  FROM documents
)"""

# The English stop words of Spark ML that can be tokens here (no apostrophes).
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here there when where why how all any
both each few more most other some such no nor not only own same so than too very s t can will just don should now could would
cannot ought""".split()

_TFIDF = """, tokens AS (
  SELECT id, list_filter(regexp_extract_all(lower(body), '[\\p{L}\\p{N}_]{2,}'), lambda w: NOT list_contains([""" + ", ".join(
    f"'{w}'" for w in STOP_WORDS
) + """], w)) AS t FROM docs
), counts AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest(t) AS term FROM tokens) GROUP BY ALL
), vocabulary AS (
  SELECT term, ln((1 + (SELECT count(*) FROM docs)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM counts GROUP BY term
  ORDER BY sum(n) DESC, term LIMIT {size}
), weighted AS (SELECT id, term, n * idf AS w FROM counts JOIN vocabulary USING (term))
SELECT id AS doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM weighted"""

_NARRATIVES = """, texts AS (
  SELECT 'summary-' || bank_id || '-' || year || '-' || month AS doc_id,
    'In ' || monthname(make_date(year, month, 1)) || ' ' || year || ', ' || n_name || ' (' || r_name || ') received a total of ' || total_complaints
    || ' consumer complaints. Out of these, ' || resolved_count || ' were resolved (resolution rate of '
    || CAST(round_even(resolved_count / CAST(total_complaints AS DOUBLE) * 100, 1) AS VARCHAR) || '%), ' || pending_count || ' remain pending, and '
    || escalated_count || ' were escalated. The average resolution time for resolved complaints was '
    || coalesce(CAST(avg_resolution_days AS VARCHAR), 'nan') || ' days. The month-over-month complaint volume growth for this bank was '
    || CAST(complaint_growth_pct AS VARCHAR) || '%.' AS page_content,
    '{"source":"monthly_summary","bank_name":"' || n_name || '","year":"' || year || '","month":"' || month || '","type":"summary"}' AS metadata
  FROM summary JOIN nation ON bank_id = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_FLAG_NARRATIVES = """, flag_texts AS (
  SELECT 'flag-' || bank_id || '-' || year || '-' || quarter || '-' || replace(flag_type, ' ', '_') AS doc_id,
    'Regulatory Alert: In ' || year || ' Quarter ' || quarter || ', ' || n_name || ' was flagged for ''' || flag_type || ''' with ' || severity
    || ' severity. Description: ' || flag_description AS page_content,
    '{"source":"policy_flags","bank_name":"' || n_name || '","year":"' || year || '","quarter":"' || quarter || '","type":"flag"}' AS metadata
  FROM flags JOIN nation ON bank_id = n_nationkey
)"""

_FLAGS_ONLY = FLAGS[len(CASES):]  # to follow SUMMARY, which already defines the cases
_CORPUS = _with(SUMMARY + _FLAGS_ONLY + _NARRATIVES + _FLAG_NARRATIVES)

_KNN = """, hits AS (
  SELECT q.vec_id AS question_id, d.vec_id AS doc_id, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])) AS distance
  FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id
), ranked AS (
  SELECT question_id, doc_id, CAST(rank AS INTEGER) AS rank, distance
  FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, doc_id) AS rank FROM hits) WHERE rank <= 5
)"""
_KNN = "WITH " + _KNN.lstrip(", ")
_KNN_SQL = _KNN + " SELECT question_id, doc_id, rank, round(distance, 6) AS distance FROM ranked"

_CASES = _with(CASES)
_KEPT = "WITH " + CASES  # same text; queries on counts use only what they need

ORACLE: dict[str, str] = {
    "read_cases_csv": _CASES + f"SELECT {_CASE_COLUMNS} FROM cases",
    "write_table": _CASES + f"SELECT {_CASE_COLUMNS} FROM cases",
    "clean_cases": _CASES + f"SELECT {_CASE_COLUMNS} FROM cases",
    "dim_institution": """SELECT n_nationkey AS bank_id, n_name AS bank_name, r_name AS bank_type,
        'LIC-' || n_nationkey AS license_number, r_name AS headquarters FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_category": _with(DIM) + "SELECT * FROM categories",
    "load_fact": _with(CASES, DIM) + """SELECT complaint_id, CAST(date AS VARCHAR) AS date, bank_id, category_id, subcategory_id, complaint_text,
        state, channel, status, round(resolution_days, 6) AS resolution_days, customer_segment, year, month, quarter
        FROM cases JOIN categories ON complaint_subcategory = subcategory_name""",
    "wide_cases": _CASES + """SELECT complaint_id, CAST(date AS VARCHAR) AS date, complaint_text, state, channel, status,
        round(resolution_days, 6) AS resolution_days, customer_segment, year, month, quarter, bank_name, bank_type, category_name, subcategory_name
        FROM wide""",
    "null_profile": _with(RAW) + "SELECT column_name, null_count FROM (SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ("complaint_id date bank_name bank_type complaint_category complaint_subcategory complaint_text state channel status customer_segment").split()
    )
    + " FROM raw) UNPIVOT (null_count FOR column_name IN (complaint_id, date, bank_name, bank_type, complaint_category, complaint_subcategory,"
      " complaint_text, state, channel, status, customer_segment))",
    "date_window": _with(RAW) + """SELECT CASE WHEN date IS NULL THEN 'unparseable' WHEN date BETWEEN DATE '1995-01-01' AND DATE '2001-06-30'
        THEN 'kept' ELSE 'out_of_range' END AS outcome, count(*) AS record_count FROM raw GROUP BY 1""",
    "repair_days": _CASES + "SELECT complaint_id, status, round(resolution_days, 6) AS resolution_days FROM cases",
    "dq_report": _CASES + """, z AS (SELECT count(*) AS outliers FROM cases, (SELECT avg(resolution_days) AS a, stddev_samp(resolution_days) AS s FROM cases)
          WHERE abs((resolution_days - a) / s) > 3),
        t AS (SELECT (SELECT count(*) FROM raw) AS total_records_ingested, (SELECT count(*) FROM kept) AS total_records_processed,
          (SELECT count(*) FROM kept WHERE (status = 'Pending' AND resolution_days IS NOT NULL)
              OR (status = 'Resolved' AND (resolution_days IS NULL OR resolution_days <= 0))) AS fixed,
          (SELECT outliers FROM z) AS outliers,
          (SELECT 2 * count(*) FILTER (complaint_category IS NULL) FROM raw) AS nulls)
        SELECT total_records_ingested, total_records_processed, total_records_ingested - total_records_processed AS invalid_dates_dropped,
          fixed AS invalid_resolution_days_fixed, outliers AS resolution_days_outliers_flagged,
          round_even(nulls / (total_records_processed * 11.0::DOUBLE) * 100, 4) AS overall_null_percentage,
          round_even(outliers / CAST(total_records_processed AS DOUBLE) * 100, 4) AS outlier_percentage,
          round_even((total_records_ingested - total_records_processed + fixed) / CAST(total_records_ingested AS DOUBLE) * 100, 4) AS invalid_records_percentage
        FROM t""",
    "zscore_outliers": _CASES + """SELECT complaint_id, round(resolution_days, 6) AS resolution_days, round((resolution_days - a) / s, 6) AS z_score
        FROM cases, (SELECT avg(resolution_days) AS a, stddev_samp(resolution_days) AS s FROM cases) WHERE abs((resolution_days - a) / s) > 3""",
    "calendar_parts": """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
        CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
        CAST(last_day(o_orderdate) AS VARCHAR) AS month_end, monthname(o_orderdate) AS month_name FROM orders""",
    "dup_keys": "SELECT l_orderkey, l_linenumber, count(*) AS record_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "domain_violations": _CASES + """SELECT 'channel' AS column_name, channel AS value, count(*) AS record_count FROM cases
        WHERE channel NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') GROUP BY 2
        UNION ALL SELECT 'status', status, count(*) FROM cases WHERE status NOT IN ('Resolved', 'Pending') GROUP BY 2""",
    "fk_orphans": """SELECT o_custkey, count(*) AS record_count FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) GROUP BY 1""",
    "top_banks_yoy": _CASES + """SELECT bank_name, bank_type, count(*) FILTER (year = 1999) AS count_prev, count(*) FILTER (year = 2000) AS count_curr,
        count(*) AS total_volume, CASE WHEN count(*) FILTER (year = 1999) = 0 THEN 0.0 ELSE
          round((CAST(count(*) FILTER (year = 2000) AS DOUBLE) - count(*) FILTER (year = 1999)) / count(*) FILTER (year = 1999) * 100, 2) END AS yoy_change_pct
        FROM wide GROUP BY 1, 2 ORDER BY total_volume DESC, bank_name LIMIT 10""",
    "category_trends": _CASES + """SELECT category_name, year || '-Q' || quarter AS quarter_label, count(*) AS complaint_count
        FROM wide GROUP BY category_name, year, quarter""",
    "resolution_efficiency": _CASES + f"""SELECT bank_name, bank_type, count(*) AS total_complaints, count(*) FILTER (status = 'Resolved') AS resolved_count,
        round({_RATE}, 2) AS resolution_rate_pct, round({_RESOLVED}, 1) AS avg_resolution_days,
        CAST(rank() OVER (ORDER BY {_RESOLVED} ASC NULLS LAST) AS INTEGER) AS efficiency_rank FROM wide GROUP BY 1, 2""",
    "state_heatmap": _CASES + "SELECT state, category_name, count(*) AS complaint_count FROM wide GROUP BY 1, 2",
    "heatmap_pivot": _CASES + "SELECT state, "
    + ", ".join(f"count(*) FILTER (category_name = '{c}') AS \"{c}\"" for c in "ECONOMY LARGE MEDIUM PROMO SMALL STANDARD".split())
    + ", count(*) FILTER (category_name NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')) AS other FROM wide GROUP BY 1",
    "pendency_aging": _CASES + """SELECT bank_name, count(*) AS total_pending, """
    + ", ".join(f"count(*) FILTER (date_diff('day', date, DATE '2001-06-30') > {d}) AS pending_{d}_days" for d in (30, 60, 90))
    + " FROM wide WHERE status = 'Pending' GROUP BY 1",
    "rising_categories": _CASES + """, p AS (SELECT category_name, count(*) FILTER (quarter = 1) AS a, count(*) FILTER (quarter = 2) AS b
          FROM wide WHERE year = 2001 AND quarter IN (1, 2) GROUP BY 1)
        SELECT category_name, a AS previous_quarter_count, b AS latest_quarter_count, round((CAST(b AS DOUBLE) - a) / a * 100, 2) AS qoq_growth_pct
        FROM p WHERE a > 0 AND (CAST(b AS DOUBLE) - a) / a > 0.2""",
    "kpi_cards": _CASES + f"""SELECT count(*) AS total_complaints,
        round_even((count(*) FILTER (year = 2000) - count(*) FILTER (year = 1999)) / CAST(count(*) FILTER (year = 1999) AS DOUBLE) * 100, 1) AS yoy_growth_pct,
        round_even({_RATE}, 1) AS resolution_rate_pct, round_even({_RESOLVED}, 1) AS avg_resolution_days
        FROM wide WHERE year IN (1999, 2000) AND bank_type IN ('ASIA', 'EUROPE')""",
    "monthly_trend": _CASES + "SELECT CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month_start, count(*) AS complaint_count FROM wide GROUP BY 1",
    "value_counts": _CASES + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS complaint_count FROM wide GROUP BY 2"
        for c in ("category_name", "channel", "customer_segment", "bank_name")
    ),
    "status_share": _CASES + "SELECT status, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS share_pct FROM wide GROUP BY 1",
    "quarter_category_volumes": _CASES + """SELECT year || '-Q' || quarter AS quarter_label, category_name, count(*) AS complaint_count FROM wide
        WHERE bank_name = 'NATION_7' AND regexp_matches(complaint_text, 'order .*1', 'i') GROUP BY 1, 2""",
    "top_subcategories": _CASES + "SELECT subcategory_name, count(*) AS complaint_count FROM wide GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8",
    "state_volume": _CASES + "SELECT state, count(*) AS complaint_count FROM wide GROUP BY 1",
    "top_state_trend": _CASES + """SELECT state, CAST(make_date(year, month, 1) AS VARCHAR) AS month_start, count(*) AS complaint_count FROM wide
        WHERE state IN (SELECT state FROM wide GROUP BY 1 ORDER BY count(*) DESC, state LIMIT 5) GROUP BY state, year, month""",
    "top_banks_typed": _CASES + """SELECT bank_name, count(*) AS complaint_count, min(bank_type) AS bank_type FROM wide
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "category_monthly": _CASES + """SELECT year, month, CAST(make_date(year, month, 1) AS VARCHAR) AS month_start, count(*) AS complaint_count
        FROM wide WHERE category_name = 'ECONOMY' GROUP BY 1, 2""",
    "category_top_states": _CASES + """SELECT state, count(*) AS complaint_count FROM wide WHERE category_name = 'ECONOMY'
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
    "text_search": "SELECT doc_id FROM documents WHERE regexp_matches(text, 'licen[sc]e|copyright', 'i')",
    "monthly_summary": _with(SUMMARY) + """SELECT bank_id, year, month, total_complaints, resolved_count, pending_count, escalated_count,
        round(avg_resolution_days, 6) AS avg_resolution_days, complaint_growth_pct FROM summary""",
    "high_growth_months": _with(SUMMARY) + """SELECT n_name AS bank_name, year, month, total_complaints, complaint_growth_pct FROM summary
        JOIN nation ON bank_id = n_nationkey WHERE complaint_growth_pct > 15 ORDER BY complaint_growth_pct DESC, bank_id, year, month LIMIT 3""",
    "policy_flags": _with(FLAGS) + "SELECT * FROM flags",
    "flag_register": _with(FLAGS) + """SELECT n_name AS bank_name, year, quarter, flag_type, flag_description, severity
        FROM flags JOIN nation ON bank_id = n_nationkey""",
    "flag_sample": _with(FLAGS) + """SELECT n_name AS bank_name, flag_type, flag_description, severity
        FROM (SELECT * FROM flags ORDER BY bank_id, year, quarter, flag_type LIMIT 3) JOIN nation ON bank_id = n_nationkey""",
    "risk_scores": _CASES.rstrip() + _RISK + ", no_resolved FROM risk",
    "flatten_risk_json": _CASES.rstrip() + _RISK + " FROM risk",
    "descriptive_stats": _CASES + """SELECT bank_type, round_even(avg(resolution_days), 2) AS mean, round_even(median(resolution_days), 2) AS median,
        round_even(stddev_samp(resolution_days), 2) AS std, round_even(skewness(resolution_days), 2) AS skew, count(resolution_days) AS count
        FROM wide WHERE resolution_days IS NOT NULL GROUP BY 1""",
    "box_summary": _CASES + "SELECT bank_type, "
    + ", ".join(f"round(quantile_cont(resolution_days, {p}), 6) AS {n}" for n, p in (("minimum", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("maximum", 1)))
    + " FROM wide WHERE status = 'Resolved' GROUP BY 1",
    "overall_mean": _CASES + "SELECT count(*) AS total_complaints, round(avg(resolution_days), 6) AS avg_resolution_days FROM wide",
    "welch_t": _CASES.rstrip() + """, g AS (
          SELECT avg(resolution_days) FILTER (bank_type = 'ASIA') AS ma, avg(resolution_days) FILTER (bank_type = 'EUROPE') AS mb,
            count(resolution_days) FILTER (bank_type = 'ASIA') AS na, count(resolution_days) FILTER (bank_type = 'EUROPE') AS nb,
            var_samp(resolution_days) FILTER (bank_type = 'ASIA') AS va, var_samp(resolution_days) FILTER (bank_type = 'EUROPE') AS vb FROM wide
        ), tests AS (SELECT 'welch' AS name, (ma - mb) / sqrt(va / na + vb / nb) AS t,
            pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)) AS df FROM g
        )""" + _T_TAIL + """ SELECT round_even(t, 4) AS t_statistic, round(df, 6) AS df, round(p_value, 6) AS p_value, p_value < 0.05 AS reject_null,
        CASE WHEN p_value < 0.05 THEN 'Reject Null Hypothesis: Asia banks take significantly longer to resolve complaints than europe banks (p-value < 0.05).'
        ELSE 'Fail to Reject Null Hypothesis: There is no statistically significant difference in resolution speed between asia and europe banks (p-value >= 0.05).'
        END AS interpretation FROM tests JOIN tails USING (name)""",
    "ols_days": _CASES.rstrip() + _OLS + _T_TAIL + _F_TAIL + """ SELECT name AS variable, round_even(coef, 4) AS coefficient, round_even(t, 4) AS t_statistic,
        round(p_value, 6) AS p_value, p_value < 0.05 AS significant, round_even(r2, 4) AS r_squared,
        round_even(1 - (1 - r2) * (size - 1) / df, 4) AS adj_r_squared, round_even(f, 4) AS f_statistic, round(f_pvalue, 6) AS f_pvalue
        FROM tests JOIN tails USING (name), f_tail""",
    "ols_simple": _CASES + """SELECT bank_type, round(regr_slope(resolution_days, month), 6) AS slope, round(regr_intercept(resolution_days, month), 6) AS intercept,
        round(regr_r2(resolution_days, month), 6) AS r_squared FROM wide WHERE resolution_days IS NOT NULL GROUP BY 1""",
    "mann_kendall": _CASES.rstrip() + _MK + """ SELECT series, trend, round_even(tau, 4) AS tau, s AS s_statistic, round_even(z, 4) AS z_score, round(p, 6) AS p_value,
        p < 0.05 AS reject_null, 'The Mann-Kendall test confirms a ' || lower(trend) || ' in ' || series || ' monthly counts (Tau = '
        || CAST(round_even(tau, 3) AS VARCHAR) || ', p-value = ' || regexp_replace(regexp_replace(CAST(CAST(round_even(p, 6) AS DECIMAL(18, 6)) AS VARCHAR), '0+$', ''), '\\.$', '.0')
        || ').' AS interpretation, CAST(monthly_counts AS VARCHAR) AS monthly_counts FROM named""",
    "monthly_series": _CASES.rstrip() + _SERIES.format(key="'all'") + " SELECT series, CAST(month_end AS VARCHAR) AS month_end, value FROM series",
    "series_arrays": _CASES.rstrip() + _SERIES.format(key="bank_name")
    + """ SELECT series, CAST(to_json(list(CAST(month_end AS VARCHAR) ORDER BY month_end)) AS VARCHAR) AS dates,
        CAST(to_json(list(value ORDER BY month_end)) AS VARCHAR) AS values FROM series GROUP BY 1""",
    "compound_growth_forecast": _CASES.rstrip() + _SERIES.format(key="bank_name") + _FORECAST
    + """ SELECT series, CAST(forecast_date AS VARCHAR) AS forecast_date, round_even(f, 2) AS forecast_value, round_even(f * 0.85, 2) AS lower,
        round_even(f * 1.15, 2) AS upper, 'Fallback (Moving Average)' AS status FROM forecast""",
    "flatten_forecast_json": _CASES.rstrip() + _SERIES.format(key="bank_type") + _FORECAST
    + """ SELECT series, 'history' AS kind, CAST(month_end AS VARCHAR) AS date, value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper FROM series
        UNION ALL SELECT series, 'forecast', CAST(forecast_date AS VARCHAR), round_even(f, 2), round_even(f * 0.85, 2), round_even(f * 1.15, 2) FROM forecast""",
    "stratified_split": """SELECT doc_id, lang AS label, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '-42'), CAST(doc_id AS VARCHAR))
        > count(*) OVER (PARTITION BY lang) - floor(count(*) OVER (PARTITION BY lang) * 8 / 10.0) AS is_train FROM documents""",
    "keyword_classify": """SELECT doc_id, CASE WHEN contains(x, 'upi') OR contains(x, 'fraud') OR contains(x, 'phishing') THEN 'Digital Banking Fraud'
        WHEN contains(x, 'atm') OR contains(x, 'cash') THEN 'ATM/Debit Card Issues'
        WHEN contains(x, 'credit card') OR contains(x, 'annual fee') THEN 'Credit Card Complaints'
        WHEN contains(x, 'loan') OR contains(x, 'emi') THEN 'Loan & EMI Disputes'
        WHEN contains(x, 'kyc') OR contains(x, 'freeze') THEN 'Account Operations' ELSE 'Other' END AS predicted_category
        FROM (SELECT doc_id, lower(text) AS x FROM documents)""",
    "classification_report": _with(_LETTER) + """, classes AS (SELECT label AS class FROM pred UNION SELECT predicted FROM pred
        ), c AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (predicted = class) AS guessed,
            CAST(count(*) FILTER (label = class AND predicted = class) AS DOUBLE) AS tp FROM pred, classes GROUP BY 1
        ), m AS (SELECT class, support, tp, CASE WHEN guessed > 0 THEN tp / guessed ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM c
        ), f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM m
        ), s AS (SELECT class AS label, p AS precision, r AS recall, f1, support FROM f
          UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM f
          UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), CAST(sum(support) AS BIGINT) FROM f
          UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s""",
    "confusion_matrix": _with(_LETTER) + """SELECT label, count(*) FILTER (predicted = 'de') AS de, count(*) FILTER (predicted = 'en') AS en,
        count(*) FILTER (predicted = 'es') AS es, count(*) FILTER (predicted NOT IN ('de', 'en', 'es')) AS other FROM pred GROUP BY 1""",
    "tfidf_vectors": "WITH docs AS (SELECT doc_id AS id, text AS body FROM documents)" + _TFIDF.replace("{size}", "500"),
    "embed_corpus": _CORPUS.rstrip() + ", docs AS (SELECT doc_id AS id, page_content AS body FROM (SELECT * FROM texts UNION ALL SELECT * FROM flag_texts))"
    + _TFIDF.replace("{size}", "128"),
    "summary_narratives": _with(SUMMARY + _NARRATIVES) + "SELECT * FROM texts",
    "flag_narratives": _with(FLAGS + _FLAG_NARRATIVES) + "SELECT * FROM flag_texts",
    "corpus_table": _CORPUS + "SELECT * FROM texts UNION ALL SELECT * FROM flag_texts",
    "corpus_store": _CORPUS + "SELECT * FROM texts UNION ALL SELECT * FROM flag_texts",
    "knn_topk": _KNN_SQL,
    "knn_topk_blocks": _KNN_SQL,
    "vector_store_search": _KNN_SQL,
    "retrieval_context": _KNN + """ SELECT question_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context,
        CAST(to_json(list({'content': text, 'bank_name': lang, 'year': 'N/A', 'source': source} ORDER BY rank)) AS VARCHAR) AS sources
        FROM ranked JOIN documents d ON d.doc_id = ranked.doc_id GROUP BY 1""",
    "question_routes": """SELECT conv_id, turn, CASE WHEN contains(lower(text), 'growth') OR contains(lower(text), 'highest') THEN 'growth'
        WHEN contains(lower(text), 'fraud') OR contains(lower(text), 'digital') THEN 'fraud_states' ELSE 'flags' END AS route FROM conversations WHERE role = 'user'""",
    "route_lines": _with(SUMMARY + _FLAGS_ONLY) + """SELECT 'growth' AS route, '- In year ' || year || ' month ' || month || ', ' || n_name || ' had ' || total_complaints
          || ' complaints, growing by ' || CAST(complaint_growth_pct AS VARCHAR) || '% MoM.' AS line
        FROM (SELECT * FROM summary WHERE complaint_growth_pct > 15 ORDER BY complaint_growth_pct DESC, bank_id, year, month LIMIT 3) JOIN nation ON bank_id = n_nationkey
        UNION ALL SELECT 'fraud_states', '- ' || state || ' recorded ' || n || ' digital fraud complaints.'
        FROM (SELECT state, count(*) AS n FROM wide WHERE category_name = 'ECONOMY' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)
        UNION ALL SELECT 'flags', '- ' || n_name || ' flagged for ''' || flag_type || ''' (' || severity || ' severity): ' || flag_description
        FROM (SELECT * FROM flags ORDER BY bank_id, year, quarter, flag_type LIMIT 3) JOIN nation ON bank_id = n_nationkey""",
    "run_pipeline": _with(SUMMARY + _FLAGS_ONLY) + "".join(
        f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {source} UNION ALL "
        for name, source in (("raw", "raw"), ("cases", "cases"), ("complaints", "cases"), ("wide", "wide"), ("split", "cases"), ("monthly_summary", "summary"), ("policy_flags", "flags"))
    ) + "SELECT 'banks', count(*) FROM nation UNION ALL SELECT 'risk_scores', count(DISTINCT bank_name) FROM wide",
    "mis_bank": _CASES + _MIS_BANK,
    "category_breakdown": _CASES + f"SELECT category_name, subcategory_name, count(*) AS complaint_count, round({_RATE}, 1) AS resolution_rate_pct FROM wide GROUP BY 1, 2",
    "mis_geo": _CASES + f"""SELECT state, count(*) AS complaint_count, count(*) FILTER (status = 'Resolved') AS resolved_count,
        round({_RATE}, 1) AS resolution_rate_pct FROM wide GROUP BY 1""",
    "mis_with_total": _CASES.rstrip() + f""", b AS ({_MIS_BANK}) SELECT * FROM b UNION ALL
        SELECT 'Total / System Average', NULL, CAST(sum(total_complaints) AS BIGINT), CAST(sum(resolved_count) AS BIGINT),
        round(avg(resolution_rate_pct), 6), round(avg(avg_resolution_days), 6), NULL FROM b""",
    "report_headline": _CASES + f"""SELECT count(*) AS total_complaints, count(*) FILTER (status = 'Resolved') AS resolved_count,
        round_even({_RESOLVED}, 1) AS avg_resolution_days, round_even({_RATE}, 1) AS resolution_rate_pct FROM wide WHERE year = 2001 AND month = 6""",
    "report_top_categories": _CASES + """SELECT category_name, count(*) AS complaint_count, category_name || ' (' || count(*) || ' complaints)' AS label
        FROM wide WHERE year = 2001 AND month = 6 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
    "attention_banks": _CASES + """SELECT bank_name, count(*) AS total_pending, count(*) FILTER (date_diff('day', date, DATE '2001-06-30') > 60) AS pending_gt_60
        FROM wide WHERE status = 'Pending' GROUP BY 1 HAVING pending_gt_60 > 0 ORDER BY pending_gt_60 DESC, bank_name LIMIT 5""",
}


def _melted(section: str, item: str, metrics: str, query: str) -> str:
    """``section, item, metric, value`` rows of the given columns of a query."""
    casts = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics.split())
    return (
        f"SELECT '{section}' AS section, item, metric, value FROM (SELECT {item} AS item, {casts} FROM ({query})) "
        f"UNPIVOT (value FOR metric IN ({', '.join(metrics.split())}))"
    )


_CATEGORY_TREND = ORACLE["mann_kendall"].replace("SELECT bank_name AS series", "SELECT complaint_category AS series")

ORACLE["flatten_results_json"] = " UNION ALL ".join(
    [
        _melted("descriptive_statistics", "bank_type", "mean median std skew count", ORACLE["descriptive_stats"]),
        _melted("welch_t_test", "'test'", "t_statistic p_value", ORACLE["welch_t"]),
        _melted("ols_regression", "'model'", "r_squared adj_r_squared f_statistic f_pvalue", ORACLE["ols_days"] + " LIMIT 1"),
        _melted("ols_coefficients", "variable", "coefficient t_statistic p_value", ORACLE["ols_days"]),
        _melted("mann_kendall_trend_test", "series", "tau s_statistic z_score p_value", _CATEGORY_TREND),
    ]
)

# The same figures from the fact, joined to the dimension at the category's grain.
_STAR = _with(CASES, DIM).rstrip() + """, fact AS (
  SELECT complaint_id, category_id, state, year, month, quarter FROM cases JOIN categories ON complaint_subcategory = subcategory_name
), grain AS (SELECT DISTINCT category_id, category_name FROM categories
), star AS (SELECT fact.*, coalesce(category_name, 'Unknown') AS category_name FROM fact LEFT JOIN grain USING (category_id)) """
for _name in ("category_trends", "state_heatmap", "rising_categories", "report_top_categories"):
    ORACLE[f"star_{_name}"] = ORACLE[_name].replace(_CASES, _STAR).replace("FROM wide", "FROM star")
ORACLE["refreshed_summary"] = ORACLE["monthly_summary"]
ORACLE["refreshed_flags"] = ORACLE["policy_flags"]
ORACLE["clean_run_cases"], ORACLE["clean_run_report"], ORACLE["clean_run_nulls"] = ORACLE["clean_cases"], ORACLE["dq_report"], ORACLE["null_profile"]
ORACLE["text_index_search"] = ORACLE["text_search"]
ORACLE["write_sorted"] = ORACLE["clean_cases"] + " WHERE date BETWEEN DATE '2000-03-01' AND DATE '2000-03-31'"
ORACLE["flag_outliers"] = _CASES + """SELECT complaint_id, round(resolution_days, 6) AS resolution_days, coalesce(abs((resolution_days - a) / s) > 3, false) AS is_outlier
    FROM cases, (SELECT avg(resolution_days) AS a, stddev_samp(resolution_days) AS s FROM cases)"""
ORACLE["distinct_values"] = _CASES + "SELECT DISTINCT bank_name FROM wide"
# All pairs: for small tables only.
ORACLE["long_trend"] = """WITH o AS (SELECT o_orderpriority AS series, o_orderkey AS at, CAST(o_totalprice AS DOUBLE) AS value FROM orders)
    SELECT a.series, any_value(n) AS n, CAST(sum(sign(b.value - a.value)) AS BIGINT) AS s_statistic,
      round(sum(sign(b.value - a.value)) / (any_value(n) * (any_value(n) - 1) / 2.0), 6) AS tau
    FROM o a JOIN o b ON a.series = b.series AND a.at < b.at JOIN (SELECT series, count(*) AS n FROM o GROUP BY 1) c ON c.series = a.series GROUP BY a.series"""
