"""SQL text shared by the checks: the library's main tables as common table expressions."""

from __future__ import annotations

from tillcast.catalog.tables import DIRTY_SQL, TXN_SQL
from tillcast.constants import DAILY_METRICS, TRAILING_WINDOWS

METRICS = DAILY_METRICS
INTEGER_METRICS = METRICS[1:]
MARKETS = "lower(country) NOT IN ('nation_23', 'nation_24')"

CLEAN = TXN_SQL + """,
clean AS (SELECT * FROM txn WHERE upper(invoice_prefix) <> 'A')"""

ACTIVITY = CLEAN + """,
activity AS (
  SELECT CASE WHEN grouping(country) = 1 THEN 'overall' ELSE country END AS series, date,
         sum(price) AS revenue,
         CAST(count(DISTINCT invoice_clean) AS BIGINT) AS purchases,
         CAST(count(DISTINCT stream_id) AS BIGINT) AS unique_streams,
         CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
         CAST(sum(times_viewed) AS BIGINT) AS total_views
  FROM clean GROUP BY GROUPING SETS ((date), (country, date))
)"""

DAILY = ACTIVITY + """,
spine AS (
  SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM activity GROUP BY series
),
daily AS (
  SELECT s.series, s.date, coalesce(round_even(revenue, 2), 0.0) AS revenue,
         """ + ",\n         ".join(f"coalesce({m}, 0) AS {m}" for m in INTEGER_METRICS) + """
  FROM spine s LEFT JOIN activity a ON s.series = a.series AND s.date = a.date
)"""


def over(first: str, last: str) -> str:
    return f"OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {first} AND {last})"


def framed(metric: str, first: int, last: int) -> str:
    """Sum over a frame of rows, NULL unless the frame is complete. Offsets are relative to the row."""
    def edge(k: int) -> str:
        return "CURRENT ROW" if k == 0 else f"{abs(k)} {'PRECEDING' if k < 0 else 'FOLLOWING'}"

    frame = over(edge(first), edge(last))
    return f"CASE WHEN count(*) {frame} = {last - first + 1} THEN CAST(sum({metric}) {frame} AS DOUBLE) END"


def feature_columns(horizon: int = 30) -> dict[str, str]:
    out = {}
    for m in METRICS:
        for w in TRAILING_WINDOWS:
            out[f"{m}_sum_{w}d"] = framed(m, 1 - w, 0)
            out[f"{m}_mean_{w}d"] = f"({framed(m, 1 - w, 0)}) / {w}.0"
        out[f"{m}_lag_{horizon}d"] = f"lag({m}, {horizon}) OVER (PARTITION BY series ORDER BY date)"
        out[f"{m}_trend_28d"] = f"({framed(m, -27, 0)}) / 28.0 - ({framed(m, -55, -28)}) / 28.0"
    prior = framed("revenue", -394, -365)
    out["has_prior_year_data"] = f"CASE WHEN ({prior}) IS NULL THEN 0 ELSE 1 END"
    out["revenue_sum_30d_prior_year"] = f"coalesce({prior}, 0.0)"
    out["dow"] = "isodow(date) - 1"
    out["day_of_month"] = "day(date)"
    out["month"] = "month(date)"
    out["is_year_end_window"] = "CASE WHEN month(date) = 12 AND day(date) >= 21 THEN 1 ELSE 0 END"
    return out


FEATURE_SQL = feature_columns()
FEATURES = DAILY + ",\nfeatures AS (\n  SELECT series, date,\n    " + ",\n    ".join(
    f"{sql} AS {name}" for name, sql in FEATURE_SQL.items()
) + f",\n    {framed('revenue', 1, 30)} AS target\n  FROM daily\n)"

COMPLETE = "revenue_sum_70d IS NOT NULL"
SUPERVISED = FEATURES + f",\nsupervised AS (SELECT * FROM features WHERE {COMPLETE} AND target IS NOT NULL)"

TOP = """,
top AS (
  SELECT country, sum(price) AS revenue FROM clean WHERE """ + MARKETS + """
  GROUP BY country ORDER BY revenue DESC, country LIMIT 10
)"""

SPLIT = SUPERVISED + """,
counted AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS row_no, count(*) OVER (PARTITION BY series) AS n
  FROM supervised
),
split AS (
  SELECT *, CASE WHEN row_no > n - least(greatest(40, CAST(floor(n * 0.2) AS BIGINT)), n // 2)
                 THEN 'test' ELSE 'train' END AS role
  FROM counted
)"""

BASELINE_CASES = """
  SELECT series, date, 'naive' AS model, target AS actual, revenue_sum_28d AS predicted FROM {0}
  UNION ALL
  SELECT series, date, 'seasonal_naive', target,
         CASE WHEN has_prior_year_data = 1 THEN revenue_sum_30d_prior_year ELSE revenue_sum_28d END FROM {0}"""

BASELINES = SPLIT + ",\ntest AS (SELECT * FROM split WHERE role = 'test'),\npredictions AS (" + BASELINE_CASES.format("test") + ")"

METRIC_COLUMNS = """avg(abs(predicted - actual)) AS mae,
  sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
  avg(abs(predicted - actual) / greatest(abs(actual), 1e-6)) * 100 AS mape,
  avg(actual) AS mean_actual"""

MODEL_METRICS = BASELINES + f""",
metrics AS (SELECT series, model, {METRIC_COLUMNS} FROM predictions GROUP BY series, model),
scale AS (SELECT series, avg(target) AS mean_target FROM supervised GROUP BY series),
normalised AS (
  SELECT m.*, mean_target, mae / mean_target AS normalised_mae FROM metrics m JOIN scale s ON m.series = s.series
)"""

# Cleaned dirty rows, step by step.
NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def number(expr: str) -> str:
    return f"CASE WHEN regexp_matches(trim({expr}), {NUMBER}) THEN try_cast(trim({expr}) AS DOUBLE) END"


def coerced(source: str) -> str:
    """CTE ``coerced`` over a table of raw text columns."""
    return f"""
coerced AS (
  SELECT source_file, trim(country) AS country, trim(invoice) AS invoice, trim(stream_id) AS stream_id,
         CASE WHEN ({number('customer_id')}) = floor({number('customer_id')})
              THEN CAST({number('customer_id')} AS BIGINT) END AS customer_id,
         {number('price')} AS price,
         CAST(trunc(coalesce({number('times_viewed')}, 0)) AS BIGINT) AS times_viewed,
         try_cast(year || '-' || month || '-' || day AS DATE) AS date,
         regexp_extract(trim(invoice), '^([A-Za-z]*)(.*)$', 1) AS invoice_prefix,
         regexp_extract(trim(invoice), '^([A-Za-z]*)(.*)$', 2) AS invoice_clean
  FROM {source}
),
ruled AS (
  SELECT *, CASE WHEN price IS NULL THEN 'invalid_price'
                 WHEN date IS NULL THEN 'invalid_date'
                 WHEN country IS NULL OR lower(country) IN ('', 'nan') OR invoice IS NULL OR stream_id IS NULL
                      THEN 'missing_required_field'
                 WHEN upper(invoice_prefix) = 'A' THEN 'bad_debt_adjustment' END AS drop_reason
  FROM coerced
),
kept AS (
  SELECT country, customer_id, invoice, stream_id, price, times_viewed, date, min(source_file) AS source_file
  FROM ruled WHERE drop_reason IS NULL
  GROUP BY country, customer_id, invoice, stream_id, price, times_viewed, date
)"""


CLEANED = DIRTY_SQL + "," + coerced("dirty")


def rounded_columns(columns: dict[str, int] | list[str], places: int = 2) -> str:
    pairs = columns.items() if isinstance(columns, dict) else ((c, places) for c in columns)
    return ", ".join(f"round({c}, {p}) AS {c}" for c, p in pairs)
