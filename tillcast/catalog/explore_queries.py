"""Checked queries: exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog import sqltext as S
from tillcast.catalog.ingest_queries import clean
from tillcast.catalog.registry import day, query, rounded, shown
from tillcast.catalog.series_queries import series, top
from tillcast.catalog.tables import HOME, LABELS
from tillcast.operators import evaluation as EV
from tillcast.operators import explore as X
from tillcast.operators.markets import revenue_by_country

GAP_YEARS = (1996, 1997, 1998, 1999, 2000)
FULL_FROM = "1995-02-01"
SINCE = "1995-02-01"

MONTHLY = S.DAILY + """,
monthly AS (
  SELECT series, CAST(date_trunc('month', date) AS DATE) AS month_start,
         """ + ", ".join(f"sum({m}) AS {m}" for m in S.METRICS) + """,
         count(*) AS n_days, count(*) FILTER (revenue > 0) AS days_with_revenue,
         count(*) FILTER (revenue = 0) AS days_without_revenue
  FROM daily GROUP BY series, 2
),
flagged AS (
  SELECT *, month_start = min(month_start) OVER (PARTITION BY series) OR month(month_start) = 12 AS is_partial FROM monthly
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY month_start) AS position, count(*) OVER (PARTITION BY series) AS n
  FROM monthly
)"""
COUNTS = ("n_days", "days_with_revenue", "days_without_revenue")
MONTH_COLUMNS = "round(revenue, 2) AS revenue, " + ", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in S.INTEGER_METRICS)
ORDINARY = f"date >= DATE '{SINCE}' AND NOT (month(date) = 12 AND day(date) >= 21)"


def monthly(spark, sf_dir):
    return X.monthly_rollup(series(spark, sf_dir))


@query("gap_window_flag", f"""WITH {S.DAILY},
gaps AS (SELECT make_date(y, 12, 21) AS lo, make_date(y, 12, 31) AS hi FROM (SELECT unnest({list(GAP_YEARS)}) AS y)),
spans AS (SELECT series, min(date) AS first, max(date) AS last FROM daily GROUP BY series)
SELECT d.series, {day('d.date')}, count(g.lo) > 0 AS in_gap_window, d.date <= DATE '{FULL_FROM}' AS in_partial_start
FROM daily d JOIN spans s ON d.series = s.series
LEFT JOIN gaps g ON d.date BETWEEN g.lo AND g.hi AND s.first <= g.lo AND s.last >= g.hi
GROUP BY d.series, d.date""")
def gap_window_flag(spark, sf_dir):
    return shown(X.flag_gaps(series(spark, sf_dir), GAP_YEARS, FULL_FROM))


@query("monthly_rollup", f"""WITH {MONTHLY}
SELECT series, {day('month_start', 'month_start')}, {MONTH_COLUMNS}, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in COUNTS)},
       CAST(day(last_day(month_start)) AS BIGINT) AS days_in_month FROM monthly""")
def monthly_rollup(spark, sf_dir):
    return rounded(monthly(spark, sf_dir), 2)


@query("partial_months", f"WITH {MONTHLY} SELECT series, {day('month_start', 'month_start')}, is_partial FROM flagged")
def partial_months(spark, sf_dir):
    return shown(X.partial_months(monthly(spark, sf_dir)).select("series", "month_start", "is_partial"))


@query("full_month_stats", f"""WITH {MONTHLY}
SELECT series, CAST(count(*) FILTER (NOT is_partial) AS BIGINT) AS n_full_months,
       CAST(count(*) FILTER (is_partial) AS BIGINT) AS n_partial_months,
       round(avg(revenue) FILTER (NOT is_partial), 4) AS monthly_revenue_mean,
       round(min(revenue) FILTER (NOT is_partial), 4) AS monthly_revenue_min,
       round(max(revenue) FILTER (NOT is_partial), 4) AS monthly_revenue_max,
       round(stddev_samp(revenue) FILTER (NOT is_partial) / avg(revenue) FILTER (NOT is_partial), 4) AS monthly_revenue_cv
FROM flagged GROUP BY series""")
def full_month_stats(spark, sf_dir):
    return rounded(X.full_month_stats(X.partial_months(monthly(spark, sf_dir))), 4)


@query("trim_edge_months", f"""WITH {MONTHLY}
SELECT series, {day('month_start', 'month_start')}, round(revenue, 2) AS revenue FROM placed
WHERE n <= 2 OR (position > 1 AND position < n)""")
def trim_edge_months(spark, sf_dir):
    return rounded(X.trim_edge_months(monthly(spark, sf_dir)).select("series", "month_start", "revenue"), 2)


@query("monthly_correlations", f"""WITH {MONTHLY}
SELECT series, round(corr(purchases, revenue), 6) AS purchases_revenue, round(corr(unique_streams, revenue), 6) AS streams_revenue,
       round(corr(unique_customers, revenue), 6) AS customers_revenue
FROM placed WHERE position > 1 AND position < n GROUP BY series""")
def monthly_correlations(spark, sf_dir):
    return rounded(X.monthly_correlations(monthly(spark, sf_dir)), 6)


@query("daily_corr_fit", f"""WITH {S.DAILY}
SELECT series, round(corr(purchases, revenue), 6) AS r, round(regr_slope(revenue, purchases), 4) AS slope,
       round(regr_intercept(revenue, purchases), 4) AS intercept FROM daily WHERE revenue > 0 GROUP BY series""")
def daily_corr_fit(spark, sf_dir):
    return shown(X.daily_fit(series(spark, sf_dir)), r=6, slope=4, intercept=4)


@query("dow_distribution", f"""WITH {S.DAILY},
days AS (SELECT series, revenue, strftime(date, '%A') AS weekday FROM daily WHERE {ORDINARY}),
boxes AS (
  SELECT series, weekday, count(*) AS n_days, quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.5) AS median,
         quantile_cont(revenue, 0.75) AS q3 FROM days GROUP BY series, weekday
)
SELECT b.series, b.weekday, CAST(n_days AS BIGINT) AS n_days, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(least(q1, min(d.revenue)), 4) AS whisker_low, round(greatest(q3, max(d.revenue)), 4) AS whisker_high
FROM boxes b JOIN days d ON b.series = d.series AND b.weekday = d.weekday
     AND d.revenue BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY b.series, b.weekday, n_days, q1, median, q3""")
def dow_distribution(spark, sf_dir):
    return rounded(X.weekday_distribution(series(spark, sf_dir), SINCE), 4)


@query("weekend_medians", f"""WITH {S.DAILY}
SELECT series, round(median(revenue) FILTER (isodow(date) = 6), 4) AS saturday_median,
       round(median(revenue) FILTER (isodow(date) < 6), 4) AS weekday_median FROM daily WHERE {ORDINARY} GROUP BY series""")
def weekend_medians(spark, sf_dir):
    return rounded(X.weekend_medians(series(spark, sf_dir), SINCE), 4)


@query("revenue_shares", f"""WITH {S.CLEAN}{S.TOP},
sums AS (
  SELECT sum(price) AS total, sum(price) FILTER (country = '{HOME}') AS home,
         (SELECT sum(revenue) FROM top) AS top_sum, (SELECT sum(revenue) FROM top WHERE country <> '{HOME}') AS abroad,
         count(DISTINCT country) FILTER ({S.MARKETS}) AS n
  FROM clean
)
SELECT round(total, 2) AS total_revenue, round(top_sum / total, 6) AS top_share_of_revenue,
       round(home / total, 6) AS home_share_of_revenue, CAST(n AS BIGINT) AS n_countries_observed,
       round(abroad / (total - home), 6) AS top_abroad_share_of_abroad, round(abroad / total, 6) AS top_abroad_share_of_total
FROM sums""")
def revenue_shares(spark, sf_dir):
    out = X.revenue_shares(clean(spark, sf_dir), labels=LABELS, home=HOME)
    shares = {c: 6 for c in out.columns if "share" in c}
    return shown(out, total_revenue=2, **shares)


@query("home_vs_rest", f"""WITH {S.CLEAN}
SELECT CASE WHEN country = '{HOME}' THEN 'home' ELSE 'rest' END AS bucket, round(sum(price), 2) AS revenue FROM clean GROUP BY 1""")
def home_vs_rest(spark, sf_dir):
    return rounded(X.home_vs_rest(clean(spark, sf_dir), HOME), 2)


@query("rank_rest", f"""WITH {S.CLEAN}{S.TOP},
rest AS (
  SELECT country, sum(price) AS revenue FROM clean WHERE {S.MARKETS} AND country <> '{HOME}'
  GROUP BY country ORDER BY revenue DESC, country LIMIT 14
)
SELECT country, round(revenue, 2) AS revenue, country IN (SELECT country FROM top) AS is_modelled FROM rest""")
def rank_rest(spark, sf_dir):
    return rounded(X.rank_rest(clean(spark, sf_dir), top(spark, sf_dir), labels=LABELS, home=HOME), 2)


@query("membership_flag", f"""WITH {S.CLEAN}{S.TOP}
SELECT country, round(sum(price), 2) AS revenue, country IN (SELECT country FROM top) AS is_modelled FROM clean GROUP BY country""")
def membership_flag(spark, sf_dir):
    return rounded(X.flag_members(revenue_by_country(clean(spark, sf_dir)), top(spark, sf_dir)), 2)


@query("top_n", f"""WITH {MONTHLY}
SELECT series, {day('month_start', 'month_start')}, round(revenue, 2) AS revenue FROM monthly WHERE series = 'overall'
ORDER BY revenue DESC, month_start LIMIT 12""")
def top_n(spark, sf_dir):
    months = monthly(spark, sf_dir).where(F.col("series") == "overall").select("series", "month_start", "revenue")
    return rounded(EV.top_rows(months, "revenue", 12, "month_start"), 2)


@query("price_histogram", f"""WITH {S.CLEAN},
p AS (SELECT price FROM clean WHERE price > 0),
limits AS (SELECT log10(greatest(min(price), 0.01)) AS lo, log10(quantile_cont(price, 0.999)) AS hi, greatest(min(price), 0.01) AS low FROM p),
counts AS (
  SELECT least(CAST(floor((log10(price) - lo) / ((hi - lo) / 39)) AS BIGINT), 38) AS bin, count(*) AS n
  FROM p, limits WHERE price >= low GROUP BY 1
)
SELECT b.bin AS bin, round(pow(10, lo + b.bin * ((hi - lo) / 39)), 4) AS left_edge,
       round(pow(10, lo + (b.bin + 1) * ((hi - lo) / 39)), 4) AS right_edge, CAST(coalesce(n, 0) AS BIGINT) AS n_transactions
FROM (SELECT unnest(generate_series(0, 38)) AS bin) b CROSS JOIN limits LEFT JOIN counts c ON b.bin = c.bin""")
def price_histogram(spark, sf_dir):
    return rounded(X.price_histogram(clean(spark, sf_dir)), 4)


@query("price_stats", f"""WITH {S.CLEAN}
SELECT round(quantile_cont(price, 0.5), 4) AS price_median, round(avg(price), 4) AS price_mean,
       round(quantile_cont(price, 0.95), 4) AS price_p95 FROM clean WHERE price > 0""")
def price_stats(spark, sf_dir):
    return rounded(X.price_stats(clean(spark, sf_dir)), 4)


@query("missing_rate_by_month", f"""WITH {S.CLEAN},
m AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, avg(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS missing_rate
  FROM clean GROUP BY 1
),
p AS (SELECT *, row_number() OVER (ORDER BY month_start) AS position, count(*) OVER () AS n FROM m)
SELECT {day('month_start', 'month_start')}, round(missing_rate, 6) AS missing_rate FROM p WHERE n <= 2 OR (position > 1 AND position < n)""")
def missing_rate_by_month(spark, sf_dir):
    return rounded(X.missing_rate_by_month(clean(spark, sf_dir)), 6)


@query("dataset_profile", f"""WITH {S.CLEAN}
SELECT round(avg(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END), 6) AS missing_customer_rate,
       {day('min(date)', 'date_min')}, {day('max(date)', 'date_max')}, CAST(count(*) AS BIGINT) AS n_transactions,
       CAST(count(DISTINCT invoice_clean) AS BIGINT) AS n_invoices FROM clean""")
def dataset_profile(spark, sf_dir):
    return rounded(X.dataset_profile(clean(spark, sf_dir)), 6)
