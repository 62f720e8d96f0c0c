"""Checked queries: ranking, daily series, window features and joins on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.catalog import sqltext as S
from tillcast.catalog.ingest_queries import clean
from tillcast.catalog.registry import day, query, rounded, shown
from tillcast.catalog.tables import HOME, LABELS, table
from tillcast.constants import DAILY_METRICS, MIN_TRAINING_ROWS, TRAILING_WINDOWS
from tillcast.functions.coercion import slug
from tillcast.operators import daily as D
from tillcast.operators import evaluation as EV
from tillcast.operators import explore as X
from tillcast.operators import markets as M
from tillcast.operators import supervised as SV
from tillcast.session import scratch_path
from tillcast.sinks import tables as W
from tillcast.sources import series as SRC

KEYS = ("series", "date")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.daily_activity(clean(spark, sf_dir))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.daily_series(clean(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.build_features(series(spark, sf_dir))


def supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.build_supervised(series(spark, sf_dir))


def top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.top_countries(clean(spark, sf_dir), labels=LABELS, home=HOME)


METRIC_SQL = "round(revenue, 2) AS revenue, " + ", ".join(S.INTEGER_METRICS)
DAILY_SELECT = f"SELECT series, {day('date')}, {METRIC_SQL}"


# --- ranking and series ---------------------------------------------------------------------------

@query("top_countries_by_revenue", f"WITH {S.CLEAN}{S.TOP} SELECT country, round(revenue, 2) AS revenue FROM top")
def top_countries_by_revenue(spark, sf_dir):
    return rounded(top(spark, sf_dir), 2)


@query("top_countries_abroad", f"""WITH {S.CLEAN}
SELECT country, round(sum(price), 2) AS revenue FROM clean WHERE {S.MARKETS} AND country <> '{HOME}'
GROUP BY country ORDER BY sum(price) DESC, country LIMIT 5""")
def top_countries_abroad(spark, sf_dir):
    return rounded(M.top_countries(clean(spark, sf_dir), 5, True, LABELS, HOME), 2)


@query("daily_series", f"WITH {S.ACTIVITY} {DAILY_SELECT} FROM activity")
def daily_series(spark, sf_dir):
    return rounded(activity(spark, sf_dir).drop("n_lines"), 2)


@query("overall_series", f"WITH {S.ACTIVITY} {DAILY_SELECT} FROM activity WHERE series = 'overall'")
def overall_series(spark, sf_dir):
    return rounded(activity(spark, sf_dir).where(F.col("series") == "overall").drop("n_lines"), 2)


@query("densify_calendar", f"WITH {S.DAILY} {DAILY_SELECT} FROM daily")
def densify_calendar(spark, sf_dir):
    return rounded(D.densify(activity(spark, sf_dir)), 2)


@query("asfreq_fill", f"""WITH {S.DAILY}
SELECT series, CAST(count(*) AS BIGINT) AS n_days, {day('min(date)', 'first_date')}, {day('max(date)', 'last_date')},
       round(sum(revenue), 2) AS revenue FROM daily GROUP BY series""")
def asfreq_fill(spark, sf_dir):
    again = D.densify(series(spark, sf_dir))
    return shown(again.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("revenue").alias("revenue"),
    ), revenue=2)


@query("round_revenue", f"WITH {S.DAILY} SELECT series, {day('date')}, revenue FROM daily")
def round_revenue(spark, sf_dir):
    return shown(series(spark, sf_dir).select(*KEYS, "revenue"))


@query("series_for_top_countries", f"""WITH {S.DAILY}{S.TOP}
{DAILY_SELECT} FROM daily WHERE series = 'overall' OR series IN (SELECT country FROM top)""")
def series_for_top_countries(spark, sf_dir):
    return rounded(D.keep_series(series(spark, sf_dir), top(spark, sf_dir)), 2)


@query("series_slug", f"WITH {S.ACTIVITY} SELECT DISTINCT series, replace(lower(series), ' ', '_') AS slug FROM activity")
def series_slug(spark, sf_dir):
    return activity(spark, sf_dir).select("series").distinct().withColumn("slug", slug(F.col("series")))


@query("write_daily_series", f"WITH {S.DAILY} {DAILY_SELECT} FROM daily")
def write_daily_series(spark, sf_dir):
    path = scratch_path(spark, "series")
    W.write_daily_series(series(spark, sf_dir), path)
    return rounded(SRC.read_series_table(spark, path), 2)


@query("read_daily_series", f"WITH {S.DAILY} {DAILY_SELECT} FROM daily")
def read_daily_series(spark, sf_dir):
    files = W.write_series_csv(series(spark, sf_dir), scratch_path(spark, "csv"))
    return rounded(SRC.read_series_csv(spark, *files), 2)


@query("unknown_series", """
SELECT DISTINCT r_name AS series FROM region""")
def unknown_series(spark, sf_dir):
    """Nations are known series, regions are not."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("series"))
    asked = nations.union(table(spark, sf_dir, "region").select("r_name"))
    return D.unknown_series(asked, activity(spark, sf_dir))


# --- windows --------------------------------------------------------------------------------------

def _windows(names) -> str:
    return f"WITH {S.DAILY} SELECT series, {day('date')}, " + ", ".join(
        f"round({S.FEATURE_SQL[n]}, 4) AS {n}" for n in names
    ) + " FROM daily"


SUMS = [f"{m}_sum_{w}d" for m in DAILY_METRICS for w in TRAILING_WINDOWS]
MEANS = [f"{m}_mean_{w}d" for m in DAILY_METRICS for w in TRAILING_WINDOWS]
LAGS = [f"{m}_lag_30d" for m in DAILY_METRICS]
TRENDS = [f"{m}_trend_28d" for m in DAILY_METRICS]


def _columns(spark, sf_dir, names) -> DataFrame:
    return rounded(SV.build_features(series(spark, sf_dir), with_target=False).select(*KEYS, *names), 4)


@query("trailing_sums", _windows(SUMS))
def trailing_sums(spark, sf_dir):
    return _columns(spark, sf_dir, SUMS)


@query("trailing_means", _windows(MEANS))
def trailing_means(spark, sf_dir):
    return _columns(spark, sf_dir, MEANS)


@query("lag_horizon", _windows(LAGS))
def lag_horizon(spark, sf_dir):
    return _columns(spark, sf_dir, LAGS)


@query("trend_28d", _windows(TRENDS))
def trend_28d(spark, sf_dir):
    return _columns(spark, sf_dir, TRENDS)


@query("prior_year_window", _windows(["revenue_sum_30d_prior_year"]))
def prior_year_window(spark, sf_dir):
    return rounded(features(spark, sf_dir).select(*KEYS, "revenue_sum_30d_prior_year"), 4)


@query("has_prior_year", f"""WITH {S.FEATURES}
SELECT series, {day('date')}, CAST(has_prior_year_data AS BIGINT) AS has_prior_year_data FROM features""")
def has_prior_year(spark, sf_dir):
    return shown(features(spark, sf_dir).select(*KEYS, "has_prior_year_data"))


CALENDAR = ("dow", "day_of_month", "month", "is_year_end_window")


@query("calendar_features", f"WITH {S.DAILY} SELECT series, {day('date')}, " + ", ".join(
    f"CAST({S.FEATURE_SQL[n]} AS BIGINT) AS {n}" for n in CALENDAR
) + " FROM daily")
def calendar_features(spark, sf_dir):
    return shown(series(spark, sf_dir).select(*KEYS, *[c.alias(n) for n, c in SV.calendar_columns().items()]))


@query("target_next_30d", f"""WITH {S.FEATURES}
SELECT series, {day('date')}, round(target, 2) AS target_revenue_next_30d FROM features""")
def target_next_30d(spark, sf_dir):
    return rounded(series(spark, sf_dir).select(*KEYS, SV.next_days_sum().alias(SV.TARGET)), 2)


def _typed(n: str) -> str:
    """A feature as the Spark result shows it."""
    whole = n in CALENDAR or n == "has_prior_year_data" or (n.endswith("_lag_30d") and not n.startswith("revenue"))
    return f"CAST({n} AS BIGINT) AS {n}" if whole else f"round({n}, 4) AS {n}"


ALL_FEATURES_SQL = ", ".join(_typed(n) for n in S.FEATURE_SQL)


@query("build_supervised", f"""WITH {S.SUPERVISED}
SELECT series, {day('date')}, {ALL_FEATURES_SQL}, round(target, 4) AS target_revenue_next_30d FROM supervised""")
def build_supervised(spark, sf_dir):
    return rounded(supervised(spark, sf_dir), 4)


FRAME_30 = S.over("29 PRECEDING", "CURRENT ROW")


@query("rolling_mean_30_min7", f"""WITH {S.DAILY}
SELECT series, {day('date')}, revenue, CASE WHEN count(*) {FRAME_30} >= 7 THEN round(sum(revenue) {FRAME_30}, 2) END AS mean_times_days
FROM daily""")
def rolling_mean_30_min7(spark, sf_dir):
    """The mean is shown times its number of days, in whole cents: exact halves round differently per engine."""
    out = X.rolling_mean(series(spark, sf_dir))
    days = F.least(F.row_number().over(SV.by_day()), F.lit(30))
    return shown(out.withColumn("mean_times_days", F.col("rolling_mean") * days).drop("rolling_mean"), mean_times_days=2)


INDEXED = S.DAILY + ",\nrolled AS (SELECT series, date, row_number() OVER (PARTITION BY series ORDER BY date) AS n, " + ", ".join(
    f"avg({m}) {S.over('6 PRECEDING', 'CURRENT ROW')} AS {m}" for m in ("revenue", "purchases", "total_views")
) + " FROM daily),\nindexed AS (SELECT series, date, " + ", ".join(
    f"{m} / avg({m}) OVER (PARTITION BY series) * 100 AS {m}_index" for m in ("revenue", "purchases", "total_views")
) + " FROM rolled WHERE n >= 7)"
INDEX_NAMES = [f"{m}_index" for m in ("revenue", "purchases", "total_views")]


@query("comoving_index", f"WITH {INDEXED} SELECT series, {day('date')}, {S.rounded_columns(INDEX_NAMES, 4)} FROM indexed")
def comoving_index(spark, sf_dir):
    return rounded(X.comoving_index(series(spark, sf_dir)), 4)


@query("comoving_correlations", f"""WITH {INDEXED}
SELECT series, round(corr(revenue_index, purchases_index), 6) AS revenue_purchases,
       round(corr(revenue_index, total_views_index), 6) AS revenue_total_views,
       round(corr(purchases_index, total_views_index), 6) AS purchases_total_views FROM indexed GROUP BY series""")
def comoving_correlations(spark, sf_dir):
    return rounded(X.comoving_correlations(X.comoving_index(series(spark, sf_dir))), 6)


@query("chronological_holdout", f"WITH {S.SPLIT} SELECT series, {day('date')}, role FROM split")
def chronological_holdout(spark, sf_dir):
    return shown(SV.chronological_holdout(supervised(spark, sf_dir)).select(*KEYS, "role"))


@query("time_series_folds", f"""WITH {S.SPLIT},
folded AS (
  SELECT series, date, fold, CASE WHEN row_no <= n - (5 - fold) * (n // 5) THEN 'train'
         WHEN row_no <= n - (5 - fold) * (n // 5) + n // 5 THEN 'test' END AS role
  FROM counted, (SELECT unnest([1, 2, 3, 4]) AS fold)
)
SELECT series, CAST(fold AS BIGINT) AS fold, role, CAST(count(*) AS BIGINT) AS n_rows,
       {day('min(date)', 'first_date')}, {day('max(date)', 'last_date')}
FROM folded WHERE role IS NOT NULL GROUP BY series, fold, role""")
def time_series_folds(spark, sf_dir):
    folds = SV.time_series_folds(supervised(spark, sf_dir))
    return shown(folds.groupBy("series", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ))


@query("series_summary", f"""WITH {S.SUPERVISED}
SELECT series, CAST(count(*) AS BIGINT) AS n_training_rows, {day('min(date)', 'first_date')}, {day('max(date)', 'last_date')},
       CASE WHEN count(*) < {MIN_TRAINING_ROWS} THEN 'only ' || count(*) || ' usable training rows' END AS skip_reason
FROM supervised GROUP BY series""")
def series_summary(spark, sf_dir):
    return shown(SV.series_summary(supervised(spark, sf_dir), MIN_TRAINING_ROWS))


# --- joins on features ----------------------------------------------------------------------------

# Every order asks for its nation's features on its day, 100 days later, and before the data begin.
ASKED_SQL = """
asked AS (
  SELECT n_name AS series, CAST(o_orderdate AS DATE) + offset_days AS date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey,
       (SELECT unnest([0, 100, -2500]) AS offset_days)
)"""


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    offsets = F.explode(F.array(F.lit(0), F.lit(100), F.lit(-2500))).alias("offset_days")
    return table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("n_name").alias("series"), F.to_date("o_orderdate").alias("day"), offsets
    ).select("series", F.date_add("day", F.col("offset_days")).alias("date"))


SHORT_LIST = ("revenue_sum_7d", "revenue_mean_28d", "revenue_trend_28d", "revenue_sum_30d_prior_year", "total_views_sum_70d")


@query("asof_feature_row", f"""WITH {S.FEATURES}, {ASKED_SQL}
SELECT f.series, {day('f.date')}, {S.rounded_columns(list(SHORT_LIST), 4)}
FROM features f SEMI JOIN asked a ON f.series = a.series AND f.date = a.date""")
def asof_feature_row(spark, sf_dir):
    rows = SV.features_as_of(features(spark, sf_dir), asked(spark, sf_dir))
    return rounded(rows.select(*KEYS, *SHORT_LIST), 4)


@query("asof_out_of_range", f"""WITH {S.DAILY}, {ASKED_SQL}
SELECT a.series, {day('a.date')}, CAST(count(*) AS BIGINT) AS n_requests
FROM asked a ANTI JOIN daily d ON a.series = d.series AND a.date = d.date GROUP BY a.series, a.date""")
def asof_out_of_range(spark, sf_dir):
    outside = SV.requests_out_of_range(series(spark, sf_dir), asked(spark, sf_dir))
    return shown(outside.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_requests")))


@query("latest_feature_row", f"""WITH {S.FEATURES}
SELECT series, {day('date')}, {S.rounded_columns(list(SHORT_LIST), 4)} FROM features
QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) = 1""")
def latest_feature_row(spark, sf_dir):
    return rounded(SV.latest_features(features(spark, sf_dir)).select(*KEYS, *SHORT_LIST), 4)


@query("actual_next_horizon", f"""WITH {S.FEATURES}, {ASKED_SQL}
SELECT a.series, {day('a.date')}, round(target, 2) AS actual_revenue_next_30d, CAST(count(*) AS BIGINT) AS n_requests
FROM asked a LEFT JOIN features f ON a.series = f.series AND a.date = f.date GROUP BY a.series, a.date, target""")
def actual_next_horizon(spark, sf_dir):
    actuals = EV.actual_next_days(series(spark, sf_dir))
    requests = asked(spark, sf_dir).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_requests"))
    return rounded(requests.join(actuals, list(KEYS), "left"), 2)
