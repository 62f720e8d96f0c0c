"""Checked queries: baselines, evaluation, drift, scoring, back-testing; learned models rows-only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.catalog import sqltext as S
from tillcast.catalog.ingest_queries import clean
from tillcast.catalog.registry import day, query, rounded, shown
from tillcast.catalog.series_queries import SHORT_LIST, activity, features, series, supervised, top
from tillcast.catalog.tables import LABELS, table
from tillcast.operators import daily as D
from tillcast.operators import drift as DR
from tillcast.operators import evaluation as EV
from tillcast.operators import forecast as FC
from tillcast.operators import ridge as R
from tillcast.operators import supervised as SV
from tillcast.plans import comparison, scoring, training
from tillcast.plans.backtest import rolling_origin_backtest
from tillcast.plans.model_store import current_folder
from tillcast.session import materialise, scratch_path

PREDICTED = "SELECT series, {0}, model, round(actual, 2) AS actual, round(predicted, 2) AS predicted FROM {1}".format(day("date"), "{0}")
LEARNED_SETTINGS = {
    "ridge": {"alpha": 10.0},
    "random_forest": {"n_estimators": 200, "max_depth": 6},
    "gbt": {"max_depth": 3, "learning_rate": 0.1, "max_iter": 100},
    "gbt_leafwise": {"n_estimators": 150, "max_depth": 4, "learning_rate": 0.1, "num_leaves": 15},
}


def overall_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows of the overall series: all lines, one row per day."""
    return materialise(supervised(spark, sf_dir).where(F.col("series") == "overall"), "overall")


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.chronological_holdout(supervised(spark, sf_dir))


def baseline_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.baseline_predictions(holdout(spark, sf_dir).where(F.col("role") == "test"))


# --- baselines and metrics ------------------------------------------------------------------------

@query("naive_forecast", f"WITH {S.BASELINES} {PREDICTED.format('predictions')} WHERE model = 'naive'")
def naive_forecast(spark, sf_dir):
    return rounded(baseline_holdout(spark, sf_dir).where(F.col("model") == "naive"), 2)


@query("seasonal_naive_forecast", f"WITH {S.BASELINES} {PREDICTED.format('predictions')} WHERE model = 'seasonal_naive'")
def seasonal_naive_forecast(spark, sf_dir):
    return rounded(baseline_holdout(spark, sf_dir).where(F.col("model") == "seasonal_naive"), 2)


METRIC_PLACES = {"mae": 2, "rmse": 2, "mean_actual": 2}


# Percentage errors reach 1e12 where an actual is near zero: their logarithm is compared.
@query("regression_metrics", f"""WITH {S.MODEL_METRICS}
SELECT series, model, {S.rounded_columns(METRIC_PLACES)}, round(log10(mape), 8) AS log10_mape FROM metrics""")
def regression_metrics(spark, sf_dir):
    out = EV.regression_metrics(baseline_holdout(spark, sf_dir)).withColumn("log10_mape", F.log10("mape")).drop("mape")
    return shown(out, log10_mape=8, **METRIC_PLACES)


@query("evaluate_models", f"""WITH {S.MODEL_METRICS}
SELECT model, CAST(count(*) AS BIGINT) AS n_series, round(avg(mae), 2) AS mae, round(log10(avg(mape)), 8) AS log10_mape
FROM metrics GROUP BY model""")
def evaluate_models(spark, sf_dir):
    built = materialise(supervised(spark, sf_dir), "supervised")
    predictions = comparison.holdout_predictions(built, {}, FC.BASELINES)
    per_series = EV.regression_metrics(predictions)
    return shown(per_series.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_series"), F.avg("mae").alias("mae"), F.log10(F.avg("mape")).alias("log10_mape"),
    ), mae=2, log10_mape=8)


def _normalised(spark, sf_dir):
    built = materialise(supervised(spark, sf_dir), "supervised")
    test = SV.chronological_holdout(built).where(F.col("role") == "test")
    return EV.normalised_mae(EV.regression_metrics(FC.baseline_predictions(test)), built)


@query("normalised_mae", f"WITH {S.MODEL_METRICS} SELECT series, model, round(normalised_mae, 8) AS normalised_mae FROM normalised")
def normalised_mae(spark, sf_dir):
    return shown(_normalised(spark, sf_dir).select("series", "model", "normalised_mae"), normalised_mae=8)


@query("rank_models", f"""WITH {S.MODEL_METRICS}
SELECT model, round(avg(normalised_mae), 8) AS avg_normalised_mae, CAST(count(*) AS BIGINT) AS n_series FROM normalised GROUP BY model""")
def rank_models(spark, sf_dir):
    return shown(EV.rank_models(_normalised(spark, sf_dir)), avg_normalised_mae=8)


@query("select_winner", f"""WITH {S.MODEL_METRICS}, r AS (SELECT model, avg(normalised_mae) AS score FROM normalised GROUP BY model)
SELECT model AS winner, round(score, 8) AS avg_normalised_mae FROM r ORDER BY score, model LIMIT 1""")
def select_winner(spark, sf_dir):
    return shown(EV.select_winner(_normalised(spark, sf_dir)), avg_normalised_mae=8)


@query("best_model_per_series", f"""WITH {S.MODEL_METRICS}
SELECT series, model, round(mae, 2) AS mae FROM metrics QUALIFY row_number() OVER (PARTITION BY series ORDER BY mae, model) = 1""")
def best_model_per_series(spark, sf_dir):
    return shown(EV.best_model_per_series(EV.regression_metrics(baseline_holdout(spark, sf_dir))), mae=2)


@query("naive_vs_winner", f"""WITH {S.MODEL_METRICS}
SELECT series, round(mean_target, 2) AS mean_target, round(max(normalised_mae) FILTER (model = 'naive'), 8) AS naive_normalised_mae,
       round(max(normalised_mae) FILTER (model = 'seasonal_naive'), 8) AS winner_normalised_mae FROM normalised GROUP BY series, mean_target""")
def naive_vs_winner(spark, sf_dir):
    out = EV.naive_vs_winner(_normalised(spark, sf_dir), "seasonal_naive")
    return shown(out, mean_target=2, naive_normalised_mae=8, winner_normalised_mae=8)


# --- logged forecasts against actuals -------------------------------------------------------------

LOGGED = S.FEATURES + """,
logged AS (
  SELECT series, date, round(revenue_sum_28d, 2) AS predicted, target AS actual FROM features WHERE revenue_sum_28d IS NOT NULL
),
errors AS (
  SELECT *, predicted - actual AS error, abs(predicted - actual) / greatest(actual, 1.0) * 100 AS ape FROM logged
)"""


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The naive forecast of every day with enough history, as if logged, against later actuals."""
    daily = materialise(series(spark, sf_dir), "series")
    logged = SV.build_features(daily).where(FC.naive().isNotNull()).select(
        F.col("series").alias("country"), F.col("date").alias("as_of_date"),
        F.round(FC.naive(), 2).alias("predicted_revenue_next_30d"),
    )
    return materialise(EV.evaluate_logged(logged, daily), "evaluated")


@query("eval_summary_by_series", f"""WITH {LOGGED}
SELECT series AS country, CAST(count(*) AS BIGINT) AS n, round(avg(abs(error)), 2) AS mae, round(avg(ape), 6) AS mape_floor1,
       round(avg(actual), 2) AS mean_actual FROM errors WHERE actual IS NOT NULL GROUP BY series""")
def eval_summary_by_series(spark, sf_dir):
    return shown(EV.summary_by_series(evaluated(spark, sf_dir)), mae=2, mape_floor1=6, mean_actual=2)


GLOBAL_PLACES = {"corr_abs_error_vs_revenue": 6, "overall_mae": 2, "overall_mape_floor1": 6}
GLOBAL_SQL = """SELECT CAST(count(*) AS BIGINT) AS n_logged, CAST(count(actual) AS BIGINT) AS n_evaluated,
  round(corr(actual, abs(error)), 6) AS corr_abs_error_vs_revenue,
  round(avg(abs(error)) FILTER (series = 'overall'), 2) AS overall_mae,
  round(avg(ape) FILTER (series = 'overall'), 6) AS overall_mape_floor1 FROM errors"""


@query("eval_global", f"WITH {LOGGED} {GLOBAL_SQL}")
def eval_global(spark, sf_dir):
    return shown(EV.global_stats(evaluated(spark, sf_dir)), **GLOBAL_PLACES)


@query("write_eval", f"WITH {LOGGED} {GLOBAL_SQL}")
def write_eval(spark, sf_dir):
    from tillcast.sinks.tables import write_evaluation

    rows = evaluated(spark, sf_dir)
    path = scratch_path(spark, "evaluation")
    stats = EV.global_stats(rows)
    write_evaluation(EV.evaluated_only(rows), EV.summary_by_series(rows), stats, path)
    return shown(spark.read.schema(stats.schema).json(f"{path}/stats"), **GLOBAL_PLACES)


# --- drift ----------------------------------------------------------------------------------------

CUTOFF = "2000-06-30"
NAMES = list(S.FEATURE_SQL)
TYPED = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in NAMES)
SUMMARY = S.SUPERVISED + f""",
long_train AS (
  UNPIVOT (SELECT series, {TYPED} FROM supervised WHERE date <= DATE '{CUTOFF}') ON {', '.join(NAMES)} INTO NAME feature VALUE v
),
summary AS (
  SELECT series, feature, count(*) AS n_rows, avg(v) AS mean,
         CASE WHEN stddev_pop(v) = 0 THEN 1e-9 ELSE stddev_pop(v) END AS std FROM long_train GROUP BY series, feature
)"""
# Recent rows: the last 30 days of each series.
ZSCORES = SUMMARY + f""",
recent AS (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 30),
long_recent AS (UNPIVOT (SELECT series, {TYPED} FROM recent) ON {', '.join(NAMES)} INTO NAME feature VALUE v),
means AS (SELECT series, feature, count(*) AS n_recent, avg(v) AS recent_mean FROM long_recent GROUP BY series, feature),
z AS (
  SELECT s.series, s.feature, n_recent, coalesce((recent_mean - mean) / std, 0) AS z
  FROM summary s JOIN means m ON s.series = m.series AND s.feature = m.feature
)"""


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = supervised(spark, sf_dir).where(F.col("date") <= F.lit(CUTOFF).cast("date"))
    return DR.feature_summary(train)


def zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    newest = Window.partitionBy("series").orderBy(F.desc("date"))
    rows = materialise(features(spark, sf_dir), "features")
    recent = rows.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= 30).drop("_age")
    train = rows.dropna().where(F.col("date") <= F.lit(CUTOFF).cast("date"))
    return DR.feature_zscores(DR.feature_summary(train), recent)


@query("feature_summary", f"""WITH {SUMMARY}
SELECT series, feature, CAST(n_rows AS BIGINT) AS n_rows, round(mean, 2) AS mean, round(std, 2) AS std FROM summary""")
def feature_summary(spark, sf_dir):
    return shown(summary(spark, sf_dir), mean=2, std=2)


@query("attach_feature_summary", f"""WITH {ZSCORES}
SELECT z.series, z.feature, CAST(n_recent AS BIGINT) AS n_recent_rows, CAST(n_rows AS BIGINT) AS n_train_rows
FROM z JOIN summary s ON z.series = s.series AND z.feature = s.feature""")
def attach_feature_summary(spark, sf_dir):
    return shown(zscores(spark, sf_dir).select("series", "feature", "n_recent_rows", "n_train_rows"))


@query("feature_zscores", f"WITH {ZSCORES} SELECT series, feature, round(z, 5) AS z FROM z")
def feature_zscores(spark, sf_dir):
    return shown(zscores(spark, sf_dir).select("series", "feature", "z"), z=5)


@query("drift_flags", f"WITH {ZSCORES} SELECT series, feature, round(z, 2) AS z FROM z WHERE abs(z) > 1.0")
def drift_flags(spark, sf_dir):
    return shown(DR.drift_flags(zscores(spark, sf_dir), 1.0).select("series", "feature", "z"), z=2)


@query("drift_verdict", f"""WITH {ZSCORES}
SELECT series, 3.0::DOUBLE AS z_threshold, CAST(max(n_recent) AS BIGINT) AS n_recent_rows, CAST(count(*) AS BIGINT) AS n_features_checked,
       CAST(count(*) FILTER (abs(z) > 3) AS BIGINT) AS n_flagged, round(max(abs(z)), 2) AS max_abs_z, bool_or(abs(z) > 3) AS drift_detected,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (abs(z) > 3), '') AS flagged
FROM z GROUP BY series""")
def drift_verdict(spark, sf_dir):
    flagged = F.array_join(F.sort_array(F.transform("flagged_features", lambda f: f["feature"])), ",")
    return shown(DR.drift_verdict(zscores(spark, sf_dir)).withColumn("flagged", flagged).drop("flagged_features"))


# --- requests -------------------------------------------------------------------------------------

# Every order asks for its nation on its day; some names and dates are wrong or missing.
REQUESTS_SQL = """
requests AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 'Atlantis'
              WHEN o_orderkey % 7 = 0 THEN ' OverALL ' ELSE ' ' || lower(n_name) END AS country,
         CASE WHEN o_orderkey % 83 = 0 THEN '2050-01-01' WHEN o_orderkey % 79 = 0 THEN 'soon'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
trained AS (SELECT 'overall' AS series UNION ALL SELECT country FROM top),
prepared AS (
  SELECT r.country, r.date, t.series, try_cast(r.date AS DATE) AS as_of
  FROM requests r LEFT JOIN trained t ON lower(trim(r.country)) = lower(t.series)
),
answered AS (
  SELECT p.*, f.revenue_sum_28d, f.date AS found,
         CASE WHEN p.country IS NULL THEN 'missing_field' WHEN p.series IS NULL THEN 'unknown_series'
              WHEN as_of IS NULL THEN 'invalid_date' WHEN f.date IS NULL THEN 'out_of_range'
              WHEN f.revenue_sum_70d IS NULL THEN 'insufficient_history' ELSE 'ok' END AS status
  FROM prepared p LEFT JOIN features f ON p.series = f.series AND p.as_of = f.date
)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    buyers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(key % 97 == 0, F.lit(None).cast("string")).when(key % 89 == 0, "Atlantis").when(key % 7 == 0, " OverALL ")
        .otherwise(F.concat(F.lit(" "), F.lower("n_name"))).alias("country"),
        F.when(key % 83 == 0, "2050-01-01").when(key % 79 == 0, "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
    )


def trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = top(spark, sf_dir).select(F.col("country").alias("series"))
    return names.union(spark.range(1).select(F.lit("overall")))


@query("resolve_series", f"""WITH {S.FEATURES}{S.TOP}, {REQUESTS_SQL}
SELECT country, series, CAST(count(*) AS BIGINT) AS n FROM prepared GROUP BY country, series""")
def resolve_series(spark, sf_dir):
    out = scoring.resolve_series(requests(spark, sf_dir), trained(spark, sf_dir))
    return out.groupBy("country", "series").agg(F.count(F.lit(1)).alias("n"))


@query("batch_predict", f"""WITH {S.FEATURES}{S.TOP}, {REQUESTS_SQL}
SELECT country, date, series, status, CASE WHEN status = 'ok' THEN round(revenue_sum_28d, 2) END AS predicted_revenue_next_30d,
       CAST(count(*) AS BIGINT) AS n FROM answered GROUP BY ALL""")
def batch_predict(spark, sf_dir):
    rows = materialise(features(spark, sf_dir), "features")
    out = scoring.batch_predict(
        requests(spark, sf_dir), rows, trained(spark, sf_dir), lambda f: f.withColumn("predicted", FC.naive()),
    )
    return out.groupBy("country", "date", "series", "status", "predicted_revenue_next_30d").agg(F.count(F.lit(1)).alias("n"))


DRIFT_DAYS = S.SUPERVISED + f""",
long AS (UNPIVOT (SELECT series, date, {TYPED} FROM features) ON {', '.join(NAMES)} INTO NAME feature VALUE v),
whole AS (SELECT * FROM long QUALIFY count(*) OVER (PARTITION BY series, date) = {len(NAMES)}),
spans AS (
  SELECT series, date, feature, avg(v) OVER recent AS recent, avg(v) OVER past AS mean, stddev_pop(v) OVER past AS std, count(*) OVER past AS n,
         min(v) OVER past = max(v) OVER past AS steady, min(v) OVER both_ = max(v) OVER both_ AS same
  FROM whole WINDOW
    recent AS (PARTITION BY series, feature ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
    past AS (PARTITION BY series, feature ORDER BY date ROWS BETWEEN 149 PRECEDING AND 30 PRECEDING),
    both_ AS (PARTITION BY series, feature ORDER BY date ROWS BETWEEN 149 PRECEDING AND CURRENT ROW)
),
z AS (
  SELECT series, date, feature, n, round(CASE WHEN same THEN 0 ELSE (recent - mean) / CASE WHEN steady OR std = 0 THEN 1e-9 ELSE std END END, 9) AS z
  FROM spans WHERE n >= 30
)"""


@query("drift_every_day", f"""WITH {DRIFT_DAYS}
SELECT series, {day("date")}, CAST(max(n) AS BIGINT) AS n_train_rows, CAST(count(*) FILTER (abs(z) > 3) AS BIGINT) AS n_flagged,
       round(least(max(abs(z)), 1000), 3) AS max_abs_z, bool_or(abs(z) > 3) AS drift_detected
FROM z GROUP BY series, date""")
def drift_every_day(spark, sf_dir):
    """The verdict of every day of every series: its last 30 rows against the 120 before them."""
    found = DR.daily_zscores(features(spark, sf_dir), window=30, history=120)
    large = F.abs(F.col("z"))
    days = found.groupBy("series", "date").agg(
        F.max("n_train_rows").alias("n_train_rows"), F.count_if(large > 3).alias("n_flagged"),
        F.least(F.max(large), F.lit(1000.0)).alias("max_abs_z"), F.bool_or(large > 3).alias("drift_detected"),
    )
    return shown(days, max_abs_z=3)


@query("batch_drift", f"""WITH {SUMMARY}{S.TOP}, {REQUESTS_SQL},
wanted AS (SELECT DISTINCT series, as_of FROM answered WHERE status = 'ok'),
long_rows AS (
  UNPIVOT (SELECT f.series, f.date, {TYPED} FROM features f SEMI JOIN wanted w ON f.series = w.series AND f.date = w.as_of)
  ON {', '.join(NAMES)} INTO NAME feature VALUE v
),
verdict AS (
  SELECT l.series, l.date, count(*) FILTER (abs((v - mean) / std) > 3) AS n_flagged, bool_or(abs((v - mean) / std) > 3) AS drift_detected,
         max(abs((v - mean) / std)) AS max_abs_z
  FROM long_rows l JOIN summary s ON l.series = s.series AND l.feature = s.feature GROUP BY l.series, l.date
)
SELECT a.status, a.series, a.date, CAST(n_flagged AS BIGINT) AS n_flagged, drift_detected, round(max_abs_z, 2) AS max_abs_z,
       CAST(count(*) AS BIGINT) AS n
FROM answered a LEFT JOIN verdict v ON a.series = v.series AND a.as_of = v.date GROUP BY ALL""")
def batch_drift(spark, sf_dir):
    rows = materialise(features(spark, sf_dir), "features")
    seen = DR.feature_summary(rows.dropna().where(F.col("date") <= F.lit(CUTOFF).cast("date")))
    out = scoring.batch_drift(requests(spark, sf_dir), rows, trained(spark, sf_dir), materialise(seen, "summary"))
    return shown(out.groupBy("status", "series", "date", "n_flagged", "drift_detected", "max_abs_z").agg(F.count(F.lit(1)).alias("n")))


# --- walk forward ---------------------------------------------------------------------------------

START, END, EVERY = date(2001, 1, 1), date(2001, 3, 31), 7
BACKTEST = S.FEATURES + f""",
days AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS date),
asked AS (
  SELECT date, CASE WHEN date_diff('day', DATE '{START}', date) < {EVERY} THEN DATE '{START}' - 1
                    ELSE DATE '{START}' + CAST(date_diff('day', DATE '{START}', date) // {EVERY} * {EVERY} AS INTEGER) END AS origin
  FROM days
),
origins AS (SELECT DISTINCT origin FROM asked),
observed AS (
  SELECT origin, series, sum(revenue) AS revenue, max(date) AS last_observed
  FROM activity JOIN origins ON date <= origin GROUP BY origin, series
),
listed AS (
  SELECT * FROM observed WHERE series = 'overall'
  UNION ALL
  SELECT * FROM observed WHERE series <> 'overall' AND lower(series) NOT IN ('nation_23', 'nation_24')
  QUALIFY row_number() OVER (PARTITION BY origin ORDER BY revenue DESC, series) <= 10
),
fitted AS (
  SELECT l.origin, l.series FROM listed l JOIN features f ON f.series = l.series
  WHERE f.revenue_sum_70d IS NOT NULL AND f.target IS NOT NULL AND f.date + 30 <= l.last_observed
  GROUP BY l.origin, l.series HAVING count(*) >= 20
)"""


@query("rolling_origin_backtest", f"""WITH {BACKTEST}
SELECT f.series, {day('f.date')}, {day('a.origin', 'origin')}, round(revenue_sum_28d, 2) AS predicted, round(target, 2) AS actual,
       round(round(revenue_sum_28d, 2) - target, 2) AS error
FROM asked a JOIN fitted t ON a.origin = t.origin JOIN features f ON f.series = t.series AND f.date = a.date
WHERE f.revenue_sum_70d IS NOT NULL""")
def backtest(spark, sf_dir):
    known = materialise(activity(spark, sf_dir), "activity")
    return rounded(rolling_origin_backtest(known, START, END, EVERY, "naive", labels=LABELS), 2)


@query("rolling_origin_backtest_ridge")
def backtest_ridge(spark, sf_dir):
    known = materialise(activity(spark, sf_dir), "activity")
    return rounded(rolling_origin_backtest(known, START, END, EVERY, "ridge", labels=LABELS), 2)


# --- learned models: rows and actuals in SQL, predictions finite; the full results have no SQL form ---

def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(supervised(spark, sf_dir), "supervised")


def _learned(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    return comparison.holdout_predictions(_rows(spark, sf_dir), LEARNED_SETTINGS, (family,))


SUMMED = R.multiples(NAMES)[0]
PAIRS = [(a, b) for i, a in enumerate(SUMMED) for b in SUMMED[i + 1:]]


@query("ridge_gram", f"""WITH {S.SUPERVISED},
sums AS (SELECT series, count(*) AS n, avg(target) AS y_mean,
  [{", ".join(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in PAIRS)}] AS r,
  [{", ".join(f"corr(CAST({a} AS DOUBLE), target)" for a in SUMMED)}] AS ry,
  [{", ".join(f"var_pop(CAST({a} AS DOUBLE)) > 0" for a in SUMMED)}] AS moves FROM supervised GROUP BY series)
SELECT series, CAST(n AS BIGINT) AS n, round(y_mean, 2) AS y_mean,
  array_to_string(list_transform(r, lambda x: CASE WHEN isfinite(x) THEN CAST(CAST(round(x * 10000) AS BIGINT) AS VARCHAR) ELSE '-' END), ',') AS between_features,
  array_to_string(list_transform(ry, lambda x: CASE WHEN isfinite(x) THEN CAST(CAST(round(x * 10000) AS BIGINT) AS VARCHAR) ELSE '-' END), ',') AS with_target
FROM sums""")
def ridge_gram(spark, sf_dir):
    """The sums of the normal equations of every series, as correlations in ten-thousandths; '-' where a feature is constant."""
    rows = _rows(spark, sf_dir)
    sums = R.moments(rows).join(rows.groupBy("series").agg(F.stddev_pop(SV.TARGET).alias("y_dev")), "series")
    spread = F.transform("products", lambda row, i: F.when(~F.get("constant", i), F.sqrt(F.get(row, i))))
    sums = materialise(sums.withColumn("spread", spread), "gram")
    share = lambda product, scale: F.coalesce(F.round(product / scale * 10000).cast("bigint").cast("string"), F.lit("-"))
    between = F.flatten(F.transform("products", lambda row, i: F.transform(
        F.slice(row, i + 2, F.lit(len(SUMMED))), lambda p, j: share(p, F.get("spread", i) * F.get("spread", i + j + 1)))))
    along = F.transform("with_target", lambda p, i: share(p, F.get("spread", i) * F.col("y_dev") * F.sqrt("n")))
    return shown(sums.select(
        "series", "n", "y_mean", F.array_join(between, ",").alias("between_features"), F.array_join(along, ",").alias("with_target"),
    ), y_mean=2)


@query("ridge_residual", f"""WITH {S.SPLIT}
SELECT series, feature, 10.0::DOUBLE AS alpha, 0.0::DOUBLE AS residual
FROM (SELECT DISTINCT series FROM split WHERE role = 'train'), (SELECT unnest(['intercept', {", ".join(f"'{n}'" for n in NAMES)}]) AS feature)""")
def ridge_residual(spark, sf_dir):
    """What the fitted ridges leave of their normal equations on the training rows: nothing, in every feature."""
    train = materialise(holdout(spark, sf_dir).where(F.col("role") == "train"), "train")
    left = R.gradients(train, materialise(R.fit_ridge(train, [LEARNED_SETTINGS["ridge"]["alpha"]]), "ridges"))
    return left.select("series", "feature", "alpha", F.abs(F.round("residual", 7)).alias("residual"))


@query("ridge_forecast")
def ridge_forecast(spark, sf_dir):
    return _learned(spark, sf_dir, "ridge")


@query("random_forest_forecast")
def random_forest_forecast(spark, sf_dir):
    return _learned(spark, sf_dir, "random_forest")


@query("gbt_forecast")
def gbt_forecast(spark, sf_dir):
    return _learned(spark, sf_dir, "gbt")


@query("gbt_leafwise_forecast")
def gbt_leafwise_forecast(spark, sf_dir):
    return _learned(spark, sf_dir, "gbt_leafwise")


@query("learned_forecast_rows", f"""WITH {S.BASELINES}
SELECT f.family, p.series, {day('p.date')}, round(p.actual, 2) AS actual, true AS is_finite
FROM predictions p, (SELECT unnest(['ridge', 'random_forest', 'gbt', 'gbt_leafwise']) AS family) f WHERE p.model = 'naive'""")
def learned_forecast_rows(spark, sf_dir):
    """Held-out rows of all learned models: which days, their actuals, and whether each prediction is a number."""
    found = comparison.holdout_predictions(_rows(spark, sf_dir), LEARNED_SETTINGS, FC.LEARNED)
    is_finite = F.col("predicted").isNotNull() & ~F.isnan("predicted") & (F.abs("predicted") < float("inf"))
    return rounded(found.select(F.col("model").alias("family"), "series", "date", "actual", is_finite.alias("is_finite")), 2)


@query("evaluate_learned_models")
def evaluate_learned_models(spark, sf_dir):
    """All six models on every series' held-out tail."""
    return EV.regression_metrics(comparison.holdout_predictions(_rows(spark, sf_dir), LEARNED_SETTINGS))


@query("holdout_predictions")
def holdout_predictions(spark, sf_dir):
    """Held-out rows of the overall series under its best learned model of all four families."""
    predictions = materialise(comparison.holdout_predictions(overall_supervised(spark, sf_dir), LEARNED_SETTINGS, FC.LEARNED), "predictions")
    return comparison.overall_holdout(predictions, EV.regression_metrics(predictions))


@query("tune_hyperparameters")
def tune_hyperparameters(spark, sf_dir):
    """All twelve candidates at full settings."""
    return comparison.tune(overall_supervised(spark, sf_dir))


@query("compare_and_store")
def compare_and_store(spark, sf_dir):
    """The whole comparison: tuned, evaluated on every series, chosen among the learned families, stored; its record read back."""
    path = scratch_path(spark, "compared")
    comparison.compare_and_store(_rows(spark, sf_dir), path)
    return spark.read.json(f"{current_folder(spark, path)}/comparison").select("series", "model", "mae", "rmse", "mape", "normalised_mae", "winner")


def trained_models(spark: SparkSession, sf_dir: str):
    path = scratch_path(spark, "models")
    done = training.retrain(clean(spark, sf_dir), path, family="gbt", hyperparameters=LEARNED_SETTINGS["gbt"], labels=LABELS)
    return path, done


@query("retrain_all_series", f"""WITH {S.SUPERVISED}{S.TOP}
SELECT series, replace(lower(series), ' ', '_') AS slug, CAST(count(*) AS BIGINT) AS n_training_rows,
       {day('min(date)', 'first_date')}, {day('max(date)', 'last_date')},
       CASE WHEN count(*) < 20 THEN 'only ' || count(*) || ' usable training rows' END AS skip_reason
FROM supervised WHERE series = 'overall' OR series IN (SELECT country FROM top) GROUP BY series""")
def retrain_all_series(spark, sf_dir):
    return shown(trained_models(spark, sf_dir)[1].registry.select("series", "slug", "n_training_rows", "first_date", "last_date", "skip_reason"))


@query("write_models")
def write_models(spark, sf_dir):
    """Ridge models stored for every trained series, loaded again and applied to the latest day."""
    path = scratch_path(spark, "models")
    training.retrain(clean(spark, sf_dir), path, family="ridge", hyperparameters={"alpha": 10.0}, labels=LABELS)
    latest = materialise(SV.latest_features(SV.build_features(series(spark, sf_dir), with_target=False)), "latest")
    return FC.predict_models(latest, training.load_models(spark, path)).select("series", "date", "predicted", *SHORT_LIST)


@query("batch_predict_stored")
def batch_predict_stored(spark, sf_dir):
    """Requests answered by the stored boosted models, with the drift verdict of each answered day."""
    path, done = trained_models(spark, sf_dir)
    rows = materialise(features(spark, sf_dir), "features")
    known = done.registry.where(F.col("skip_reason").isNull()).select("series")
    out = scoring.batch_predict(
        requests(spark, sf_dir), rows, known, training.stored_scorer(spark, path), summary=done.features,
    )
    return out.groupBy("country", "date", "series", "status", "predicted_revenue_next_30d", "drift_detected").agg(F.count(F.lit(1)).alias("n"))


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return FC.permutation_importance(rows, FC.fit_models(rows, FC.candidates({"gbt": [LEARNED_SETTINGS["gbt"]]})))
