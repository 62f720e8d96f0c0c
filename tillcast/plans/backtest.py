"""Rolling-origin walk forward: forecast every day as it would have been made then."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.constants import HORIZON_DAYS, MIN_TRAINING_ROWS, NON_MARKET_LABELS, TOP_MARKETS
from tillcast.operators.daily import densify, round_revenue
from tillcast.operators.forecast import BASELINES, family_name, fit_at_origins, naive, predict_models, ridge_prediction, seasonal_naive
from tillcast.operators.markets import observed_as_of, trained_as_of
from tillcast.operators.supervised import TARGET, build_features, feature_names
from tillcast.session import materialise


def walk_forward_days(spark, start: date, end: date, retrain_every: int = 7) -> DataFrame:
    """(date, origin): each day and the date its model was trained as of.

    The first model knows the day before the start; later ones are trained on the day itself.
    """
    days = spark.range((end - start).days + 1)
    first = F.date_sub(F.lit(start), 1)
    if not retrain_every:
        origin = first
    else:
        step = F.floor(F.col("id") / retrain_every) * retrain_every
        origin = F.when(F.col("id") < retrain_every, first).otherwise(F.date_add(F.lit(start), step.cast("int")))
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"), origin.alias("origin"))


def rolling_origin_backtest(
    activity: DataFrame, start: date, end: date, retrain_every: int = 7, model: str = "naive", parameters: dict | None = None,
    top_n: int = TOP_MARKETS, labels=NON_MARKET_LABELS, horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """(series, date, origin, predicted, actual, error) for the series trained at each origin.

    Features are built once, since they never look ahead. A training row of day t may be used at an
    origin only when t + horizon days had been observed by then; the top markets are those of the
    origin too. ``model`` is a baseline or a learned family with its ``parameters``. No training row is copied
    per origin: baselines need only its number of rows, a ridge running sums, and other families see prefixes.
    """
    days = walk_forward_days(activity.sparkSession, start, end, retrain_every)
    observed = observed_as_of(activity, days, end)
    listed = trained_as_of(observed, top_n, labels).select("origin", "series", "last_observed")
    series = round_revenue(densify(activity))
    # One row per series and day: written once, then read by the fits, the scoring and the actuals.
    features = materialise(build_features(series, horizon), "features")
    usable = features.dropna(subset=[*feature_names(horizon), TARGET])
    names = feature_names(horizon)
    scorable = features.dropna(subset=names)
    # Usable days of a dense series are a run without gaps, so its ends tell how many an origin may use.
    ends = usable.groupBy("series").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    n_train = F.date_diff(F.least("_last", F.date_sub("last_observed", horizon)), F.col("_first")) + 1
    long_enough = listed.join(ends, "series").where(n_train >= MIN_TRAINING_ROWS).select("origin", "series", "last_observed")
    if model in BASELINES:
        fitted, predicted = long_enough, {"naive": naive(), "seasonal_naive": seasonal_naive()}[model]
    else:
        hp = parameters or ({"alpha": 10.0} if family_name(model) == "ridge" else {})
        fitted = materialise(fit_at_origins(usable, long_enough, model, hp, horizon, names), "origins")
        predicted = ridge_prediction(names)
    if model in BASELINES or family_name(model) == "ridge":
        scored = days.join(fitted, "origin").join(scorable, ["series", "date"])
    else:
        asked = days.join(long_enough.select("origin", "series"), "origin").join(scorable, ["series", "date"])
        scored, predicted = predict_models(asked, fitted, names, ("series", "origin")), F.col("predicted")
    scored = scored.select("series", "date", "origin", F.round(predicted, 2).alias("predicted"))
    actuals = features.select("series", "date", F.col(TARGET).alias("actual"))
    return scored.join(actuals, ["series", "date"], "left").withColumn("error", F.col("predicted") - F.col("actual"))
