"""Quality of forecasts: offline metrics, model choice, logged forecasts against later actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.constants import HORIZON_DAYS, OVERALL
from tillcast.functions import metrics as M
from tillcast.operators.supervised import TARGET, next_days_sum

ACTUAL, PREDICTED = "actual", "predicted"


def regression_metrics(predictions: DataFrame, keys=("series", "model")) -> DataFrame:
    """mae, rmse, mape and mean_actual of (actual, predicted) rows per group."""
    a, p = F.col(ACTUAL), F.col(PREDICTED)
    return predictions.groupBy(*keys).agg(
        M.mae(a, p).alias("mae"), M.rmse(a, p).alias("rmse"), M.mape(a, p).alias("mape"), F.avg(a).alias("mean_actual"),
    )


def normalised_mae(metrics: DataFrame, supervised: DataFrame) -> DataFrame:
    """MAE over the series' mean target of all its rows, per (series, model)."""
    scale = supervised.groupBy("series").agg(F.avg(TARGET).alias("mean_target"))
    return metrics.join(scale, "series").withColumn("normalised_mae", F.col("mae") / F.col("mean_target"))


def rank_models(normalised: DataFrame, models=None) -> DataFrame:
    """Models by mean normalised MAE, best first; equal scores fall back on the name."""
    rows = normalised if models is None else normalised.where(F.col("model").isin(*models))
    return (
        rows.groupBy("model").agg(F.avg("normalised_mae").alias("avg_normalised_mae"), F.count(F.lit(1)).alias("n_series"))
        .orderBy("avg_normalised_mae", "model")
    )


def select_winner(normalised: DataFrame, models=None) -> DataFrame:
    ranked = rank_models(normalised, models)
    return ranked.agg(
        F.min_by("model", F.struct("avg_normalised_mae", "model")).alias("winner"),
        F.min("avg_normalised_mae").alias("avg_normalised_mae"),
    )


def best_model_per_series(metrics: DataFrame, models=None) -> DataFrame:
    rows = metrics if models is None else metrics.where(F.col("model").isin(*models))
    return rows.groupBy("series").agg(
        F.min_by("model", F.struct("mae", "model")).alias("model"), F.min("mae").alias("mae"),
    )


def naive_vs_winner(normalised: DataFrame, winner: str, naive: str = "naive") -> DataFrame:
    """Both normalised MAEs side by side, largest series first."""
    def of(model):
        return F.max(F.when(F.col("model") == model, F.col("normalised_mae")))

    return normalised.groupBy("series", "mean_target").agg(
        of(naive).alias("naive_normalised_mae"), of(winner).alias("winner_normalised_mae"),
    ).orderBy(F.desc("mean_target"), "series")


def actual_next_days(series: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Observed revenue of the ``horizon`` days after each day, NULL while they are not all observed."""
    return series.select("series", "date", next_days_sum(horizon).alias("actual_revenue_next_30d"))


def evaluate_logged(predictions: DataFrame, series: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Logged predictions (country, as_of_date, predicted_revenue_next_30d) with actual and errors.

    An equi join with the per-day actuals takes the place of a range join.
    """
    actuals = actual_next_days(series, horizon).withColumnsRenamed({"series": "country", "date": "as_of_date"})
    a, p = F.col("actual_revenue_next_30d"), F.col("predicted_revenue_next_30d")
    return predictions.join(actuals, ["country", "as_of_date"], "left").withColumns({
        "error": p - a, "abs_pct_error": F.abs(p - a) / F.greatest(a, F.lit(M.LOGGED_MAPE_FLOOR)) * 100.0,
    })


def evaluated_only(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col("actual_revenue_next_30d").isNotNull())


def summary_by_series(evaluated: DataFrame) -> DataFrame:
    """n, MAE, percentage error and mean actual per country, largest first."""
    return evaluated_only(evaluated).groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs("error")).alias("mae"),
        F.avg("abs_pct_error").alias("mape_floor1"), F.avg("actual_revenue_next_30d").alias("mean_actual"),
    ).orderBy(F.desc("mean_actual"), "country")


def global_stats(evaluated: DataFrame) -> DataFrame:
    """Counts, correlation of actual with absolute error, and the errors of the overall series."""
    known = F.col("actual_revenue_next_30d").isNotNull()
    overall = known & (F.col("country") == OVERALL)
    size = F.abs("error")
    return evaluated.agg(
        F.count(F.lit(1)).alias("n_logged"), F.count_if(known).alias("n_evaluated"),
        F.corr("actual_revenue_next_30d", size).alias("corr_abs_error_vs_revenue"),
        F.avg(F.when(overall, size)).alias("overall_mae"),
        F.avg(F.when(overall, F.col("abs_pct_error"))).alias("overall_mape_floor1"),
    )


def top_rows(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    """The ``n`` largest rows of a column."""
    return df.orderBy(F.desc(column), tie).limit(n)
