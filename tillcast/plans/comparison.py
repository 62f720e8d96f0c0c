"""Offline comparison: tune on the overall series, evaluate all models on held-out tails, choose."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.constants import OVERALL
from tillcast.functions import metrics as M
from tillcast.operators import forecast as FC
from tillcast.operators.evaluation import best_model_per_series, normalised_mae, regression_metrics, select_winner
from tillcast.operators.supervised import chronological_holdout, time_series_folds
from tillcast.plans.training import Training, fit_and_store
from tillcast.session import materialise


def tune(supervised: DataFrame, grids: dict | None = None, gap_days: int = 0) -> DataFrame:
    """Cross-validated score of every candidate: (family, candidate, parameters, cv_mae, is_best).

    Folds are cut from the overall series only, at most one row per day; every (fold, candidate) is
    its own group of one job.
    """
    folds = time_series_folds(supervised.where(F.col("series") == OVERALL), gap_days=gap_days)
    scored = FC.held_out_predictions(folds, FC.candidates(grids or FC.GRIDS), keys=("series", "fold"))
    by = ["family", "candidate", "parameters"]
    per_fold = scored.groupBy(*by, "fold").agg(M.mae(F.col("actual"), F.col("predicted")).alias("mae"))
    result = per_fold.groupBy(*by).agg(F.avg("mae").alias("cv_mae"))
    place = F.row_number().over(Window.partitionBy("family").orderBy("cv_mae", "candidate"))
    return result.withColumn("is_best", place == 1)


def best_parameters(tuned: DataFrame) -> dict[str, dict]:
    """One row per family reaches the driver."""
    return {r["family"]: json.loads(r["parameters"]) for r in tuned.where("is_best").collect()}


def holdout_predictions(
    supervised: DataFrame, parameters: dict[str, dict], models=FC.ALL_MODELS, gap_days: int = 0,
) -> DataFrame:
    """(series, date, model, actual, predicted) on the held-out tail of every series."""
    split = chronological_holdout(supervised, gap_days)
    parts = []
    baselines = [m for m in FC.BASELINES if m in models]
    if baselines:
        parts.append(FC.baseline_predictions(split.where(F.col("role") == "test"), baselines))
    learned = {m: [parameters[m]] for m in FC.LEARNED if m in models}
    if learned:
        scored = FC.held_out_predictions(split, FC.candidates(learned))
        parts.append(scored.select("series", "date", F.col("family").alias("model"), "actual", "predicted"))
    return FC.union_all(parts)


def overall_holdout(predictions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Held-out rows of the overall series under its best learned model."""
    best = best_model_per_series(metrics.where(F.col("series") == OVERALL), FC.LEARNED).select("series", "model")
    return predictions.join(best, ["series", "model"], "left_semi").select("date", "model", "actual", "predicted").orderBy("date")


@dataclass(frozen=True)
class Comparison:
    """What was tried, measured and chosen, and the models stored for the winner."""

    tuned: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    winner: str
    training: Training


def compare_and_store(supervised: DataFrame, models_dir: str, grids: dict | None = None, gap_days: int = 0, **store) -> Comparison:
    """Tune, evaluate all models on every series, choose among the learned ones, refit the winner on all rows, store.

    Beside the models of that version, ``comparison`` holds the metrics and the choice, and ``overall_holdout`` the
    overall series' held-out rows under its best learned model as CSV.
    """
    tuned = materialise(tune(supervised, grids, gap_days), "tuned")
    parameters = best_parameters(tuned)
    learned = tuple(m for m in FC.LEARNED if m in parameters)
    predictions = materialise(holdout_predictions(supervised, parameters, (*FC.BASELINES, *learned), gap_days), "predictions")
    metrics = materialise(normalised_mae(regression_metrics(predictions), supervised), "metrics")
    winner = select_winner(metrics, learned).first()["winner"]

    def record(folder: str) -> None:
        metrics.withColumn("winner", F.lit(winner)).coalesce(1).write.json(f"{folder}/comparison")
        tuned.coalesce(1).write.json(f"{folder}/tuning")
        overall_holdout(predictions, metrics).coalesce(1).write.option("header", True).csv(f"{folder}/overall_holdout")

    training = fit_and_store(supervised, models_dir, winner, parameters[winner], beside=record, **store)
    return Comparison(tuned, predictions, metrics, winner, training)
