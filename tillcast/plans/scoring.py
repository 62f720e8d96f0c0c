"""Answering many (country, date) requests at once: forecasts and drift verdicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.constants import DRIFT_THRESHOLD, HORIZON_DAYS
from tillcast.functions.coercion import lookup_key, trimmed
from tillcast.operators.drift import drift_verdict, feature_zscores
from tillcast.operators.supervised import feature_names

OK, MISSING, UNKNOWN, BAD_DATE, OUT_OF_RANGE, TOO_SHORT = (
    "ok", "missing_field", "unknown_series", "invalid_date", "out_of_range", "insufficient_history",
)


def resolve_series(requests: DataFrame, trained: DataFrame) -> DataFrame:
    """Adds ``series`` (NULL when unknown): names compare trimmed and without case.

    Of trained names that differ by case only the last in order answers, so a request stays one row.
    """
    names = trained.groupBy(lookup_key(F.col("series")).alias("_key")).agg(F.max("series").alias("series"))
    return requests.withColumn("_key", lookup_key(F.col("country"))).join(names, "_key", "left").drop("_key")


def _prepared(requests: DataFrame, trained: DataFrame) -> DataFrame:
    return resolve_series(requests, trained).withColumn("as_of_date", trimmed(F.col("date")).try_cast("date"))


def _distinct_rows(prepared: DataFrame, features: DataFrame) -> DataFrame:
    """Feature rows that some request needs, each once however often it is asked for."""
    wanted = prepared.select("series", F.col("as_of_date").alias("date")).dropna().distinct()
    complete = F.lit(True)
    for name in feature_names():
        complete = complete & F.col(name).isNotNull()
    return features.join(wanted, ["series", "date"], "left_semi").withColumn("_complete", complete)


def _answered(prepared: DataFrame, answers: DataFrame) -> DataFrame:
    """Joins each request to its answer and names what went wrong."""
    answers = answers.withColumnRenamed("date", "as_of_date").withColumn("_found", F.lit(True))
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    status = (
        F.when(empty("country") | empty("date"), MISSING)
        .when(F.col("series").isNull(), UNKNOWN)
        .when(F.col("as_of_date").isNull(), BAD_DATE)
        .when(F.col("_found").isNull(), OUT_OF_RANGE)
        .when(~F.col("_complete"), TOO_SHORT)
        .otherwise(OK)
    )
    return prepared.join(answers, ["series", "as_of_date"], "left").withColumn("status", status).drop("_found", "_complete")


def _drift(rows: DataFrame, summary: DataFrame, threshold: float) -> DataFrame:
    keys = ("series", "date")
    return drift_verdict(feature_zscores(summary, rows, keys), keys, threshold)


def batch_predict(
    requests: DataFrame, features: DataFrame, trained: DataFrame, score: Callable[[DataFrame], DataFrame],
    summary: DataFrame | None = None, threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """Forecast for every request (country, date as text), with a ``status`` instead of an error.

    ``trained`` lists the series; ``score`` adds ``predicted`` to feature rows.
    """
    prepared = _prepared(requests, trained)
    rows = _distinct_rows(prepared, features)
    complete = rows.where("_complete")
    scored = score(complete).select("series", "date", F.round("predicted", 2).alias("predicted_revenue_next_30d"))
    answers = rows.select("series", "date", "_complete").join(scored, ["series", "date"], "left")
    if summary is not None:
        verdict = _drift(complete, summary, threshold).select("series", "date", "drift_detected")
        answers = answers.join(verdict, ["series", "date"], "left")
    else:
        answers = answers.withColumn("drift_detected", F.lit(None).cast("boolean"))
    return _answered(prepared, answers)


def batch_drift(
    requests: DataFrame, features: DataFrame, trained: DataFrame, summary: DataFrame, threshold: float = DRIFT_THRESHOLD,
) -> DataFrame:
    """Drift verdict for every request."""
    prepared = _prepared(requests, trained)
    rows = _distinct_rows(prepared, features)
    verdict = _drift(rows.where("_complete"), summary, threshold)
    return _answered(prepared, rows.select("series", "date", "_complete").join(verdict, ["series", "date"], "left"))


def predict_events(answered: DataFrame, family: str, trained_at: str, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Answered forecasts in the shape of the event log."""
    return answered.where(F.col("status") == OK).select(
        F.current_timestamp().alias("ts"), F.lit("predict").alias("kind"), F.col("series").alias("country"),
        F.col("as_of_date").cast("string").alias("as_of_date"), F.lit(horizon).alias("horizon_days"),
        "predicted_revenue_next_30d", F.lit(family).alias("model_family"), F.lit(trained_at).alias("model_trained_at"),
        "drift_detected",
    )
