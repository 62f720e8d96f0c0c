"""Refit the selected family for the overall series and the top markets, and keep what was fitted."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.constants import HORIZON_DAYS, MIN_TRAINING_ROWS, NON_MARKET_LABELS, TOP_MARKETS
from tillcast.functions.coercion import slug
from tillcast.operators import forecast as FC
from tillcast.operators.cleaning import union_sources, up_to
from tillcast.operators.daily import daily_activity, densify, keep_series, round_revenue
from tillcast.operators.drift import feature_summary
from tillcast.operators.markets import as_transactions, top_countries
from tillcast.operators.supervised import build_supervised, feature_names, series_summary
from tillcast.plans.ingest import ingest_directory
from tillcast.plans.model_store import current_folder, publish
from tillcast.session import materialise
from tillcast.sources.invoices import IngestionError


@dataclass(frozen=True)
class Training:
    """``registry``: one row per trained or skipped series; ``features``: summary for drift checks."""

    registry: DataFrame
    features: DataFrame
    n_transactions: int


def load_registry(spark: SparkSession, models_dir: str) -> DataFrame | None:
    folder = current_folder(spark, models_dir)
    return None if folder is None else spark.read.parquet(f"{folder}/registry")


def selected_approach(spark: SparkSession, models_dir: str) -> tuple[str, dict]:
    """Family and parameters of the last training, else the default."""
    registry = load_registry(spark, models_dir)
    row = registry.select("model_family", "hyperparameters").first() if registry is not None else None
    if row is None:
        return FC.DEFAULT_FAMILY, dict(FC.DEFAULT_PARAMETERS)
    return row["model_family"], {k: json.loads(v) for k, v in row["hyperparameters"].items()}


def fit_and_store(
    supervised: DataFrame, models_dir: str, family: str, hyperparameters: dict, top_n: int = TOP_MARKETS,
    as_of=None, data_dirs=(), n_transactions: int = 0, beside: Callable[[str], None] | None = None,
) -> Training:
    """Fit one model per long enough series; models, registry and feature summary become current together, or none of them.

    ``beside`` writes what else belongs to the version into its folder.
    """
    spark = supervised.sparkSession
    family = FC.family_name(family)
    summary = series_summary(supervised, MIN_TRAINING_ROWS).withColumn("slug", slug(F.col("series")))
    long_enough = supervised.join(summary.where(F.col("skip_reason").isNull()).select("series"), "series", "left_semi")
    models = FC.fit_models(long_enough, FC.candidates({family: [hyperparameters]}))
    stored = {k: json.dumps(v) for k, v in hyperparameters.items()}
    kept = ["series", "slug", "n_training_rows", "first_date", "last_date", "skip_reason"]
    registry = materialise(summary.select(*kept), "registry").withColumns({
        "model_family": F.lit(family),
        "hyperparameters": (F.create_map(*[F.lit(x) for kv in stored.items() for x in kv]) if stored else F.create_map()).cast("map<string,string>"),
        "horizon_days": F.lit(HORIZON_DAYS), "top_n": F.lit(top_n),
        "trained_at": F.lit(datetime.now(timezone.utc)).cast("timestamp"),
        "as_of": F.lit(as_of).cast("date"),
        "data_dirs": F.array(*[F.lit(d) for d in data_dirs]).cast("array<string>"),
        "feature_columns": F.array(*[F.lit(n) for n in feature_names()]),
    })
    trained = registry.where(F.col("skip_reason").isNull()).select("series")
    features = feature_summary(supervised.join(trained, "series", "left_semi"))

    def write(folder: str) -> None:
        models.write.parquet(f"{folder}/models")
        features.write.parquet(f"{folder}/feature_summary")
        registry.coalesce(1).write.parquet(f"{folder}/registry")
        if beside is not None:
            beside(folder)

    folder = publish(spark, models_dir, write)
    return Training(spark.read.parquet(f"{folder}/registry"), spark.read.parquet(f"{folder}/feature_summary"), n_transactions)


def retrain(
    transactions: DataFrame, models_dir: str, top_n: int = TOP_MARKETS, as_of=None, family: str | None = None,
    hyperparameters: dict | None = None, data_dirs=(), labels=NON_MARKET_LABELS,
) -> Training:
    """Refit on transactions up to ``as_of``.

    Transactions are read once, into daily activity; ranking, series and training rows all come from
    that table, which has one row per series and day.
    """
    spark = transactions.sparkSession
    if family is None:
        family, hyperparameters = selected_approach(spark, models_dir)
    known = transactions if as_of is None else up_to(transactions, as_of)
    activity = materialise(daily_activity(known), "activity")
    n_transactions = activity.where(F.col("series") == "overall").agg(F.sum("n_lines")).first()[0]
    if not n_transactions:
        raise IngestionError("nothing to train on: no clean line up to the given day")
    top = top_countries(as_transactions(activity), top_n, labels=labels)
    series = round_revenue(densify(keep_series(activity, top)))
    supervised = materialise(build_supervised(series), "supervised")
    return fit_and_store(
        supervised, models_dir, family, hyperparameters or {}, top_n, as_of, data_dirs, n_transactions,
    )


def retrain_directories(spark: SparkSession, data_dirs, models_dir: str, **options) -> Training:
    """Ingests the export directories, each cleaned on its own, and retrains on all their lines."""
    frames = {folder: ingest_directory(spark, folder).transactions for folder in data_dirs}
    return retrain(union_sources(frames).drop("data_source"), models_dir, data_dirs=data_dirs, **options)


def load_models(spark: SparkSession, models_dir: str) -> DataFrame:
    """One row per trained series, as ``fit_models`` gives it."""
    folder = current_folder(spark, models_dir)
    if folder is None:
        raise IngestionError(f"no trained models in {models_dir}")
    return spark.read.parquet(f"{folder}/models")


def stored_scorer(spark: SparkSession, models_dir: str):
    """A scorer for batch requests: feature rows with ``predicted`` by the stored models."""
    models = load_models(spark, models_dir)
    return lambda features: FC.predict_models(features, models).drop("family")
