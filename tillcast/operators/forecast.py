"""Forecasters: two baselines, and all learned families fitted for many series in one grouped job."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.constants import MODEL_SEED
from tillcast.operators.ridge import doubles, fit_ridge, ridge_prediction
from tillcast.operators.supervised import TARGET, feature_names
from tillcast.operators.trees import Trees, fit_boosted, fit_forest

BASELINES = ("naive", "seasonal_naive")
LEARNED = ("ridge", "random_forest", "gbt", "gbt_leafwise")
ALL_MODELS = BASELINES + LEARNED
FAMILY_SYNONYMS = {"hist_gbm": "gbt", "lightgbm": "gbt_leafwise"}

# Search grids, and the family used before any comparison was made.
GRIDS = {
    "random_forest": [
        {"n_estimators": 200, "max_depth": 4},
        {"n_estimators": 400, "max_depth": 6},
        {"n_estimators": 400, "max_depth": None, "min_samples_leaf": 3},
    ],
    "gbt": [
        {"max_depth": 3, "learning_rate": 0.05, "max_iter": 200},
        {"max_depth": 3, "learning_rate": 0.1, "max_iter": 100},
        {"max_depth": 5, "learning_rate": 0.05, "max_iter": 150},
    ],
    "gbt_leafwise": [
        {"n_estimators": 150, "max_depth": 3, "learning_rate": 0.05, "num_leaves": 15},
        {"n_estimators": 300, "max_depth": 4, "learning_rate": 0.03, "num_leaves": 31},
        {"n_estimators": 150, "max_depth": -1, "learning_rate": 0.1, "num_leaves": 15},
    ],
    "ridge": [{"alpha": 0.1}, {"alpha": 1.0}, {"alpha": 10.0}],
}
DEFAULT_FAMILY = "gbt"
DEFAULT_PARAMETERS = {"max_depth": 3, "learning_rate": 0.1, "max_iter": 100}

# Smallest leaf of the boosted learners.
BOOSTED_LEAF = 20
# Leaves of a boosted tree when the parameters name none.
OPEN_LEAVES = 31


# --- baselines --------------------------------------------------------------------------------

def naive() -> Column:
    return F.col("revenue_sum_28d")


def seasonal_naive() -> Column:
    return F.when(F.col("has_prior_year_data") == 1, F.col("revenue_sum_30d_prior_year")).otherwise(naive())


def baseline_predictions(features: DataFrame, models=BASELINES) -> DataFrame:
    """(series, date, model, actual, predicted) for the baselines; actual is NULL when unknown."""
    rules = {"naive": naive(), "seasonal_naive": seasonal_naive()}
    scored = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), rules[m].alias("predicted")) for m in models]))
    return features.select(
        "series", "date", F.col(TARGET).alias("actual"), scored.alias("_s")
    ).select("series", "date", "_s.model", "actual", "_s.predicted")


# --- ridge in memory: the prefixes of one series ---------------------------------------------------

def _ridge_weights(x: np.ndarray, y: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """Ridge on standardised features, given back on the original scale."""
    centre, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1.0
    z = (x - centre) / spread
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean())) / spread
    return float(y.mean() - centre @ w), w


# --- families ---------------------------------------------------------------------------------------

def family_name(name: str) -> str:
    return FAMILY_SYNONYMS.get(name, name)


# --- all families, any number of fits: one grouped job ---------------------------------------------

JOB_SCHEMA = "family string, candidate int, parameters string"
MODEL_SCHEMA = (
    "n_train bigint, intercept double, weights array<double>, feature array<int>, threshold array<double>, "
    "child array<int>, node_value array<double>, root array<int>"
)


def candidates(grids: dict[str, list[dict]]) -> list[tuple[str, int, str]]:
    """(family, candidate, parameters) of every entry of a grid."""
    return [(family_name(name), i, json.dumps(hp)) for name, entries in grids.items() for i, hp in enumerate(entries)]


def fit_arrays(x: np.ndarray, y: np.ndarray, name: str, hp: dict) -> Trees | tuple[float, np.ndarray]:
    """A fitted model of one series: trees, or (intercept, weights) of a ridge."""
    name = family_name(name)
    if name == "ridge":
        return _ridge_weights(x, y, float(hp.get("alpha", 1.0)))
    n_trees, depth = hp.get("n_estimators", hp.get("max_iter", 100)), hp.get("max_depth")
    depth = None if depth is None or depth < 0 else depth
    if name == "random_forest":
        return fit_forest(x, y, n_trees, depth, hp.get("min_samples_leaf", 1), MODEL_SEED)
    if name in ("gbt", "gbt_leafwise"):
        return fit_boosted(x, y, n_trees, hp.get("learning_rate", 0.1), depth, hp.get("num_leaves", OPEN_LEAVES), BOOSTED_LEAF)
    raise ValueError(f"no such model family: {name}")


def _applied(model, x: np.ndarray) -> np.ndarray:
    return model.predict(x) if isinstance(model, Trees) else model[0] + x @ model[1]


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(float)


def _spread(frame: DataFrame, keys) -> DataFrame:
    """Rows dealt by ``keys`` over a fixed number of tasks: fits cost time, not bytes, so they must not be merged by size."""
    spark = frame.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return frame.repartition(tasks, *keys)


def _packed(rows: DataFrame, keys, names, extra=()) -> DataFrame:
    values = doubles(names or feature_names()).alias("_x")
    return rows.select(*keys, "date", *extra, F.col(TARGET).cast("double").alias("_y") if TARGET in rows.columns
                       else F.lit(None).cast("double").alias("_y"), values)


def _with_jobs(rows: DataFrame, jobs) -> DataFrame:
    """Every row once per job of a literal, short list."""
    listed = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(c).alias("candidate"), F.lit(p).alias("parameters")) for f, c, p in jobs])
    return rows.withColumn("_job", F.explode(listed)).select("*", "_job.*").drop("_job")


def _kinds(frame: DataFrame, keys) -> str:
    return ", ".join(f"{k} {frame.schema[k].dataType.simpleString()}" for k in keys)


def _divided(jobs) -> tuple[list, list]:
    """Jobs of the ridge family, and the others."""
    ridge = [j for j in jobs if family_name(j[0]) == "ridge"]
    return ridge, [j for j in jobs if j not in ridge]


def _ridge_jobs(train: DataFrame, jobs, keys, names) -> DataFrame:
    """Weights of every group and ridge job, by normal equations: groups of any length, summed once for all jobs."""
    alphas = {p: float(json.loads(p).get("alpha", 1.0)) for _, _, p in jobs}
    fitted = fit_ridge(train, sorted(set(alphas.values())), keys, names)
    listed = F.array(*[
        F.struct(F.lit("ridge").alias("family"), F.lit(c).alias("candidate"), F.lit(p).alias("parameters"), F.lit(alphas[p]).alias("_alpha"))
        for _, c, p in jobs
    ])
    rows = fitted.withColumn("_job", F.explode(listed)).where(F.col("_job._alpha") == F.col("alpha"))
    return rows.select(*keys, "_job.family", "_job.candidate", "_job.parameters", "n_train", "intercept", "weights")


def fit_models(train: DataFrame, jobs, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """One model row per group and job. Ridges come from sums; any other group is one series (or a fold of it): one row per calendar day."""
    keys = list(keys)
    ridge, others = _divided(jobs)
    by = [*keys, "family", "candidate", "parameters"]
    parts = []
    if ridge:
        rest = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split(" ") for c in MODEL_SCHEMA.split(", ")[3:])]
        parts.append(_ridge_jobs(train, ridge, keys, names).select("*", *rest))

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("date")
        model = fit_arrays(_matrix(group["_x"]), group["_y"].to_numpy(float), key[-3], json.loads(key[-1]))
        return pd.DataFrame({i: [v] for i, v in enumerate([*key, len(group), *_stored(model)])})

    if others:
        rows = _spread(_with_jobs(_packed(train, keys, names), others), by)
        parts.append(rows.groupBy(*by).applyInPandas(fit, f"{_kinds(train, keys)}, {JOB_SCHEMA}, {MODEL_SCHEMA}"))
    return union_all(parts)


def _restored(row) -> Trees | tuple[float, np.ndarray]:
    if row.weights is not None:
        return row.intercept, np.asarray(row.weights)
    return Trees(row.intercept, *[np.asarray(v) for v in (row.feature, row.threshold, row.child, row.node_value, row.root)])


def fit_at_origins(
    train: DataFrame, origins: DataFrame, name: str, hp: dict, horizon: int, names: list[str] | None = None, per_task: int = 8,
) -> DataFrame:
    """One model row per row of ``origins`` (series, origin, last_observed), as ``fit_models`` gives it.

    A row of day t trains the origins whose last observed day is t + ``horizon`` or later, so the training
    rows of a series are prefixes of each other. A ridge needs only their sums: rows move once and each is
    added once. Other families are fitted on each prefix, ``per_task`` origins in a task, and rows move
    once per task. A group is one series: one row per calendar day.
    """
    names = names or feature_names()
    name = family_name(name)
    place = F.row_number().over(Window.partitionBy("series").orderBy("origin")) - 1
    part = F.lit(0) if name == "ridge" else F.floor(place / per_task).cast("int")
    dealt = origins.select("series", "origin", "last_observed", part.alias("_part"))
    dealt, by, met_by = _spread(dealt, ["series", "_part"]), ["series", "_part"], ["series", "_met"]
    parts = dealt.select("series", F.col("_part").alias("_met")).distinct()
    rows = _spread(_packed(train, ["series"], names).join(parts, "series"), met_by)

    def fit(key: tuple, group: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if group.empty or asked.empty:
            return pd.DataFrame(columns=range(len(shape)))
        group, asked = group.sort_values("date"), asked.sort_values("last_observed")
        x, y = _matrix(group["_x"]), group["_y"].to_numpy(float)
        last = pd.to_datetime(asked["last_observed"]) - pd.Timedelta(days=horizon)
        ends = np.searchsorted(pd.to_datetime(group["date"]).to_numpy(), last.to_numpy(), side="right")
        keep = ends > 0
        fitted = (_ridge_of_prefixes(x, y, ends[keep], float(hp.get("alpha", 1.0))) if name == "ridge"
                  else (fit_arrays(x[:n], y[:n], name, hp) for n in ends[keep]))
        out = [
            (key[0], origin, name, 0, stored, int(n), *_stored(model))
            for origin, n, model in zip(asked["origin"][keep], ends[keep], fitted)
        ]
        return pd.DataFrame(out, columns=range(len(shape)), dtype=object)

    stored = json.dumps(hp)
    schema = f"{_kinds(origins, ['series', 'origin'])}, {JOB_SCHEMA}, {MODEL_SCHEMA}"
    shape = schema.split(", ")
    return rows.groupBy(*met_by).cogroup(dealt.groupBy(*by)).applyInPandas(fit, schema)


def _stored(model) -> list:
    """The model's part of a row of ``MODEL_SCHEMA``, after the number of rows."""
    if isinstance(model, Trees):
        return [model.intercept, None, model.feature, model.threshold, model.child, model.value, model.root]
    return [*model, None, None, None, None, None]


def _ridge_of_prefixes(x: np.ndarray, y: np.ndarray, ends, alpha: float) -> Iterator[tuple[float, np.ndarray]]:
    """The model of ``_ridge_weights`` on the first ``n`` rows for each ``n`` of the ascending ``ends``, by running sums.

    Values are first brought to mean 0 and deviation 1 over all rows, which changes no model and keeps the sums precise.
    """
    shift, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    x, base = (x - shift) / scale, y.mean()
    y = y - base
    low, high = np.minimum.accumulate(x), np.maximum.accumulate(x)
    done, total, square, product = 0, np.zeros(x.shape[1]), np.zeros((x.shape[1],) * 2), np.zeros(x.shape[1])
    for n in ends:
        new = x[done:n]
        total, square, product, done = total + new.sum(axis=0), square + new.T @ new, product + new.T @ y[done:n], n
        mean, level = total / n, y[:n].mean()
        spread = square / n - np.outer(mean, mean)
        constant = low[n - 1] == high[n - 1]
        spread[constant] = spread[:, constant] = 0.0
        size = np.sqrt(np.where(constant, 1.0, np.maximum(np.diag(spread), np.finfo(float).tiny)))
        along = np.where(constant, 0.0, product - total * level) / size
        weights = np.linalg.solve(n * spread / np.outer(size, size) + alpha * np.eye(len(size)), along) / size / scale
        yield float(base + level - (mean * scale + shift) @ weights), weights


def predict_models(features: DataFrame, models: DataFrame, names: list[str] | None = None, keys=("series",)) -> DataFrame:
    """Rows of modelled groups with ``predicted``, once per stored model of the group; needs distinct days per group."""
    kept = [c for c in features.columns if c != "family"]
    own = features.select(*kept, doubles(names or feature_names()).alias("_x"))
    kind = ", ".join(f"`{c}` {features.schema[c].dataType.simpleString()}" for c in kept)

    def apply(rows: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or stored.empty:
            return pd.DataFrame(columns=[*kept, "family", "predicted"])
        x = _matrix(rows["_x"])
        return pd.concat([
            rows[kept].assign(family=m.family, predicted=_applied(_restored(m), x)) for m in stored.itertuples()
        ])

    left, right = _spread(own, keys), _spread(models, keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(apply, f"{kind}, family string, predicted double")


def held_out_predictions(rows: DataFrame, jobs, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """Fits each job on the group's rows of role 'train', and predicts those of role 'test'."""
    keys = list(keys)
    ridge, others = _divided(jobs)
    by = [*keys, "family", "candidate", "parameters"]
    shape = [*by, "date", "actual", "predicted"]
    parts = []
    if ridge:
        models = _ridge_jobs(rows.where(F.col("role") == "train"), ridge, keys, names)
        scored = rows.where(F.col("role") == "test").join(models, keys)
        parts.append(scored.select(*by, "date", F.col(TARGET).cast("double").alias("actual"), ridge_prediction(names).alias("predicted")))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("date")
        train, test = group[group["role"] == "train"], group[group["role"] == "test"]
        if train.empty or test.empty:
            return pd.DataFrame(columns=shape)
        model = fit_arrays(_matrix(train["_x"]), train["_y"].to_numpy(float), key[-3], json.loads(key[-1]))
        return test[[*by, "date"]].assign(actual=test["_y"], predicted=_applied(model, _matrix(test["_x"])))[shape]

    if others:
        dealt = _spread(_with_jobs(_packed(rows, keys, names, ["role"]), others), by)
        parts.append(dealt.groupBy(*by).applyInPandas(run, f"{_kinds(rows, keys)}, {JOB_SCHEMA}, date date, actual double, predicted double"))
    return union_all(parts)


def union_all(frames: Iterator[DataFrame]) -> DataFrame:
    frames = list(frames)
    combined = frames[0]
    for f in frames[1:]:
        combined = combined.unionByName(f)
    return combined


def permutation_importance(
    rows: DataFrame, models: DataFrame, names: list[str] | None = None, repeats: int = 8, seed: int = MODEL_SEED, top: int = 12,
) -> DataFrame:
    """Mean drop in R² when one feature's values trade places between the rows of one series.

    Rows and model meet once per series and feature; a copy of the rows lives only inside its task.
    """
    names = names or feature_names()
    listed = F.sequence(F.lit(0), F.lit(len(names) - 1))
    by = ["series", "feature_no"]
    left = _spread(_packed(rows, ["series"], names).withColumn("feature_no", F.explode(listed)), by)
    right = _spread(models.withColumn("feature_no", F.explode(listed)), by)

    def measure(key: tuple, group: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if group.empty or stored.empty:
            return pd.DataFrame(columns=["series", "family", "feature", "importance"])
        group = group.sort_values("date")
        x, y, number = _matrix(group["_x"]), group["_y"].to_numpy(float), int(key[1])
        whole, out = float(((y - y.mean()) ** 2).sum()), []
        for m in stored.itertuples():
            model = _restored(m)
            loss = lambda v: float(((_applied(model, v) - y) ** 2).sum())  # noqa: B023, E731
            random, drops, base = np.random.default_rng([seed, number]), [], loss(x)
            for _ in range(repeats):
                swapped = x.copy()
                swapped[:, number] = random.permutation(x[:, number])
                drops.append((loss(swapped) - base) / whole if whole else 0.0)
            out.append((key[0], m.family, names[number], float(np.mean(drops))))
        return pd.DataFrame(out, columns=["series", "family", "feature", "importance"])

    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
        measure, "series string, family string, feature string, importance double",
    )
    place = F.row_number().over(Window.partitionBy("series", "family").orderBy(F.desc("importance"), "feature"))
    kept = found.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")
    return kept.orderBy("series", "family", F.desc("importance"), "feature")
