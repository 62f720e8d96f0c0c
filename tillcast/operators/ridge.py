"""Ridge by normal equations: sums of products per group in the JVM, solved from one fixed-size row per group.

A group's rows are only ever summed, so it may have any length and meets a task as partial sums. The first pass takes
means and ranges, the second sums products of centred values, which keeps them precise. A column that is a fixed
multiple of another (a mean is a sum divided by its days) gets its products from that one's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.supervised import TARGET, feature_names
from tillcast.session import materialise

SOLUTION = "alpha double, n_train bigint, intercept double, weights array<double>"


def doubles(names: list[str]) -> Column:
    """The named columns as one array of doubles; text, as each call of a column function is a trip to the JVM."""
    return F.expr(f"array({', '.join(f'CAST(`{n}` AS DOUBLE)' for n in names)})")


def multiples(names: list[str]) -> tuple[list[str], list[tuple[int, float]]]:
    """The columns that are summed, and for each name the place of its column there and its factor."""
    summed, made = [], []
    for n in names:
        found = re.fullmatch(r"(.+)_mean_(\d+)d", n)
        source, factor = (f"{found[1]}_sum_{found[2]}d", 1 / int(found[2])) if found else (n, 1.0)
        if source not in names:
            source, factor = n, 1.0
        if source not in summed:
            summed.append(source)
        made.append((summed.index(source), factor))
    return summed, made


def _by_column(grouped: DataFrame, keys, *columns: str) -> DataFrame:
    """One row per group with an array over the columns' places for each of ``columns``."""
    listed = F.array_sort(F.collect_list(F.struct("_at", *columns)))
    rows = grouped.groupBy(*keys, "n", "y_mean").agg(listed.alias("_rows"))
    return rows.select(*keys, "n", "y_mean", *[F.col(f"_rows.{c}").alias(c) for c in columns])


def moments(train: DataFrame, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """One row per group: n, y_mean, and over the summed columns: mean, constant (whether only one value occurs),
    ``products`` (the centred Gram matrix) and ``with_target``.

    Each row is summed once for each column: as many sums as columns in one aggregation, with partial sums of every task.
    Rows are expected without nulls in features and target, and groups without null keys.
    """
    columns, _ = multiples(names or feature_names())
    keys = list(keys)
    packed = train.select(*keys, F.col(TARGET).cast("double").alias("_y"), doubles(columns).alias("_x"))
    each = packed.select(*keys, "_y", F.posexplode("_x").alias("_at", "_v"))
    first = each.groupBy(*keys, "_at").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), (F.min("_v") == F.max("_v")).alias("constant"), F.avg("_y").alias("y_mean"),
    )
    y_means = first.where("_at = 0").select(*keys, "_at", "y_mean")
    # Every column's row gives the same mean up to the order of summing: one of them stands for all.
    first = _by_column(first.drop("y_mean").join(y_means.drop("_at"), keys), keys, "mean", "constant")
    centred = packed.join(first.select(*keys, "n", "y_mean", "mean"), keys).select(
        *keys, "n", "y_mean", F.zip_with("_x", "mean", lambda x, m: x - m).alias("_x"), (F.col("_y") - F.col("y_mean")).alias("_y"),
    )
    along = centred.select(*keys, "n", "y_mean", "_y", "_x", F.posexplode("_x").alias("_at", "_v")).groupBy(*keys, "n", "y_mean", "_at").agg(
        F.expr(f"array({', '.join(f'sum(_v * _x[{j}])' for j in range(len(columns)))})").alias("products"),
        F.sum(F.col("_v") * F.col("_y")).alias("with_target"),
    )
    return first.join(_by_column(along, keys, "products", "with_target").drop("n", "y_mean"), keys)


def solved(n: int, y_mean: float, mean, constant, products, with_target, made, alpha: float) -> tuple[float, np.ndarray]:
    """Intercept and weights on the original scale, of ridge on standardised features; a constant feature has weight 0."""
    gram = np.stack([np.asarray(p, float) for p in products])
    place, factor = np.array([p for p, _ in made]), np.array([f for _, f in made])
    free = ~np.asarray(constant, bool)[place]
    gram = gram[np.ix_(place, place)] * np.outer(factor, factor)
    along, centre = np.asarray(with_target)[place] * factor, np.asarray(mean)[place] * factor
    spread = np.where(free, np.sqrt(np.maximum(np.diag(gram) / n, np.finfo(float).tiny)), 1.0)
    both = np.outer(free, free)
    w = np.linalg.solve(np.where(both, gram / np.outer(spread, spread), 0.0) + alpha * np.eye(len(place)), np.where(free, along / spread, 0.0)) / spread
    return float(y_mean - centre @ w), w


def solve(sums: DataFrame, alphas, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """Weights for each group and alpha from the rows of ``moments``; a row is a fixed size however long its group."""
    keys, alphas = list(keys), [float(a) for a in alphas]
    _, made = multiples(names or feature_names())
    kinds = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                for a in alphas:
                    fitted = solved(r["n"], r["y_mean"], r["mean"], r["constant"], r["products"], r["with_target"], made, a)
                    rows.append((*(r[k] for k in keys), a, r["n"], *fitted))
            yield pd.DataFrame(rows, columns=[*keys, "alpha", "n_train", "intercept", "weights"])

    return sums.mapInPandas(run, f"{kinds}, {SOLUTION}")


def fit_ridge(train: DataFrame, alphas, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """One row of weights per group and alpha."""
    return solve(moments(train, keys, names), alphas, keys, names)


def ridge_prediction(names: list[str] | None = None) -> Column:
    """Prediction from columns ``intercept`` and ``weights`` next to the features; stays in the JVM."""
    products = F.zip_with(doubles(names or feature_names()), F.col("weights"), lambda x, w: x * w)
    return F.col("intercept") + F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def predict_ridge(features: DataFrame, weights: DataFrame, keys=("series",), names=None) -> DataFrame:
    joined = features.join(weights, list(keys))
    return joined.withColumn("predicted", ridge_prediction(names)).drop("intercept", "weights", "n_train")


def gradients(train: DataFrame, weights: DataFrame, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """(keys, alpha, feature, residual) of every fit: what the normal equations leave over, as a share of their larger side.

    0 in every feature and in ``intercept`` only at the one solution. Sums over rows in the JVM; the weights are not used to sum.
    """
    names, keys = names or feature_names(), list(keys)
    error = F.col(TARGET).cast("double") - ridge_prediction(names)
    every = ["intercept", *names]
    values = F.concat(F.array(F.lit(1.0)), doubles(names))
    rows = train.join(weights, keys).select(*keys, "alpha", error.alias("_error"), F.col(TARGET).cast("double").alias("_y"), values.alias("_x"))
    each = materialise(rows, "ridge-errors").select(*keys, "alpha", "_error", "_y", F.posexplode("_x").alias("_at", "_v"))
    tiny, n = F.lit(1e-300), F.count(F.lit(1))
    sums = each.groupBy(*keys, "alpha", "_at").agg(
        F.avg("_error").alias("_left"), F.stddev_pop("_y").alias("_dev"),
        F.covar_pop("_v", "_error").alias("_along"), F.var_pop("_v").alias("_var"), n.alias("_n"),
    )
    sums = sums.join(weights.select(*keys, "alpha", "weights"), [*keys, "alpha"])
    pull = F.col("alpha") * F.try_element_at("weights", F.greatest("_at", F.lit(1))) * F.col("_var")
    residual = (
        F.when(F.col("_at") == 0, F.col("_left") / F.greatest("_dev", tiny)).when(F.col("_var") == 0, F.lit(0.0))
        .otherwise((F.col("_along") * F.col("_n") - pull) / F.greatest(F.col("_n") * F.sqrt("_var") * F.col("_dev"), tiny))
    )
    named = F.element_at(F.split(F.lit(",".join(every)), ","), F.col("_at") + 1)
    return sums.select(*keys, "alpha", named.alias("feature"), residual.alias("residual"))
