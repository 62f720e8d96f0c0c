"""Feature drift: recent feature means against the mean and spread seen in training."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.constants import DRIFT_THRESHOLD
from tillcast.operators.supervised import feature_names

# Fixed value: stands in for a standard deviation of zero.
ZERO_STD = 1e-9


def _per_feature(table: DataFrame, keys: list[str], names: list[str], measures: dict) -> DataFrame:
    """Aggregate all features in one wide pass, then turn the few result rows long."""
    wide = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.struct(*[fn(F.col(n).cast("double")).alias(k) for k, fn in measures.items()]).alias(n) for n in names],
    )
    long = wide.unpivot([*keys, "n_rows"], names, "feature", "_m")
    return long.select(*keys, "feature", "n_rows", "_m.*")


def feature_summary(train: DataFrame, names: list[str] | None = None, keys=("series",)) -> DataFrame:
    """(series, feature, n_rows, mean, std) with the population deviation."""
    def spread(c):
        return F.when(F.stddev_pop(c) == 0, F.lit(ZERO_STD)).otherwise(F.stddev_pop(c))

    return _per_feature(train, list(keys), names or feature_names(), {"mean": F.avg, "std": spread})


def feature_zscores(summary: DataFrame, recent: DataFrame, keys=("series",), names: list[str] | None = None) -> DataFrame:
    """Distance of recent means from training means, in training deviations.

    ``keys`` are the groups of recent rows and start with ``series``. Features that the recent rows
    lack, or whose mean is NULL, count as unchanged.
    """
    keys = list(keys)
    names = [n for n in (names or feature_names()) if n in recent.columns]
    groups = recent.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_recent_rows"))
    means = _per_feature(recent, keys, names, {"recent_mean": F.avg}).drop("n_rows")
    expected = groups.join(summary.withColumnRenamed("n_rows", "n_train_rows"), "series")
    z = (F.col("recent_mean") - F.col("mean")) / F.col("std")
    return expected.join(means, [*keys, "feature"], "left").withColumn("z", F.coalesce(z, F.lit(0.0)))


def drift_flags(zscores: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    return zscores.where(F.abs("z") > threshold)


def drift_verdict(zscores: DataFrame, keys=("series",), threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """One row per group. The list of flagged features is as long as the feature list at most."""
    flagged = F.abs(F.col("z")) > threshold
    entry = F.when(flagged, F.struct(
        (-F.abs("z")).alias("order"), F.col("feature"), F.round("z", 2).alias("z"),
    ))
    ordered = F.array_sort(F.collect_list(entry))
    return zscores.groupBy(*keys).agg(
        F.lit(threshold).alias("z_threshold"),
        F.max("n_recent_rows").alias("n_recent_rows"),
        F.count(F.lit(1)).alias("n_features_checked"),
        F.count_if(flagged).alias("n_flagged"),
        F.transform(ordered, lambda e: F.struct(e["feature"].alias("feature"), e["z"].alias("z"))).alias("flagged_features"),
        F.round(F.max(F.abs("z")), 2).alias("max_abs_z"),
        F.bool_or(flagged).alias("drift_detected"),
    )


def daily_zscores(
    rows: DataFrame, window: int = 30, history: int | None = None, least: int = 30, names: list[str] | None = None, keys=("series",),
) -> DataFrame:
    """(series, date, feature, n_recent_rows, n_train_rows, z) for every day: its last ``window`` rows against those before them.

    ``history`` limits the earlier rows to the nearest so many; a day with fewer than ``least`` of them has no row. Rows that
    lack the date or a named feature are left out. One running sum, square sum and number of changes per feature answer every
    span as a difference of two rows, so the window's length costs nothing. Values are taken from the feature's mean, which
    keeps the differences exact enough; constant spans are told by their changes, not by a small deviation.
    ``z`` has nine places, so that a tie with a threshold does not hang on the order of additions. Dates must be distinct in each group.
    """
    keys, names = list(keys), names or feature_names()
    given = rows.select(*keys, "date", *[F.col(n).cast("double").alias(n) for n in names]).dropna(subset=["date", *names])
    long = given.unpivot([*keys, "date"], names, "feature", "v")
    group = Window.partitionBy(*keys, "feature")
    days = group.orderBy("date")
    upto = days.rowsBetween(Window.unboundedPreceding, 0)
    centred = long.withColumns({
        "n": F.row_number().over(days), "shift": F.avg("v").over(group),
        "change": F.coalesce((F.col("v") != F.lag("v").over(days)).cast("int"), F.lit(0)),
    }).withColumn("d", F.col("v") - F.col("shift"))
    sums = centred.withColumns({"s": F.sum("d").over(upto), "q": F.sum(F.col("d") * F.col("d")).over(upto), "c": F.sum("change").over(upto)})

    def back(column: str, by: int | None):
        return F.lit(0) if by is None else F.coalesce(F.lag(column, by).over(days), F.lit(0))

    # A span's own changes start after its first row.
    whole = None if history is None else window + history
    spans = sums.withColumns({
        "n_train_rows": F.greatest(F.lit(0), F.col("n") - window) if history is None else F.least(F.lit(history), F.greatest(F.lit(0), F.col("n") - window)),
        "total": back("s", window) - back("s", whole), "squares": back("q", window) - back("q", whole),
        "train_changes": back("c", window) - back("c", None if whole is None else whole - 1),
        "changes": F.col("c") - back("c", None if whole is None else whole - 1),
        "recent": F.col("s") - back("s", window),
    }).where(F.col("n_train_rows") >= max(1, least))
    mean = F.col("total") / F.col("n_train_rows")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / F.col("n_train_rows") - mean * mean))
    std = F.when((F.col("train_changes") == 0) | (std == 0), F.lit(ZERO_STD)).otherwise(std)
    z = F.when(F.col("changes") == 0, F.lit(0.0)).otherwise((F.col("recent") / window - mean) / std)
    return spans.select(*keys, "date", "feature", F.lit(window).alias("n_recent_rows"), "n_train_rows", F.round(z, 9).alias("z"))
