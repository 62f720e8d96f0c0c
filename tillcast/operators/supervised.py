"""Window features, the forecast target, and time-ordered splits over dense daily series.

All frames share one window (per series, by date), so a feature table costs one sort. Every sum over days is a
difference of two running sums, so a row costs the same however long its frame is. Running sums are exact (whole
numbers, or units and millionths), so what came before a frame leaves no trace in it. A series has one row per
calendar day, which bounds each window partition by the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillcast.constants import (
    CV_FOLDS, DAILY_METRICS, HOLDOUT_SHARE, HORIZON_DAYS, MIN_HOLDOUT_ROWS, TRAILING_WINDOWS,
)
from tillcast.operators.daily import densify

TARGET = "target_revenue_next_30d"


def by_day() -> WindowSpec:
    """The one window all features share."""
    return Window.partitionBy("series").orderBy("date")


def feature_names(horizon: int = HORIZON_DAYS) -> list[str]:
    names = []
    for m in DAILY_METRICS:
        for w in TRAILING_WINDOWS:
            names += [f"{m}_sum_{w}d", f"{m}_mean_{w}d"]
        names += [f"{m}_lag_{horizon}d", f"{m}_trend_28d"]
    return names + [
        "has_prior_year_data", "revenue_sum_30d_prior_year", "dow", "day_of_month", "month", "is_year_end_window",
    ]


#: Metrics that are no whole numbers; their running sums keep six places of values below the limit, as whole numbers.
FRACTIONAL = ("revenue",)
PLACES, LIMIT = 1_000_000, 1e14


# The expressions are SQL text: a feature table has hundreds of them, and each call of a column function is a trip to the JVM.
OVER = "OVER (PARTITION BY series ORDER BY date"
ROW = f"row_number() {OVER})"


def parts_of(metric: str) -> list[str]:
    """What is summed exactly for a metric: itself, or for a fractional one whole units, millionths, and how many values do not fit."""
    if metric not in FRACTIONAL:
        return [metric]
    fit = f"CASE WHEN abs({metric}) < {LIMIT!r}D THEN {metric} END"
    return [
        f"CAST(floor({fit}) AS BIGINT)", f"CAST(round(({fit} - floor({fit})) * {PLACES}) AS BIGINT)",
        f"CAST({metric} IS NOT NULL AND ({fit}) IS NULL AS BIGINT)",
    ]


def running_sums(values: list[str], upto: int) -> list[str]:
    """Sums of all rows up to ``upto`` rows from the current one, as SQL."""
    last = "CURRENT ROW" if upto == 0 else f"{abs(upto)} {'PRECEDING' if upto < 0 else 'FOLLOWING'}"
    return [f"coalesce(sum({v}) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND {last}), 0L)" for v in values]


def between(upto: list[str], before: list[str]) -> str:
    """The sum of the rows between two running sums; for a fractional metric NaN if a value is not finite or from ``LIMIT`` on."""
    total = f"({upto[0]} - {before[0]})"
    if len(upto) == 1:
        return f"CAST({total} AS DOUBLE)"
    # Up to 9e15 the scaled sum is exact as a double, and the quotient is the nearest one.
    rest = f"({upto[1]} - {before[1]})"
    exact = f"CASE WHEN abs({total}) < 9000000000L THEN CAST({total} * {PLACES}L + {rest} AS DOUBLE) / {PLACES}D ELSE {total} + {rest} / {PLACES}D END"
    return f"CASE WHEN {upto[2]} > {before[2]} THEN double('NaN') ELSE {exact} END"


def _span(metric: str, first: int, last: int) -> str:
    return between(running_sums(parts_of(metric), last), running_sums(parts_of(metric), first - 1))


def span_sum(metric: str, first: int, last: int) -> Column:
    """Sum over rows [first, last] around the current one, as far as they exist."""
    return F.expr(_span(metric, first, last))


def _frame_sum(metric: str, first: int, last: int, complete_from: int) -> str:
    """Sum over rows [first, last] around the current one; NULL before row ``complete_from``."""
    return f"CASE WHEN {ROW} >= {complete_from} THEN {_span(metric, first, last)} END"


def trailing_sum(metric: str, days: int) -> Column:
    return F.expr(_frame_sum(metric, 1 - days, 0, days))


def trailing_mean(metric: str, days: int) -> Column:
    return F.expr(f"({_frame_sum(metric, 1 - days, 0, days)}) / {days}D")


def lagged(metric: str, days: int = HORIZON_DAYS) -> Column:
    return F.lag(metric, days).over(by_day())


def trend(metric: str, days: int = 28) -> Column:
    """Mean of the last ``days`` days minus the mean of the ``days`` before them."""
    now, earlier = _frame_sum(metric, 1 - days, 0, days), _frame_sum(metric, 1 - 2 * days, -days, 2 * days)
    return F.expr(f"({now}) / {days}D - ({earlier}) / {days}D")


def prior_year_sum() -> Column:
    """Revenue of the 30 days that end 365 days earlier; NULL without that history."""
    return F.expr(_frame_sum("revenue", -394, -365, 395))


def next_days_sum(horizon: int = HORIZON_DAYS) -> Column:
    """Revenue of the ``horizon`` following days; NULL unless all of them are present."""
    return F.expr(f"CASE WHEN lead(revenue, {horizon}) {OVER}) IS NOT NULL THEN {_span('revenue', 1, horizon)} END")


def calendar_columns(date: str = "date") -> dict[str, Column]:
    year_end = (F.month(date) == 12) & (F.dayofmonth(date) >= 21)
    return {
        "dow": F.weekday(date), "day_of_month": F.dayofmonth(date), "month": F.month(date),
        "is_year_end_window": year_end.cast("int"),
    }


def build_features(series: DataFrame, horizon: int = HORIZON_DAYS, with_target: bool = True, complete: bool = False) -> DataFrame:
    """Feature table keyed by (series, date); features look back only, the target looks ahead.

    Every running sum is evaluated once, in one window step; the features are plain arithmetic on those columns.
    ``complete`` leaves out rows that lack a feature or the target, and those with a NaN among them.
    """
    bounds = {m: {0, -28, -56, *(-w for w in TRAILING_WINDOWS)} for m in DAILY_METRICS}
    bounds["revenue"] |= {-365, -395} | ({horizon} if with_target else set())
    steps = {"_row": ROW}
    if with_target:
        steps["_known"] = f"lead(revenue, {horizon}) {OVER}) IS NOT NULL"
    parts, summed = {}, {m: [f"`_{m}_{i}`" for i in range(len(parts_of(m)))] if m in FRACTIONAL else [m] for m in DAILY_METRICS}
    for m in DAILY_METRICS:
        steps[f"{m}_lag_{horizon}d"] = f"lag({m}, {horizon}) {OVER})"
        for k in sorted(bounds[m]):
            sums = running_sums(summed[m], k)
            parts[m, k] = [f"`_{m}_{k}_{i}`" for i in range(len(sums))]
            steps.update(zip(parts[m, k], sums))
    # What is summed becomes a column first: the optimizer's constraints grow with the square and more of equal inner expressions.
    first = [f"{c} AS {n}" for m in FRACTIONAL for c, n in zip(parts_of(m), summed[m])]
    base = series.selectExpr("series", "date", *DAILY_METRICS, *first).selectExpr("series", "date", *[f"{c} AS {name}" for name, c in steps.items()])

    spans: dict[str, str] = {}

    def span(m: str, first: int, last: int) -> str:
        name = f"`_{m}_{first}_to_{last}`"
        spans[name] = between(parts[m, last], parts[m, first - 1])
        return name

    def over_rows(m: str, first: int, last: int, complete_from: int) -> str:
        return f"CASE WHEN _row >= {complete_from} THEN {span(m, first, last)} END"

    columns: dict[str, str] = {}
    for m in DAILY_METRICS:
        for w in TRAILING_WINDOWS:
            columns[f"{m}_sum_{w}d"] = over_rows(m, 1 - w, 0, w)
            columns[f"{m}_mean_{w}d"] = f"({over_rows(m, 1 - w, 0, w)}) / {w}D"
        columns[f"{m}_lag_{horizon}d"] = f"{m}_lag_{horizon}d"
        columns[f"{m}_trend_28d"] = f"({over_rows(m, -27, 0, 28)}) / 28D - ({over_rows(m, -55, -28, 56)}) / 28D"
    columns["has_prior_year_data"] = "CAST(_row >= 395 AS INT)"
    columns["revenue_sum_30d_prior_year"] = f"coalesce({over_rows('revenue', -394, -365, 395)}, 0D)"
    columns.update(
        dow="weekday(date)", day_of_month="dayofmonth(date)", month="month(date)",
        is_year_end_window="CAST(month(date) = 12 AND dayofmonth(date) >= 21 AS INT)",
    )
    if with_target:
        columns[TARGET] = f"CASE WHEN _known THEN {span('revenue', 1, horizon)} END"
    if complete:
        unfit = [(parts["revenue", b][2], parts["revenue", a][2]) for b, a in ((0, -max(TRAILING_WINDOWS)), (-365, -395), (horizon, 0))]
        base = base.where(" AND ".join([f"_row >= {max(TRAILING_WINDOWS)}", "_known", *(f"{b} <= {a}" for b, a in unfit)]))
    # Small expressions over named differences: the optimizer compares every column's expression with every other.
    known = [n for n in steps if n in ("_row", "_known") or "_lag_" in n]
    return base.selectExpr("series", "date", *known, *[f"{c} AS {name}" for name, c in spans.items()]).selectExpr("series", "date", *[f"{c} AS {name}" for name, c in columns.items()])


def build_supervised(series: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Rows with every feature and the target known; gaps in the calendar are filled first.

    In a dense series all features are there from the day on that the longest frame is. The filter asks row numbers and
    counts, not the features: those would lead the optimizer to weigh each of their expressions against each other.
    """
    return build_features(densify(series), horizon, complete=True)


def features_as_of(features: DataFrame, requests: DataFrame) -> DataFrame:
    """Feature rows for (series, date) requests; features never look ahead, so this is a join."""
    return requests.select("series", "date").distinct().join(features, ["series", "date"])


def requests_out_of_range(series: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests with no calendar day in their series."""
    return requests.join(series.select("series", "date"), ["series", "date"], "left_anti")


def latest_features(features: DataFrame) -> DataFrame:
    """The last row of each series."""
    row = F.struct(*[F.col(c) for c in features.columns])
    return features.groupBy("series").agg(F.max_by(row, "date").alias("_row")).select("_row.*")


def numbered(supervised: DataFrame, *extra: str) -> DataFrame:
    """Adds ``row_no`` (from 1, by date) and ``n_rows`` per series."""
    keys = ["series", *extra]
    by_date = Window.partitionBy(*keys).orderBy("date")
    whole = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return supervised.withColumns({
        "row_no": F.row_number().over(by_date), "n_rows": F.count(F.lit(1)).over(whole),
    })


def holdout_size(n: Column) -> Column:
    wanted = F.greatest(F.lit(MIN_HOLDOUT_ROWS).cast("bigint"), F.floor(n * F.lit(HOLDOUT_SHARE)))
    return F.least(wanted, F.floor(n / 2))


def chronological_holdout(supervised: DataFrame, gap_days: int = 0) -> DataFrame:
    """Adds ``role``: the last rows of each series are 'test', the others 'train'.

    ``gap_days`` drops that many training rows before the test rows, whose targets overlap them.
    """
    size = holdout_size(F.col("n_rows"))
    first_test = F.col("n_rows") - size + 1
    role = F.when(F.col("row_no") >= first_test, "test").when(F.col("row_no") < first_test - gap_days, "train")
    return numbered(supervised).withColumn("role", role).where(F.col("role").isNotNull()).drop("row_no", "n_rows")


def time_series_folds(supervised: DataFrame, folds: int = CV_FOLDS, gap_days: int = 0) -> DataFrame:
    """Expanding folds: rows repeated per fold (from 1) with their ``role`` in it."""
    each = numbered(supervised).withColumn("fold", F.explode(F.array(*[F.lit(k) for k in range(1, folds + 1)])))
    test = F.floor(F.col("n_rows") / (folds + 1))
    start = F.col("n_rows") - (folds + 1 - F.col("fold")) * test
    role = (
        F.when(F.col("row_no") <= start - gap_days, "train")
        .when((F.col("row_no") > start) & (F.col("row_no") <= start + test), "test")
    )
    return each.withColumn("role", role).where(F.col("role").isNotNull()).drop("row_no", "n_rows")


def series_summary(supervised: DataFrame, min_rows: int) -> DataFrame:
    """Rows and date range per series, and why a series is too short to train."""
    return supervised.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_training_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).withColumn("skip_reason", F.when(
        F.col("n_training_rows") < min_rows,
        F.concat(F.lit("only "), F.col("n_training_rows"), F.lit(" usable training rows")),
    ))
