"""Exploratory statistics over transactions and daily series (one series per call or all at once)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.constants import DAILY_METRICS, HOME_MARKET, NON_MARKET_LABELS, OVERALL, TOP_MARKETS
from tillcast.functions.quantiles import exact_quantiles
from tillcast.operators.markets import revenue_by_country, top_countries
from tillcast.operators.supervised import by_day, span_sum

# Year-end gap, start of full coverage, first day of the weekday statistics.
GAP_YEARS = (2017, 2018)
GAP_FIRST, GAP_LAST = "12-21", "12-31"
FULL_COVERAGE_FROM = "2017-12-01"
WEEKDAYS_FROM = "2018-01-01"
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HISTOGRAM_EDGES = 40
HISTOGRAM_CLIP = 0.999
LOWEST_EDGE = 0.01
REST_LIMIT = 14


def month_of(date: str = "date") -> Column:
    return F.trunc(date, "MM")


# --- daily series -----------------------------------------------------------------------------

def rolling_mean(series: DataFrame, days: int = 30, min_days: int = 7) -> DataFrame:
    """Mean revenue of the last ``days`` days, from ``min_days`` days on."""
    row = F.row_number().over(by_day())
    mean = span_sum("revenue", 1 - days, 0) / F.least(row, F.lit(days))
    return series.select("series", "date", "revenue", F.when(row >= min_days, mean).alias("rolling_mean"))


def gap_windows(years=GAP_YEARS) -> list[tuple[str, str]]:
    return [(f"{y}-{GAP_FIRST}", f"{y}-{GAP_LAST}") for y in years]


def flag_gaps(series: DataFrame, years=GAP_YEARS, full_from: str = FULL_COVERAGE_FROM) -> DataFrame:
    """Days in a known year-end gap that the series spans, and days before full coverage."""
    span = Window.partitionBy("series").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.min("date").over(span), F.max("date").over(span)
    in_gap = F.lit(False)
    for low, high in gap_windows(years):
        low, high = F.lit(low).cast("date"), F.lit(high).cast("date")
        in_gap = in_gap | ((first <= low) & (last >= high) & F.col("date").between(low, high))
    return series.select(
        "series", "date", in_gap.alias("in_gap_window"),
        (F.col("date") <= F.lit(full_from).cast("date")).alias("in_partial_start"),
    )


def monthly_rollup(series: DataFrame) -> DataFrame:
    """Monthly sums of every metric with day counts and coverage."""
    return series.groupBy("series", month_of().alias("month_start")).agg(
        *[F.sum(m).alias(m) for m in DAILY_METRICS],
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(F.col("revenue") > 0).alias("days_with_revenue"),
        F.count_if(F.col("revenue") == 0).alias("days_without_revenue"),
    ).withColumn("days_in_month", F.dayofmonth(F.last_day("month_start")))


def partial_months(monthly: DataFrame) -> DataFrame:
    """Marks the first month of a series and every December."""
    first = F.min("month_start").over(Window.partitionBy("series"))
    return monthly.withColumn("is_partial", (F.col("month_start") == first) | (F.month("month_start") == 12))


def full_month_stats(flagged: DataFrame) -> DataFrame:
    full = F.when(~F.col("is_partial"), F.col("revenue"))
    return flagged.groupBy("series").agg(
        F.count(full).alias("n_full_months"), F.count_if("is_partial").alias("n_partial_months"),
        F.avg(full).alias("monthly_revenue_mean"), F.min(full).alias("monthly_revenue_min"),
        F.max(full).alias("monthly_revenue_max"), (F.stddev_samp(full) / F.avg(full)).alias("monthly_revenue_cv"),
    )


def trim_edge_months(monthly: DataFrame, longer_than: int = 2) -> DataFrame:
    """Without the first and last month of series that have more than ``longer_than`` months."""
    up = Window.partitionBy("series").orderBy("month_start")
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position, total = F.row_number().over(up), F.count(F.lit(1)).over(whole)
    return (
        monthly.withColumns({"_position": position, "_total": total})
        .where((F.col("_total") <= longer_than) | ((F.col("_position") > 1) & (F.col("_position") < F.col("_total"))))
        .drop("_position", "_total")
    )


def monthly_correlations(monthly: DataFrame) -> DataFrame:
    """Pearson r with monthly revenue, edge months always left out."""
    return trim_edge_months(monthly, longer_than=0).groupBy("series").agg(
        F.corr("purchases", "revenue").alias("purchases_revenue"),
        F.corr("unique_streams", "revenue").alias("streams_revenue"),
        F.corr("unique_customers", "revenue").alias("customers_revenue"),
    )


def daily_fit(series: DataFrame) -> DataFrame:
    """Correlation and least-squares line of revenue on purchases over days with revenue."""
    active = series.where(F.col("revenue") > 0).withColumn("x", F.col("purchases").cast("double"))
    return active.groupBy("series").agg(
        F.corr("x", "revenue").alias("r"), F.regr_slope("revenue", "x").alias("slope"),
        F.regr_intercept("revenue", "x").alias("intercept"),
    )


def ordinary_days(series: DataFrame, since: str = WEEKDAYS_FROM) -> DataFrame:
    year_end = (F.month("date") == 12) & (F.dayofmonth("date") >= 21)
    return series.where((F.col("date") >= F.lit(since).cast("date")) & ~year_end)


def weekday_name() -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.element_at(names, F.weekday("date") + 1)


def weekday_distribution(series: DataFrame, since: str = WEEKDAYS_FROM) -> DataFrame:
    """Box-plot numbers of daily revenue per weekday; whiskers reach the last value within 1.5 IQR.

    A (series, weekday) group has one value per week, so quartiles are exact and small.
    """
    days = ordinary_days(series, since).withColumn("weekday", weekday_name())
    keys = ["series", "weekday"]
    quartiles = days.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.percentile("revenue", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
    ).select(*keys, "n_days", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("revenue").between(F.col("q1") - reach, F.col("q3") + reach)
    value = F.when(inside, F.col("revenue"))
    return days.join(quartiles, keys).groupBy(*keys, "n_days", "q1", "median", "q3").agg(
        F.least(F.min(value), F.col("q1")).alias("whisker_low"), F.greatest(F.max(value), F.col("q3")).alias("whisker_high"),
    )


def weekend_medians(series: DataFrame, since: str = WEEKDAYS_FROM) -> DataFrame:
    days = ordinary_days(series, since)
    saturday = F.when(F.weekday("date") == 5, F.col("revenue"))
    working = F.when(F.weekday("date") < 5, F.col("revenue"))
    return days.groupBy("series").agg(
        F.median(saturday).alias("saturday_median"), F.median(working).alias("weekday_median"),
    )


def comoving_index(series: DataFrame, metrics=("revenue", "purchases", "total_views"), days: int = 7) -> DataFrame:
    """Full ``days``-day rolling means, each as a percentage of its own average."""
    rolled = series.select("series", "date", F.row_number().over(by_day()).alias("_n"), *[
        (span_sum(m, 1 - days, 0) / days).alias(m) for m in metrics
    ]).where(F.col("_n") >= days).drop("_n")
    whole = by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rolled.select("series", "date", *[(F.col(m) / F.avg(m).over(whole) * 100).alias(f"{m}_index") for m in metrics])


def comoving_correlations(index: DataFrame, metrics=("revenue", "purchases", "total_views")) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(metrics) for b in metrics[i + 1:]]
    return index.groupBy("series").agg(*[F.corr(f"{a}_index", f"{b}_index").alias(f"{a}_{b}") for a, b in pairs])


# --- transactions -----------------------------------------------------------------------------

def revenue_shares(
    transactions: DataFrame, n: int = TOP_MARKETS, labels=NON_MARKET_LABELS, home: str = HOME_MARKET,
) -> DataFrame:
    """Totals and shares; the denominators count the excluded labels too. One scan."""
    country = revenue_by_country(transactions)
    market = ~F.lower("country").isin(*labels)
    # One row per country here.
    order = Window.partitionBy("_market").orderBy(F.desc("revenue"), "country")
    placed = country.withColumn("_market", market).withColumn("_place", F.row_number().over(order))
    top = F.col("_market") & (F.col("_place") <= n)
    at_home = F.col("_market") & (F.col("country") == home)
    sums = placed.agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum(F.when(top, F.col("revenue"))).alias("top_revenue"),
        F.coalesce(F.sum(F.when(at_home, F.col("revenue"))), F.lit(0.0)).alias("home_revenue"),
        F.count_if("_market").alias("n_countries_observed"),
        F.coalesce(F.sum(F.when(top & ~at_home, F.col("revenue"))), F.lit(0.0)).alias("top_abroad"),
    )
    return sums.select(
        "total_revenue",
        (F.col("top_revenue") / F.col("total_revenue")).alias("top_share_of_revenue"),
        (F.col("home_revenue") / F.col("total_revenue")).alias("home_share_of_revenue"),
        "n_countries_observed",
        (F.col("top_abroad") / (F.col("total_revenue") - F.col("home_revenue"))).alias("top_abroad_share_of_abroad"),
        (F.col("top_abroad") / F.col("total_revenue")).alias("top_abroad_share_of_total"),
    )


def home_vs_rest(transactions: DataFrame, home: str = HOME_MARKET) -> DataFrame:
    bucket = F.when(F.col("country") == home, F.lit("home")).otherwise(F.lit("rest"))
    return transactions.groupBy(bucket.alias("bucket")).agg(F.sum("price").alias("revenue"))


def flag_members(df: DataFrame, members: DataFrame, name: str = "is_modelled") -> DataFrame:
    """Whether each row's country is in ``members`` (column ``country``)."""
    marked = members.select("country").distinct().withColumn("_member", F.lit(True))
    return df.join(marked, "country", "left").withColumn(name, F.coalesce("_member", F.lit(False))).drop("_member")


def rank_rest(
    transactions: DataFrame, modelled: DataFrame, n: int = REST_LIMIT, labels=NON_MARKET_LABELS, home: str = HOME_MARKET,
) -> DataFrame:
    """The next countries after the home market, with the modelled ones marked."""
    return flag_members(top_countries(transactions, n, True, labels, home), modelled)


def price_stats(transactions: DataFrame) -> DataFrame:
    """Median, mean and 95th percentile of positive prices."""
    spread = exact_quantiles(transactions, "price", {"price_median": 0.5, "price_p95": 0.95})
    return spread.select("price_median", F.col("mean").alias("price_mean"), "price_p95")


def price_histogram(transactions: DataFrame) -> DataFrame:
    """Counts of positive prices in logarithmic bins between max(lowest, 0.01) and the 99.9th percentile.

    Prices above the last edge count in the last bin, prices below the first edge in none.
    """
    bins = HISTOGRAM_EDGES - 1
    limits = exact_quantiles(transactions, "price", {"high": HISTOGRAM_CLIP}).select(
        F.struct(F.greatest(F.col("low"), F.lit(LOWEST_EDGE)).alias("low"), "high")
    )
    # A scalar subquery: one row, known before the lines are read again.
    low = F.log10(F.col("_limits.low"))
    width = (F.log10(F.col("_limits.high")) - low) / bins
    counted = (
        transactions.where(F.col("price") > 0).groupBy("price").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_limits", limits.scalar())
        .where(F.col("price") >= F.col("_limits.low"))
        .withColumn("bin", F.least(F.floor((F.log10("price") - low) / width), F.lit(bins - 1)))
        .groupBy("bin").agg(F.sum("n").alias("n_transactions"))
    )
    edges = transactions.sparkSession.range(bins).withColumn("_limits", limits.scalar()).select(
        F.col("id").alias("bin"), F.pow(F.lit(10.0), low + F.col("id") * width).alias("left_edge"),
        F.pow(F.lit(10.0), low + (F.col("id") + 1) * width).alias("right_edge"),
    )
    return edges.join(counted, "bin", "left").withColumn("n_transactions", F.coalesce("n_transactions", F.lit(0)))


def missing_rate_by_month(transactions: DataFrame) -> DataFrame:
    """Share of lines without a customer per month, edge months trimmed when there are more than two."""
    monthly = transactions.groupBy(F.lit(OVERALL).alias("series"), month_of().alias("month_start")).agg(
        F.avg(F.col("customer_id").isNull().cast("int")).alias("missing_rate")
    )
    return trim_edge_months(monthly).drop("series")


def dataset_profile(transactions: DataFrame) -> DataFrame:
    """Null rate, date range, rows and distinct invoices.

    Lines first collapse to one row per invoice on the map side; only counts reach the last stage.
    """
    per_invoice = transactions.groupBy("invoice_clean").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_id").isNull()).alias("missing"),
        F.min("date").alias("first"), F.max("date").alias("last"),
    )
    return per_invoice.agg(
        (F.sum("missing") / F.sum("n")).alias("missing_customer_rate"), F.min("first").alias("date_min"),
        F.max("last").alias("date_max"), F.sum("n").alias("n_transactions"), F.count("invoice_clean").alias("n_invoices"),
    )
