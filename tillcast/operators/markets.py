"""Ranking of markets by revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.constants import HOME_MARKET, NON_MARKET_LABELS, OVERALL, TOP_MARKETS
from tillcast.operators.cleaning import only_markets


def revenue_by_country(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("country").agg(F.sum("price").alias("revenue"))


def top_countries(
    transactions: DataFrame, n: int = TOP_MARKETS, exclude_home: bool = False,
    labels=NON_MARKET_LABELS, home: str = HOME_MARKET,
) -> DataFrame:
    """The ``n`` countries with the highest revenue; equal revenue falls back on the name."""
    markets = only_markets(transactions, exclude_home, labels, home)
    return revenue_by_country(markets).orderBy(F.desc("revenue"), "country").limit(n)


def ranked(top: DataFrame) -> DataFrame:
    """A top list (at most ``n`` rows) with its 0-based rank."""
    order = Window.orderBy(F.desc("revenue"), "country")
    return top.withColumn("rank", F.row_number().over(order) - 1)


def as_transactions(activity: DataFrame) -> DataFrame:
    """Daily activity of countries in the shape the ranking takes: one row per country and day."""
    return activity.where(F.col("series") != OVERALL).select(F.col("series").alias("country"), "date", F.col("revenue").alias("price"))


def observed_as_of(activity: DataFrame, origins: DataFrame, last_origin) -> DataFrame:
    """(origin, series, revenue to date, last observed day) for every date of ``origins``.

    A running sum over at most one row per day; each row then stands for the days up to its
    successor, so origins meet it in an equi join.
    """
    by_date = Window.partitionBy("series").orderBy("date")
    running = by_date.rowsBetween(Window.unboundedPreceding, 0)
    last = F.lit(last_origin).cast("date")
    spans = activity.where(F.col("date") <= last).select(
        "series", F.col("date").alias("last_observed"),
        F.sum("revenue").over(running).alias("revenue"),
        F.coalesce(F.date_sub(F.lead("date").over(by_date), 1), last).alias("_until"),
    )
    days = spans.withColumn("origin", F.explode(F.sequence("last_observed", F.greatest("_until", "last_observed"))))
    return days.drop("_until").join(origins.select("origin").distinct(), "origin")


def trained_as_of(observed: DataFrame, n: int = TOP_MARKETS, labels=NON_MARKET_LABELS) -> DataFrame:
    """The overall series and the top ``n`` markets at every origin."""
    market = (F.col("series") != OVERALL) & ~F.lower("series").isin(*labels)
    place = Window.partitionBy("origin", "_market").orderBy(F.desc("revenue"), "series")
    return (
        observed.withColumn("_market", market).withColumn("_place", F.row_number().over(place))
        .where((F.col("series") == OVERALL) | (F.col("_market") & (F.col("_place") <= n)))
        .drop("_market", "_place")
    )
