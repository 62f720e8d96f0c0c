"""From transaction lines to dense daily series, every series in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.constants import DAILY_METRICS, OVERALL

#: Revenue is summed in this type; prices from the limit on, which it cannot add up, are summed as doubles.
EXACT, EXACT_BELOW = "decimal(28,6)", 1e18


def daily_activity(transactions: DataFrame) -> DataFrame:
    """Sparse activity per (series, date): one series per country and one over all rows.

    Lines are grouped once per counted id, by country, day and id: copies of an id collapse on the map
    side and the shuffle is keyed by the id, so a country or day that holds most rows spreads over all
    tasks. Distinct counts do not add up over countries; the overall series comes from those groups,
    merged by id, instead of from the lines. Revenue is summed as decimals, so it does not depend on the
    order of rows (a price counts to its sixth place), and stays unrounded; ``n_lines`` counts the lines.
    """
    exact = F.abs("price") < EXACT_BELOW
    lines = transactions.select(
        "date", "country", "invoice_clean", "stream_id", F.col("customer_id").cast("string").alias("customer_id"), "times_viewed",
        F.when(exact, F.col("price")).try_cast(EXACT).alias("price"), F.when(~exact, F.col("price")).alias("large"),
    )
    ids = ("invoice_clean", "stream_id", "customer_id")
    by_id = lines.groupingSets([["date", "country", i] for i in ids], "date", "country", *ids).agg(
        F.sum("price").alias("price"), F.sum("large").alias("large"), F.sum("times_viewed").alias("views"),
        F.count(F.lit(1)).alias("lines"), F.grouping_id().alias("grouping"),
    )
    # The two lower bits that are set name the ids left out.
    kind = F.when(F.col("grouping") == 3, "invoice").when(F.col("grouping") == 5, "stream").otherwise("customer")
    tagged = by_id.select("date", "country", kind.alias("kind"), F.coalesce(*ids).alias("id"), "price", "large", "views", "lines")
    # Groups of a country are counted as they are; those of all countries keep their id to be merged first.
    both = tagged.withColumn("_level", F.explode(F.array(
        F.struct(F.col("country").alias("series"), F.lit(None).cast("string").alias("id"), F.col("id").isNotNull().cast("bigint").alias("n")),
        F.struct(F.lit(OVERALL).alias("series"), F.col("id").alias("id"), F.lit(None).cast("bigint").alias("n")),
    )))
    totals = [F.sum(c).alias(c) for c in ("price", "large", "views", "lines")]
    merged = both.groupBy("_level.series", "date", "kind", F.col("_level.id").alias("id")).agg(*totals, F.sum("_level.n").alias("n"))
    n_ids = F.coalesce("n", F.col("id").isNotNull().cast("bigint"))
    once = F.col("kind") == "invoice"
    revenue = F.coalesce(F.sum(F.when(once, F.col("price"))).cast("double") + F.sum(F.when(once, F.col("large"))),
                         F.sum(F.when(once, F.col("price"))).cast("double"), F.sum(F.when(once, F.col("large"))))
    return merged.groupBy("series", "date").agg(
        revenue.alias("revenue"),
        *[F.sum(F.when(F.col("kind") == k, n_ids)).alias(name)
          for k, name in (("invoice", "purchases"), ("stream", "unique_streams"), ("customer", "unique_customers"))],
        F.sum(F.when(once, F.col("views"))).alias("total_views"),
        F.sum(F.when(once, F.col("lines"))).alias("n_lines"),
    )


def densify(sparse: DataFrame, metrics=DAILY_METRICS) -> DataFrame:
    """Every calendar day between a series' first and last day; absent days are zero.

    Each row is stretched up to the day before its successor, so there is no calendar table and no
    join, and the partitioning by series stays for the window functions that follow.
    """
    # Daily rows are few bytes but much window work: a fixed number of partitions keeps the series
    # spread over the cores, where size-based coalescing would put them in one task.
    width = sparse.sparkSession.sparkContext.defaultParallelism
    sparse = sparse.repartition(width, "series")
    by_series = Window.partitionBy("series").orderBy("date")
    successor = F.lead("date").over(by_series)
    last_day = F.greatest(F.date_sub(F.col("_successor"), 1), F.col("date"))
    stretched = sparse.withColumn("_successor", successor).withColumn(
        "_day", F.explode(F.sequence(F.col("date"), last_day))
    )
    observed = F.col("_day") == F.col("date")
    values = []
    for m in metrics:
        kind = sparse.schema[m].dataType
        values.append(F.when(observed, F.coalesce(F.col(m), F.lit(0).cast(kind))).otherwise(F.lit(0).cast(kind)).alias(m))
    return stretched.select("series", F.col("_day").alias("date"), *values)


def round_revenue(series: DataFrame) -> DataFrame:
    """Revenue to two places, half to even."""
    return series.withColumn("revenue", F.bround(F.col("revenue"), 2))


def daily_series(transactions: DataFrame) -> DataFrame:
    return round_revenue(densify(daily_activity(transactions)))


def keep_series(series: DataFrame, markets: DataFrame) -> DataFrame:
    """The overall series and those of the listed countries (column ``country``)."""
    wanted = markets.select(F.col("country").alias("series")).union(
        markets.sparkSession.range(1).select(F.lit(OVERALL).alias("series"))
    )
    return series.join(wanted, "series", "left_semi")


def unknown_series(requested: DataFrame, series: DataFrame) -> DataFrame:
    """Requested names (column ``series``) that have no rows."""
    return requested.join(series.select("series").distinct(), "series", "left_anti")
