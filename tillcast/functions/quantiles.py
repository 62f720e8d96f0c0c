"""Exact quantiles of a whole column without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Buckets per e-fold of the value: fine enough that a bucket holds few distinct values, while the
# number of buckets stays below 2 * 745 * 256 for all doubles.
BUCKETS_PER_E = 256.0


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float]) -> DataFrame:
    """One row with ``n``, ``mean``, ``low`` and the linearly interpolated quantiles of a positive column.

    Equal values are counted first (map-side combined), so a price shared by a third of all lines
    is one row. Distinct values get their running count in two levels: inside logarithmic buckets
    and over the bucket totals. Ranks are then plain aggregates.
    """
    counts = (
        df.where(F.col(value) > 0).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
        .withColumn("b", F.floor(F.log("v") * BUCKETS_PER_E))
    )
    in_order = Window.orderBy("b")
    totals = counts.groupBy("b").agg(F.sum("c").alias("t")).select(
        "b",
        (F.sum("t").over(in_order) - F.col("t")).alias("before"),
        F.sum("t").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
    )
    inside = Window.partitionBy("b").orderBy("v")
    upto = counts.withColumn("_inside", F.sum("c").over(inside)).join(totals, "b").select(
        "v", "c", "n", (F.col("_inside") + F.col("before")).alias("upto")
    )

    def at(rank):
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    measures = [
        F.max("n").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.max("n")).alias("mean"), F.min("v").alias("low"),
    ]
    for name, p in probs.items():
        position = (F.col("n") - 1) * F.lit(p)
        measures += [
            at(F.floor(position)).alias(f"{name}_low"), at(F.ceil(position)).alias(f"{name}_high"),
            F.max(position - F.floor(position)).alias(f"{name}_part"),
        ]
    found = upto.agg(*measures)
    return found.select("n", "mean", "low", *[
        (F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.col(f"{name}_part")).alias(name)
        for name in probs
    ])
