"""Aggregate expressions for forecast quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Floors of the denominator of the two percentage errors.
MAPE_FLOOR = 1e-6
LOGGED_MAPE_FLOOR = 1.0


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(predicted - actual))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((predicted - actual) * (predicted - actual)))


def mape(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(predicted - actual) / F.greatest(F.abs(actual), F.lit(MAPE_FLOOR))) * 100.0


def mape_floor1(actual: Column, predicted: Column) -> Column:
    """Percentage error of logged forecasts: signed actual with a floor of one money unit."""
    return F.avg(F.abs(predicted - actual) / F.greatest(actual, F.lit(LOGGED_MAPE_FLOOR))) * 100.0


def r_squared(actual: Column, predicted: Column) -> Column:
    """1 - SSE / SST; SST is n times the population variance."""
    return 1.0 - F.sum((predicted - actual) * (predicted - actual)) / (F.var_pop(actual) * F.count(actual))
