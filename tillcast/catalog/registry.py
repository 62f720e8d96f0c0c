"""Collects the checked queries: a Spark callable per key and, where possible, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def shown(df: DataFrame, **places: int) -> DataFrame:
    """Dates as text, whole numbers as BIGINT, and the named doubles rounded: comparable across engines."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.IntegerType, T.ByteType, T.ShortType)):
            c = c.cast("bigint")
        elif f.name in places:
            c = F.round(c.cast("double"), places[f.name])
        columns.append(c.alias(f.name))
    return df.select(*columns)


def rounded(df: DataFrame, places: int) -> DataFrame:
    """``shown`` with every double rounded alike."""
    doubles = {f.name: places for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return shown(df, **doubles)


DATE = "strftime({0}, '%Y-%m-%d')"


def day(expr: str, alias: str = "date") -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {alias}"
