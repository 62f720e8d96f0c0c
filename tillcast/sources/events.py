"""Event log: JSON lines with a timestamp, a kind and a free payload."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "ts timestamp, kind string, payload string"
PREDICT_SCHEMA = (
    "country string, as_of_date string, horizon_days int, predicted_revenue_next_30d double, model_family string, "
    "model_trained_at string, drift_detected boolean, duration_seconds double"
)


class NoEventsError(RuntimeError):
    pass


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """(ts, kind, payload) of the well-formed lines; blank, malformed and timeless lines are left out."""
    record = F.try_parse_json("value")
    parsed = lines.where(F.length(F.trim("value")) > 0).select(
        F.try_variant_get(record, "$.timestamp", "string").try_cast("timestamp").alias("ts"),
        F.try_variant_get(record, "$.kind", "string").alias("kind"),
        F.col("value").alias("payload"),
    )
    return parsed.where(F.col("ts").isNotNull())


def read_log_files(spark: SparkSession, log_dir: str, kind: str | None = None) -> DataFrame:
    """Flat ``kind-YYYY-MM.log`` files; the kind narrows the files read and is then compared exactly."""
    pattern = f"{kind}-*.log" if kind else "*.log"
    try:
        lines = spark.read.text(log_dir, pathGlobFilter=pattern)
    except AnalysisException:
        return spark.createDataFrame([], LOG_SCHEMA)
    events = parse_log_lines(lines)
    return events.where(F.col("kind") == kind) if kind else events


def read_event_log(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """A log written by ``append_events``; the kind prunes folders."""
    lines = spark.read.schema("value string, log_kind string, log_month string").format("text").load(path)
    if kind:
        lines = lines.where(F.col("log_kind") == kind)
    return parse_log_lines(lines)


def in_range(ts: Column, start=None, end=None) -> Column:
    """Both ends included; a bare date means the start of that day."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        inside = inside & (ts <= F.lit(end).cast("timestamp"))
    return inside


def query_log(log: DataFrame, kind=None, start=None, end=None, limit: int | None = None, tie: str | None = None) -> DataFrame:
    """Events newest first; a limit of 0 or None keeps all."""
    kept = log.where(in_range(F.col("ts"), start, end))
    if kind:
        kept = kept.where(F.col("kind") == kind)
    ordered = kept.orderBy(F.desc("ts"), *([tie] if tie else []))
    return ordered.limit(limit) if limit else ordered


def predictions(log: DataFrame, require: bool = False) -> DataFrame:
    """Logged forecasts with typed fields; ``require`` makes an empty log an error (one action)."""
    typed = log.where(F.col("kind") == "predict").select("ts", F.from_json("payload", PREDICT_SCHEMA).alias("p")).select(
        "ts", "p.*"
    ).withColumn("as_of_date", F.col("as_of_date").try_cast("date"))
    if require and typed.isEmpty():
        raise NoEventsError("no predict events found")
    return typed
