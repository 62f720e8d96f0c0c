"""Versions of trained models: each run writes a folder of its own, and one manifest row, written last, makes it current.

A reader looks the current folder up once and reads everything from there, so it never sees models of one run beside a
registry of another. A run that fails before its row leaves the former version in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "number bigint, version string, published_at timestamp"
#: Versions that stay: the current one, and older ones for readers that looked up before the last run ended.
KEPT = 3


def versions(spark: SparkSession, models_dir: str) -> DataFrame:
    """Published versions, newest last by ``number``; two runs that end at once share one, the later name counts."""
    return spark.read.schema(MANIFEST).json(f"{models_dir}/manifest")


def current_folder(spark: SparkSession, models_dir: str) -> str | None:
    """The folder of the newest published version, None before the first."""
    try:
        newest = versions(spark, models_dir).orderBy(F.desc("number"), F.desc("version")).first()
    except AnalysisException:
        return None
    return None if newest is None else f"{models_dir}/versions/{newest['version']}"


def publish(spark: SparkSession, models_dir: str, write: Callable[[str], None], keep: int = KEPT) -> str:
    """Calls ``write`` with a new folder, then makes that folder current and removes versions beyond ``keep``."""
    if keep < 1:
        raise ValueError("the current version cannot go")
    version = uuid.uuid4().hex
    folder = f"{models_dir}/versions/{version}"
    write(folder)
    try:
        last = versions(spark, models_dir).agg(F.max("number")).first()[0] or 0
    except AnalysisException:
        last = 0
    row = spark.createDataFrame([(last + 1, version, datetime.now(timezone.utc))], MANIFEST)
    # One file: it is there as a whole or not at all.
    row.coalesce(1).write.mode("append").json(f"{models_dir}/manifest")
    _expire(spark, models_dir, keep)
    return folder


def _expire(spark: SparkSession, models_dir: str, keep: int) -> None:
    """Removes the folders of published versions older than the newest ``keep``; unpublished folders may still be written to."""
    old = versions(spark, models_dir).orderBy(F.desc("number"), F.desc("version")).offset(keep).collect()  # a row a run
    for row in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{models_dir}/versions/{row['version']}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
