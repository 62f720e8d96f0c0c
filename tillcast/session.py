"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app_name: str = "tillcast", **conf: str) -> SparkSession:
    """Session with the library's defaults; keys in ``conf`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this session: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster session must
    name a folder that every executor can reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tillcast-")
    spark.conf.set("spark.checkpoint.dir", own)
    spark.sparkContext.setCheckpointDir(own)
    return own


#: The folder of the passing scratch data that are being made, with a slash behind it.
_within: ContextVar[str] = ContextVar("within", default="")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call has been given."""
    return f"{scratch_root(spark)}/{_within.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def passing_scratch(spark: SparkSession, label: str):
    """Paths given inside lie in one folder, which is deleted at the end: results must lie elsewhere."""
    path = scratch_path(spark, label)
    outer = _within.set(f"{path.removeprefix(scratch_root(spark) + '/')}/")
    try:
        yield
    finally:
        _within.reset(outer)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark's setting under which a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """The session's setting ``key`` is ``value`` inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def released_shuffles(spark: SparkSession):
    """Writes inside leave no shuffle files behind: what they wrote is read from then on."""
    return setting(spark, RELEASE_SHUFFLES, "true")


def materialise(df, label: str, **options):
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
