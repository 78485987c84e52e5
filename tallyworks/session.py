"""The session settings that the engine's semantics rest on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: UTC makes to_date(timestamp) a UTC date; ANSI is kept on, so unsafe casts must be spelt try_*.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(master: str | None = None, app: str = "tallyworks", partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS; a cluster's own master and sizing stay as they are if not given."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | conf)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Set on a session made elsewhere what results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share. Only a local session may do without one."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        place = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", place)
    return f"{place.rstrip('/')}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it has run, so that the steps of a build do not add up on the disks."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)
