"""What the operators share: words, valid vectors, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts define it; bytes.split() without arguments splits at the same six bytes.
SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\f\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session without one gets one of its own."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        place = tempfile.mkdtemp(prefix="tallyworks-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tallyworks/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """df, written to the shared folder (partitioned by column `by`) and read again: lineage ends there, and lost executors cost
    no recomputation.

    Its shuffle files go as soon as it is written, so that the steps of an operator do not add up on the disks.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """What is planned and run inside sends this many rows at a time to Python."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def drop_tables(*frames: DataFrame) -> None:
    """Delete what materialize() wrote for these frames; nothing may read them afterwards."""
    for df in frames:
        spark = df.sparkSession
        for name in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
            while "=" in path.getName():
                path = path.getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_read(df: DataFrame) -> None:
    """Delete every table of materialize() that df reads; nothing may read them, or df, afterwards."""
    spark = df.sparkSession
    for name in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        if path.getParent().getName() == "tallyworks":
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def n_words(text: Column) -> Column:
    """The number of runs of other characters than ASCII white space (null: 0), as a long."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, f"[{SPACE}]+"))).cast("long")


def ascii_lower(text: Column) -> Column:
    """text with A-Z lower-cased and nothing else changed."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def finite_vectors(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows whose vector is not null, empty or zero, and holds only finite components."""
    x = F.col(vec)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return df.where(x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(x, lambda v: v != 0))
