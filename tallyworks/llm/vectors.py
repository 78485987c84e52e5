"""Vectors of a table: which take part, their clusters, and packing them for Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finite_vectors, materialize

#: rows that cluster centres are fitted on at most
SAMPLE = 8192


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", floats: bool = False) -> DataFrame:
    """(id, vec array<double>, or array<float> if floats is set and they are): one row per id. Vectors that are null, zero or not finite, null ids, and vectors of another
    length than most are left out; of repeated ids the smallest vector counts."""
    kind = "array<float>" if floats and df.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = finite_vectors(df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec")), "vec")
    rows = rows.where("id is not null").groupBy("id").agg(F.min("vec").alias("vec"))
    rows = materialize(rows, "vectors")
    most = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (most[0] if most else 0))


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a list column of one length as a matrix of doubles."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(rows: DataFrame, count: int, rounds: int = 6) -> np.ndarray:
    """k-means centres of unit vectors, fitted on at most SAMPLE rows, those with the smallest hash of their id."""
    sample = [r[0] for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()]
    x = unit(np.array(sample))
    # near copies give one seed, else a large group of them would take most of the centres
    seeds = []
    for i in range(len(x)):
        if len(seeds) >= count:
            break
        if not seeds or (x[seeds] @ x[i]).max() < 0.9:
            seeds.append(i)
    c = x[seeds].copy()
    for _ in range(rounds):
        own = np.concatenate([(x[i : i + 1024] @ c.T).argmax(axis=1) for i in range(0, len(x), 1024)])
        for k in range(len(c)):
            if (mine := own == k).any():
                mean = x[mine].mean(axis=0)
                c[k] = mean / max(np.linalg.norm(mean), 1e-12)
    return c
