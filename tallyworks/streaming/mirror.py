"""Streams into the lake: the newest row of each key, or each event once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import dedupe_latest, merge_newest
from ..sources.lake import Lake


def mirror(stream: DataFrame, lake: Lake, name: str, keys: list[str], order: list[str], checkpoint: str):
    """Start a query that keeps the newest row of each key in the lake. A micro-batch that is run again changes nothing, and rewrites only the buckets
    of its keys."""
    by = [F.col(c).desc_nulls_last() for c in order]

    def step(batch: DataFrame, _: int) -> None:
        fresh = dedupe_latest(batch, keys, by)
        lake.publish(lake.merge(name, fresh, keys, lambda old, new: merge_newest(old, new, keys, by)))

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """Each event once: a repetition that comes within `delay` of the first is dropped, and so is what is older than the newest
    event by more than that. State is kept for `delay` only. Rows with a null key are one key; a null time raises no watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def append_once(stream: DataFrame, lake: Lake, name: str, keys: list[str], checkpoint: str):
    """Start a query that adds the events of first_seen() to the lake. A micro-batch that is run again after a crash replaces its own rows,
    and rewrites only the buckets of its keys."""

    def step(batch: DataFrame, _: int) -> None:
        lake.upsert(name, batch, keys)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
