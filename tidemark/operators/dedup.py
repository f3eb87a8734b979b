"""Removing repeated captures of the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("symbol", "observed_at")


def dedup_batch(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = KEYS) -> DataFrame:
    """Keep the first row per key in the given order; the order makes it repeatable.

    Spark cuts each map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key with very many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    event_time: str = "observed_at",
    delay: str = "1 hour",
    split_hot_keys: bool = True,
) -> DataFrame:
    """Keep one row per key within the watermark; rows behind the watermark go.

    With `split_hot_keys` copies are first removed per key and input split, so
    that a key with very many copies is spread over as many tasks as it has
    splits, and the second pass sees one row per split. The first pass only ever
    removes copies of a row that it passes on, so the result is the same.
    """
    marked = df.withWatermark(event_time, delay)
    if split_hot_keys:
        marked = (
            marked.withColumn("_split", F.spark_partition_id())
            .dropDuplicatesWithinWatermark([*keys, "_split"])
            .drop("_split")
        )
    return marked.dropDuplicatesWithinWatermark(list(keys))
