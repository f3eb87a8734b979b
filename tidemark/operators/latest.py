"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str = "symbol",
    ts: str = "observed_at",
    ties: Sequence[str | Column] = (),
) -> DataFrame:
    """The newest row of each key; `ties` orders rows that share the newest time.

    Each map task passes on one row per key (WindowGroupLimit), whatever the
    number of rows a key has.
    """
    window = Window.partitionBy(key).orderBy(F.col(ts).desc(), *ties)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
