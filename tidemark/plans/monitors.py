"""Row counts, freshness, coverage and missing captures."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_column, at_or_before, seconds_of, slot, within

# The service targets.
FRESHNESS_SECONDS = 15 * 60
LATENCY_SECONDS = 5 * 60
MIN_SYMBOLS = 100
MAX_DROP_RATE = 0.05
# Rows behind the watermark are lost rows but for the repair: the same limit.
MAX_LATE_RATE = MAX_DROP_RATE
CADENCE_MINUTES = 15


def layer_stats(layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and time range of each layer, given (table, time column) by name."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(ts).cast("timestamp").alias("first_at"),
            F.max(ts).cast("timestamp").alias("last_at"),
        ).select(F.lit(name).alias("layer"), "row_count", "first_at", "last_at")
        for name, (df, ts) in layers.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def freshness_coverage(
    momentum: DataFrame,
    as_of: str | dt.datetime,
    ts: str = "observed_at",
    max_age_seconds: int = FRESHNESS_SECONDS,
    min_symbols: int = MIN_SYMBOLS,
) -> DataFrame:
    """Age of the view's newest row and number of its symbols, against their targets.

    The view holds each symbol seen in the last 24 hours, so coverage falls when
    symbols stay away. Rows after `as_of` say nothing of its freshness.
    """
    age = seconds_of(as_of_column(as_of)) - seconds_of(F.col("last_observed_at"))
    return (
        at_or_before(momentum, ts, as_of)
        .agg(F.max(ts).alias("last_observed_at"), F.count_distinct("symbol").alias("symbols"))
        .withColumn("age_seconds", age)
        .withColumn("fresh", F.coalesce(F.col("age_seconds") <= max_age_seconds, F.lit(False)))
        .withColumn("covered", F.col("symbols") >= min_symbols)
    )


def _slots(spark: SparkSession, as_of: str | dt.datetime, days: int, minutes: int) -> DataFrame:
    """The capture slots that began in the `days` before `as_of` and are over by then, made in tasks."""
    moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    end = int(moment.replace(tzinfo=moment.tzinfo or dt.timezone.utc).timestamp()) // (minutes * 60)
    slots = spark.range(end - days * 24 * 60 // minutes, end)
    return slots.select(F.timestamp_seconds(F.col("id") * (minutes * 60)).alias("slot"))


def _captured(
    bronze: DataFrame, as_of: str | dt.datetime, days: int, minutes: int, ts: str
) -> DataFrame:
    """(slot, row_count) of every slot of the span; 0 where nothing arrived."""
    found = (
        within(bronze, ts, as_of, f"{days + 1} DAYS")
        .groupBy(slot(F.col(ts), minutes).alias("slot"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return _slots(bronze.sparkSession, as_of, days, minutes).join(found, "slot", "left").fillna(0, ["row_count"])


def capture_gaps(
    bronze: DataFrame,
    as_of: str | dt.datetime,
    days: int = 7,
    minutes: int = CADENCE_MINUTES,
    ts: str = "snapshot_id",
) -> DataFrame:
    """Slots of the last `days` before `as_of` in which nothing arrived, up to `as_of` itself.

    A feed that has died shows as gaps from its last capture on.
    """
    return _captured(bronze, as_of, days, minutes, ts).where("row_count = 0").select("slot")


def capture_growth(
    bronze: DataFrame,
    as_of: str | dt.datetime,
    days: int = 7,
    minutes: int = CADENCE_MINUTES,
    ts: str = "snapshot_id",
) -> DataFrame:
    """Captures and rows per UTC day of the span, beside the captures it should have; a day without any is there."""
    return (
        _captured(bronze, as_of, days, minutes, ts)
        .groupBy(F.to_date("slot").alias("day"))
        .agg(
            F.count_if(F.col("row_count") > 0).alias("captures"),
            F.sum("row_count").alias("row_count"),
            F.count_if(F.col("row_count") == 0).alias("missing"),
        )
    )
