"""Views over the typed prices. `as_of` stands for the current time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import slot, within
from ..operators.latest import latest_per_key
from ..operators.rank import rank_descending
from ..schemas import MOMENTUM, VOLATILITY, conform

AsOf = str | dt.datetime

# Rows of so many days hold the last 24 hours.
DAYS_READ = 1

# Settles the newest row should a table ever hold a (symbol, time) twice.
TIES = ("name", "price_usd", "volume_24h_usd", "market_cap_usd", "pct_change_24h")


def latest(silver: DataFrame, as_of: AsOf) -> DataFrame:
    """The newest row of each symbol seen in the last 24 hours."""
    return latest_per_key(within(silver, "observed_at", as_of, "24 HOURS"), ties=TIES)


def momentum(
    silver: DataFrame,
    as_of: AsOf,
    slices: int | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Latest row per symbol with its rank by 24-hour change: ties share a rank, NULLs last."""
    columns = [c for c in MOMENTUM.names if c != "momentum_rank"]
    ranked = rank_descending(
        latest(silver, as_of).select(*columns),
        "pct_change_24h",
        "momentum_rank",
        slices,
        staging,
    )
    return conform(ranked.withColumn("momentum_rank", F.col("momentum_rank").cast("int")), MOMENTUM)


def daily_range(silver: DataFrame, as_of: AsOf) -> DataFrame:
    """(max - min) / min of the price per symbol and UTC day, over the last 7 days.

    The span is cut by time, so its first day is partial. A day whose lowest
    price is zero has no return.
    """
    high, low = F.max("price_usd"), F.min("price_usd")
    spread = (high - low).cast("double") / F.nullif(low.cast("double"), F.lit(0.0))
    return (
        within(silver, "observed_at", as_of, "7 DAYS")
        .groupBy("symbol", F.to_date("observed_at").alias("day"))
        .agg(spread.alias("daily_return"))
    )


def day_states(rows: DataFrame) -> DataFrame:
    """(symbol, dt, low, high, close, close_at, row_count) of rows with their day: what the views need of a day, and can be merged."""
    price, at = F.col("price_usd"), F.col("observed_at")
    return rows.groupBy("symbol", "dt").agg(
        F.min(price).alias("low"),
        F.max(price).alias("high"),
        F.max_by(price, at).alias("close"),
        F.max(at).alias("close_at"),
        F.count(F.lit(1)).alias("row_count"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per symbol and day of states of parts of a day."""
    return states.groupBy("symbol", "dt").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max_by("close", "close_at").alias("close"),
        F.max("close_at").alias("close_at"),
        F.sum("row_count").alias("row_count"),
    )


def volatility_of_states(states: DataFrame, min_days: int = 3) -> DataFrame:
    """`volatility` of the merged states of its days."""
    spread = (F.col("high") - F.col("low")).cast("double") / F.nullif(F.col("low").cast("double"), F.lit(0.0))
    daily = states.select("symbol", F.col("dt").alias("day"), spread.alias("daily_return"))
    return conform(_annualised(daily, min_days), VOLATILITY)


def _annualised(daily: DataFrame, min_days: int) -> DataFrame:
    yearly = F.stddev_samp("daily_return") * F.sqrt(F.lit(365))
    return (
        daily.groupBy("symbol")
        .agg(
            yearly.alias("realized_volatility_7d"),
            F.count(F.lit(1)).alias("n_observations"),
            F.max("day").alias("last_observed_at"),
        )
        .where(F.col("n_observations") >= min_days)
    )


def volatility(silver: DataFrame, as_of: AsOf, min_days: int = 3) -> DataFrame:
    """Annualised deviation of the daily ranges. `n_observations` counts days, at most 8."""
    return conform(_annualised(daily_range(silver, as_of), min_days), VOLATILITY)


def volatility_close(silver: DataFrame, as_of: AsOf, min_days: int = 3) -> DataFrame:
    """The same from day-to-day changes of the closing price."""
    closing = (
        within(silver, "observed_at", as_of, "7 DAYS")
        .groupBy("symbol", F.to_date("observed_at").alias("day"))
        .agg(F.max_by("price_usd", "observed_at").cast("double").alias("close"))
    )
    # One row per symbol and day by now.
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("day"))
    daily = closing.withColumn("daily_return", F.col("close") / F.nullif(before, F.lit(0.0)) - 1).where(
        "daily_return IS NOT NULL"
    )
    return conform(_annualised(daily, min_days), VOLATILITY)


def correlation(
    silver: DataFrame, as_of: AsOf, first: str, second: str, span: str = "7 DAYS", slot_minutes: int = 60
) -> DataFrame:
    """Correlation of two symbols' closing prices over the slots in which both occur.

    One pass: both symbols are gathered per slot, without a join.
    """

    def close_of(symbol: str):
        at = F.when(F.col("symbol") == symbol, F.col("observed_at"))
        return F.max_by(F.col("price_usd").cast("double"), at)

    paired = (
        within(silver, "observed_at", as_of, span)
        .where(F.col("symbol").isin(first, second))
        .groupBy(slot(F.col("observed_at"), slot_minutes).alias("slot"))
        .agg(close_of(first).alias("a"), close_of(second).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL")
    )
    return paired.agg(
        F.lit(first).alias("first_symbol"),
        F.lit(second).alias("second_symbol"),
        F.count(F.lit(1)).alias("n_slots"),
        F.corr("a", "b").alias("correlation"),
    )
