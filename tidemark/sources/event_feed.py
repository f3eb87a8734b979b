"""The `events` table as a feed of captures, for the registered queries and the bench.

Amounts are decimals and integers, so the payload text is the same in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_column, slot, to_payload
from ..plans.bronze import stamp
from ..session import pin_utc

SOURCE = "events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def rows(
    spark: SparkSession,
    sf_dir: str,
    symbol: str = "user",
    slot_minutes: int | None = 60,
    since: str | None = None,
) -> DataFrame:
    """One object per event, captured at the start of its slot (or its own time).

    symbol: "user" (few copies per capture), "event_type" (many), or "partial"
    (users, but error events lack a symbol). `since` skips captures before a slot
    start; the cut is put on the stored column, so it reaches the Parquet scan.
    """
    events = table(spark, sf_dir, "events")
    if since:
        events = events.where(F.col("ts") >= as_of_column(since).cast("timestamp_ntz"))
    at = F.col("ts").cast("timestamp")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    names = {
        "user": user,
        "event_type": F.col("event_type"),
        "partial": F.when(F.col("event_type") != "error", user),
    }
    k = F.get_json_object("props", "$.k").cast("int") - 50
    return events.select(
        (slot(at, slot_minutes) if slot_minutes else at).alias("snapshot_id"),
        names[symbol].alias("symbol"),
        F.col("event_type").alias("name"),
        F.col("value").cast("decimal(18,2)").alias("current_price"),
        F.round(F.col("value") * 1000).cast("bigint").alias("total_volume"),
        F.round(F.col("value") * 1_000_000).cast("bigint").alias("market_cap"),
        (k / 100).cast("decimal(5,2)").alias("price_change_percentage_1h_in_currency"),
        (k / 10).cast("decimal(5,1)").alias("price_change_percentage_24h"),
        (k / 5).cast("decimal(6,1)").alias("price_change_percentage_7d_in_currency"),
        F.col("event_id"),
    )


def payload(feed: DataFrame):
    return to_payload([c for c in feed.columns if c != "snapshot_id"])


def bronze(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The feed as raw rows."""
    feed = rows(spark, sf_dir, **options)
    return stamp(feed, payload(feed), "snapshot_id", SOURCE)


def mixed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good objects, objects without a symbol, and plain prose of all lengths."""
    documents = table(spark, sf_dir, "documents")
    prose = stamp(documents, "text", as_of_column("2024-01-30 00:00:00"), "documents")
    return bronze(spark, sf_dir, symbol="partial").unionAll(prose)
