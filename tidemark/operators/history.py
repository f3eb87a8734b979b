"""Looking up a key's value as it stood some time earlier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def price_before(
    df: DataFrame,
    name: str,
    lag_seconds: int = 86_400,
    key: str = "symbol",
    ts: str = "observed_at",
    value: str = "price_usd",
    slot_seconds: int = 3_600,
) -> DataFrame:
    """(key, ts, value, name): the key's last value at or before `ts - lag`.

    Equal to LAST_VALUE over RANGE BETWEEN UNBOUNDED PRECEDING AND lag PRECEDING,
    but a key's whole history never meets in one task, only its rows of one slot: choose
    a shorter `slot_seconds` for very dense keys. Time is cut into slots that divide the lag. A row's target time lies in one known slot: the answer
    is the last value there up to the target, or else the closing value of the
    nearest earlier slot. Only one closing value per key and slot is carried
    along the key's timeline. Rows must be unique per (key, ts), with neither NULL.
    `df` is read twice: pass a stored table.
    """
    if lag_seconds % slot_seconds:
        raise ValueError("slot_seconds must divide lag_seconds")
    lag_micros, slot_micros = lag_seconds * 1_000_000, slot_seconds * 1_000_000

    def entry(kind: int, micros: Column, fact: Column) -> Column:
        start = micros - F.pmod(micros, F.lit(slot_micros))
        return F.struct(
            start.alias("_slot"), micros.alias("_at"), F.lit(kind).alias("_kind"), fact.alias("_fact")
        )

    micros = F.unix_micros(ts)
    known = F.struct(F.col(value).alias("v"))
    # Every row is a fact at its own time and a probe at its target time.
    both = df.select(
        F.col(key).alias("_key"),
        F.col(ts).alias("_ts"),
        F.col(value).alias("_now"),
        F.inline(
            F.array(
                entry(0, micros, known),
                entry(1, micros - F.lit(lag_micros), F.when(F.lit(False), known)),
            )
        ),
    )
    in_slot = Window.partitionBy("_key", "_slot").orderBy("_at", "_kind")
    found = both.withColumn("_found", F.last("_fact", ignorenulls=True).over(in_slot)).where("_kind = 1")

    # One row per key and slot, so a timeline is as long as the calendar, not the data.
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    known_at = F.when(F.col("_kind") == 0, F.col("_at"))
    carried = (
        both.groupBy("_key", "_slot")
        .agg(F.max_by("_fact.v", known_at).alias("_v"), F.max(known_at).alias("_v_at"))
        # Plain columns above, so that the aggregation is a hash one; a known NULL is not an unknown value.
        .withColumn("_close", F.when(F.col("_v_at").isNotNull(), F.struct(F.col("_v").alias("v"))))
        .withColumn("_carried", F.last("_close", ignorenulls=True).over(earlier))
        .select("_key", "_slot", "_carried")
    )
    return found.join(carried, ["_key", "_slot"], "left").select(
        F.col("_key").alias(key),
        F.col("_ts").alias(ts),
        F.col("_now").alias(value),
        F.coalesce(F.col("_found"), F.col("_carried"))["v"].alias(name),
    )
