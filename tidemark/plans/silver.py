"""Typed, deduplicated, checked prices: one row per symbol and capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import parse
from ..operators.dedup import KEYS, dedup_batch, dedup_stream
from ..operators.expectations import Expectation, enforce
from ..schemas import PAYLOAD_FIELDS, PayloadField

# Names, conditions and actions of the checks.
RULES = (
    Expectation("price_positive", "price_usd > 0", "warn"),
    Expectation("symbol_not_null", "symbol IS NOT NULL", "drop"),
    Expectation("valid_market_cap", "market_cap_usd >= 0", "warn"),
)


def typed(
    bronze: DataFrame,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """The payload's fields as columns, the capture's identity as `observed_at`."""
    return parse(bronze, fields, [F.col("snapshot_id").alias("observed_at"), *keep])


def build_batch(
    bronze: DataFrame,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
    order: Sequence[str | Column] | None = None,
    keys: Sequence[str] = KEYS,
    metrics: Observation | None = None,
) -> DataFrame:
    """Batch twin of `build_stream`. `order` decides which of several copies stays.

    By default the typed columns themselves decide; copies they cannot tell
    apart are the same row.
    """
    if order is None:
        order = [f.column for f in fields if f.column not in keys]
    return enforce(dedup_batch(typed(bronze, fields), order, keys), RULES, metrics)


def build_stream(
    bronze: DataFrame,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
    keys: Sequence[str] = KEYS,
    delay: str = "1 hour",
    metrics: str = "silver",
    split_hot_keys: bool = True,
) -> DataFrame:
    """Parse, dedup within the watermark, then apply the expectations to the result."""
    unique = dedup_stream(typed(bronze, fields), keys, "observed_at", delay, split_hot_keys)
    return enforce(unique, RULES, metrics)
