"""Reusable DataFrame operators."""

from .asof import value_before
from .dedup import dedup_batch, dedup_stream
from .expectations import (
    Expectation,
    drop_rate,
    enforce,
    keep,
    keeps,
    observe,
    observed_report,
    report,
)
from .history import price_before
from .latest import latest_per_key
from .rank import rank_descending

__all__ = [
    "Expectation",
    "dedup_batch",
    "dedup_stream",
    "drop_rate",
    "enforce",
    "keep",
    "keeps",
    "latest_per_key",
    "observe",
    "observed_report",
    "price_before",
    "rank_descending",
    "report",
    "value_before",
]
