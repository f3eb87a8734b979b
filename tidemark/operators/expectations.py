"""Data-quality expectations: warn keeps a failing row, drop removes it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A named SQL condition. A NULL outcome counts as failed."""

    name: str
    condition: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop"):
            raise ValueError(f"action must be 'warn' or 'drop', not {self.action!r}")

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def keeps(rules: Iterable[Expectation]) -> Column:
    """True where a row passes all drop expectations."""
    return reduce(and_, [r.passes() for r in rules if r.action == "drop"], F.lit(True))


def _counters(rules: Sequence[Expectation]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~keeps(rules)).alias("rows_dropped"),
        *[F.count_if(~r.passes()).alias(r.name) for r in rules],
    ]


def observe(df: DataFrame, rules: Sequence[Expectation], metrics: str | Observation) -> DataFrame:
    """Count failures while the rows pass by.

    Give a name for a stream (metrics appear in its progress) or an
    `Observation` for a batch (filled by the first action).
    """
    return df.observe(metrics, *_counters(rules))


def keep(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Remove rows that fail a drop expectation."""
    return df.where(keeps(rules))


def enforce(
    df: DataFrame, rules: Sequence[Expectation], metrics: str | Observation | None = None
) -> DataFrame:
    """`observe`, then `keep`. Apply to the finished rows, after any dedup."""
    watched = df if metrics is None else observe(df, rules, metrics)
    return keep(watched, rules)


def observed_report(
    spark: SparkSession, rules: Sequence[Expectation], metrics: Mapping[str, int]
) -> DataFrame:
    """Recorded metrics as rows: one per expectation."""
    return spark.createDataFrame(
        [(r.name, r.action, int(metrics["rows_in"]), int(metrics[r.name])) for r in rules],
        "expectation string, action string, checked bigint, failed bigint",
    )


def report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """The same rows as `observed_report`, computed as a query in one pass."""
    counted = df.agg(*_counters(rules))
    lines = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("expectation"),
                F.lit(r.action).alias("action"),
                F.col("rows_in").alias("checked"),
                F.col(r.name).alias("failed"),
            )
            for r in rules
        ]
    )
    return counted.select(F.inline(lines))


def drop_rate(df: DataFrame, table: str, rules: Sequence[Expectation], limit: float = 0.05) -> DataFrame:
    """Share of rows the drop expectations remove, and whether it passes the limit."""
    rate = F.col("rows_dropped") / F.nullif(F.col("rows_in"), F.lit(0))
    return (
        df.agg(*_counters(rules)[:2])
        .withColumn("drop_rate", F.coalesce(rate, F.lit(0.0)))
        .select(
            F.lit(table).alias("table_name"),
            "rows_in",
            "rows_dropped",
            "drop_rate",
            (F.col("drop_rate") > limit).alias("alert"),
        )
    )
