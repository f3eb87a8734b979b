"""Raw captures: one row per captured object, payload kept as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import not_an_object, with_rescued
from ..operators.expectations import Expectation, keeps
from ..schemas import LINEAGE, PAYLOAD_FIELDS, PayloadField
from ..sources.landing import STAMP_KEY, capture_time

# A capture may be stamped later than its file by this much: clocks differ.
TOLERANCE = "1 DAY"
IMPLAUSIBLE = "capture_time_implausible"

# Name, condition and action of the check.
RULES = (Expectation("non_empty_payload", "payload IS NOT NULL AND length(payload) > 10", "drop"),)


def stamp(rows: DataFrame, payload: str | Column, snapshot_id: str | Column, source: str) -> DataFrame:
    """Put the capture's identity and source on each of its rows."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return rows.select(
        as_column(snapshot_id).alias("snapshot_id"),
        as_column(payload).alias("payload"),
        F.lit(source).alias("source"),
    )


def from_landing(
    lines: DataFrame,
    source: str,
    slot_minutes: int | None = None,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
) -> DataFrame:
    """Raw rows of landed lines (batch or stream), with their lineage; the line is kept byte for byte."""
    lineage = with_lineage(lines, fields, slot_minutes)
    return lineage.select(
        F.col("_ingestion_ts").alias("snapshot_id"), "payload", F.lit(source).alias("source"), *LINEAGE.names
    )


def explode_responses(responses: DataFrame, document: str, snapshot_id: str, source: str) -> DataFrame:
    """One row per element of a response that lists many objects.

    Elements keep their fields, but numbers are rendered anew (1.50 becomes 1.5).
    """
    rows = responses.select(
        snapshot_id, F.explode(F.from_json(document, "array<string>")).alias("_element")
    )
    return stamp(rows, "_element", snapshot_id, source)


def with_lineage(
    lines: DataFrame,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
    slot_minutes: int | None = None,
) -> DataFrame:
    """Raw rows with the file they came from and the fields nobody asked for."""
    known = [f.key for f in fields] + [STAMP_KEY]
    rows = lines.select(
        capture_time(slot_minutes).alias("_ingestion_ts"),
        F.col("source_file").alias("_source_file"),
        F.col("value").alias("payload"),
        "landed_at",
    )
    return with_rescued(rows, "payload", known)


def implausible(bronze: DataFrame, tolerance: str = TOLERANCE) -> Column:
    """Whether a row's capture time is missing, or later than its file by more than the tolerance.

    Judged against the file's time, which is data too, never the clock. A capture
    time from the future would move the watermark past everything that follows.
    """
    missing = F.col("snapshot_id").isNull()
    if "landed_at" not in bronze.columns:
        return missing
    ahead = F.col("snapshot_id") > F.col("landed_at") + F.expr(f"INTERVAL {tolerance}")
    return missing | F.coalesce(ahead, F.lit(False))


def verdict(bronze: DataFrame) -> DataFrame:
    """Mark rows 'kept', 'rejected' or 'implausible', to store all in one pass over the input."""
    why = F.when(~keeps(RULES), "rejected").when(implausible(bronze), "implausible")
    return bronze.withColumn("verdict", why.otherwise("kept"))


def kept(stored: DataFrame) -> DataFrame:
    """The accepted rows of the stored table; only their folders are read."""
    return stored.where("verdict = 'kept'").drop("verdict")


def quarantine_reason(bronze: DataFrame) -> Column:
    """Why no typed table can use a row, or NULL. The text is only checked for being an object where no symbol was found."""
    payload = F.col("payload")
    no_symbol = F.get_json_object(payload, "$.symbol").isNull()
    why = F.when(not_an_object(payload), "unparseable").otherwise("symbol_not_null")
    return F.when(~keeps(RULES), RULES[0].name).when(implausible(bronze), IMPLAUSIBLE).when(no_symbol, why)


def quarantine(bronze: DataFrame) -> DataFrame:
    """Rows no typed table can use, each with the reason. The payload is kept whole.

    Stateless, so it serves batches and streams alike. As in `functions.parse`, a
    generator keeps the filter from computing the reason a second time.
    """
    reason = quarantine_reason(bronze)
    return (
        bronze.select("snapshot_id", "source", F.explode(F.array(reason)).alias("reason"), "payload")
        .where("reason IS NOT NULL")
    )
