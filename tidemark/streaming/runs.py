"""Streaming writers. Each run takes what is available and stops."""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.dedup import KEYS
from ..operators.expectations import observe
from ..plans import bronze, silver
from ..schemas import BRONZE, LINEAGE
from ..session import fresh_path, settle
from ..sources.packed_days import DayPaths, known_keys
from ..sources.tables import VERDICT, append_stream, delete_folder, exists, read_table, stored, stream_table

BRONZE_STORED = stored(BRONZE, *LINEAGE.fields, VERDICT)


@dataclass
class RunSummary:
    """Totals of one run over all its micro-batches.

    `complete` is false if the run was not followed and the session keeps fewer progress reports than it
    had batches; the totals then miss the earliest ones. `watermark` is that of the last batch: every row dropped
    so far was at or before it, and the stream adds none there any more. None if there was no batch, or no watermark.
    `dropped_to` is that of the last batch with new input: every row dropped so far was at or before it, as a batch drops
    rows of its own input alone. None if no batch had any.
    """

    complete: bool = True
    watermark: dt.datetime | None = None
    dropped_to: dt.datetime | None = None
    batches: int = 0
    rows_in: int = 0
    late_rows: int = 0
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)


def _add(summary: RunSummary, progress) -> None:
    summary.batches += 1
    summary.rows_in += progress.numInputRows
    summary.late_rows += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
    mark = (progress.eventTime or {}).get("watermark")
    if mark:
        moment = dt.datetime.fromisoformat(mark)
        summary.watermark = max(summary.watermark or moment, moment)
        # By offsets, as the count of input rows is left at 0 where Spark cannot tell it.
        if any(s.startOffset != s.endOffset for s in progress.sources):
            summary.dropped_to = max(summary.dropped_to or moment, moment)
    for name, row in (progress.observedMetrics or {}).items():
        totals = summary.metrics.setdefault(name, {})
        for key, count in row.asDict().items():
            totals[key] = totals.get(key, 0) + count


class Totals(StreamingQueryListener):
    """Adds up every progress report of every run as it comes, so no number of batches is too many to be kept."""

    KEPT = 1_000

    def __init__(self):
        self.runs: dict[str, tuple[RunSummary, threading.Event]] = {}
        self.followed: set[str] = set()

    def follow(self, query: StreamingQuery) -> StreamingQuery:
        """Keep the totals of this run until they are asked for."""
        self.followed.add(str(query.runId))
        return query

    def onQueryStarted(self, event) -> None:
        # Called before the start returns. Of other packages' runs only the newest are kept.
        for name in list(self.runs)[: -self.KEPT]:
            if name not in self.followed and self.runs[name][1].is_set():
                del self.runs[name]
        self.runs[str(event.runId)] = (RunSummary(), threading.Event())

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) in self.runs:
            _add(self.runs[str(event.progress.runId)][0], event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs:
            self.runs[str(event.runId)][1].set()

    def of(self, query: StreamingQuery, seconds: float = 60.0) -> RunSummary | None:
        """The totals of a followed run that has ended; None of any other. Reports come a little later than the end."""
        name = str(query.runId)
        if name not in self.followed or name not in self.runs or not self.runs[name][1].wait(seconds):
            return None
        self.followed.discard(name)
        return self.runs.pop(name)[0]


_totals: dict[str, Totals] = {}


def totals(spark: SparkSession) -> Totals:
    """The session's listener; it is added when the first stream of this package starts."""
    application = spark.sparkContext.applicationId
    if application not in _totals:
        _totals[application] = Totals()
        spark.streams.addListener(_totals[application])
    return _totals[application]


def finish(query: StreamingQuery) -> RunSummary:
    """Wait for the run and add up its progress. Raises if the query failed.

    Batches without data report zeros, so totals are sums, never the last value. Of a query that was not started
    here only the reports that the session keeps are known.
    """
    query.awaitTermination()
    told = totals(SparkSession.active()).of(query)
    if told is not None:
        return told
    seen = query.recentProgress
    limit = SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates")
    # Spark keeps one report fewer than the limit.
    summary = RunSummary(complete=len(seen) < int(limit) - 1)
    for progress in seen:
        _add(summary, progress)
    return summary


def _followed(df: DataFrame, path: str, checkpoint: str, *partition_by: str, **options) -> StreamingQuery:
    listener = totals(df.sparkSession)
    return listener.follow(append_stream(df, path, checkpoint, partition_by, **options))


def bronze_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store raw rows by verdict, so rejected rows lie beside the kept ones. A source without lineage gets NULLs.

    No day folders: captures arrive in time order, so each file covers few of
    them and its statistics already prune by `snapshot_id`.
    """
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in LINEAGE.fields if f.name not in rows.columns})
    marked = bronze.verdict(observe(rows, bronze.RULES, "bronze"))
    return _followed(marked, path, checkpoint, "verdict")


def _bronze_source(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    return stream_table(spark, path, BRONZE_STORED, max_files)


def silver_stream(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    checkpoint: str,
    max_files: int | None = None,
    state_partitions: int | None = None,
    **options,
) -> StreamingQuery:
    """Kept raw rows to typed rows, stored by day. Options go to `silver.build_stream`.

    Choose `state_partitions` for the expected volume: it cannot change later.
    """
    source = bronze.kept(_bronze_source(spark, bronze_path, max_files))
    rows = silver.build_stream(source, **options)
    by_day = rows.withColumn("dt", F.to_date("observed_at"))
    return _followed(by_day, path, checkpoint, "dt", state_partitions=state_partitions)


@dataclass
class Audit:
    """Totals of one update, counted from the stored raw rows themselves, so no batch is missed."""

    rows: int = 0
    quarantined: int = 0
    repaired: int = 0


def audit_stream(
    spark: SparkSession,
    bronze_path: str,
    paths: DayPaths,
    metrics_path: str,
    checkpoint: str,
    max_files: int | None = None,
    watermark: dt.datetime | None = None,
) -> tuple[StreamingQuery, Audit]:
    """Follow the raw table behind the typed stream: count its new rows, and repair what came late.

    Rows behind the watermark are dropped by the typed stream. Each batch of raw rows is counted in one pass. Only rows
    at or before `watermark`, the last that the typed stream has used on input, can have been dropped (without it, any): if
    there are such, their keys are looked up in the days they fall into, as far as those days' digests
    do not rule them out, and what is missing is written beside the typed table. So the typed rows do not depend on the
    order in which files come, and an update without old rows reads nothing twice.
    A batch has folders of its own that a repeated run of it overwrites. Start it when the typed stream has ended.
    """
    total = Audit()
    at = F.col("snapshot_id")

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        old = (F.col("verdict") == "kept") & (F.lit(True) if watermark is None else at <= F.lit(watermark))
        rows, quarantined, overdue = batch.agg(
            F.count(F.lit(1)), F.count_if(bronze.quarantine_reason(batch).isNotNull()), F.count_if(old)
        ).first()
        repaired = _repair(session, batch.where(old), number) if overdue else 0
        counted = (("rows", rows), ("quarantined", quarantined), ("repaired", repaired))
        counts = session.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counted])
        counts.coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/batch={number}")
        total.rows, total.quarantined, total.repaired = total.rows + rows, total.quarantined + quarantined, total.repaired + repaired

    def _repair(session: SparkSession, overdue: DataFrame, number: int) -> int:
        aside = fresh_path(session, "overdue")
        try:
            typed = settle(silver.build_batch(bronze.kept(overdue)).withColumn("dt", F.to_date("observed_at")), "rows", aside)
            missing = typed.join(known_keys(session, paths, typed, number), list(KEYS), "left_anti")
            own = f"{paths.late}/batch={number}"
            repeated = exists(session, own)
            missing.write.mode("overwrite").partitionBy("dt").parquet(own)
            count = read_table(session, own, typed.schema).count()  # of the files' footers
            if not count and not repeated:
                delete_folder(session, own)
            return count
        finally:
            delete_folder(session, aside)

    source = _bronze_source(spark, bronze_path, max_files)
    query = source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return query, total


def quarantine_stream(
    spark: SparkSession, bronze_path: str, path: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Unusable raw rows, with reasons, as JSON lines."""
    rejects = bronze.quarantine(_bronze_source(spark, bronze_path, max_files))
    return _followed(rejects, path, checkpoint, fmt="json")
