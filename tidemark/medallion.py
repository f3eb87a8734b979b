"""One triggered update: landed files to raw rows, typed rows, views and monitors."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .plans import bronze, gold, monitors
from .schemas import MOMENTUM, SILVER, VOLATILITY
from .session import fresh_path, pin_utc
from .sources.landing import stream_landing
from .sources.packed_days import DayPaths, pack_closed_days, states_within, tidy, typed_rows
from .sources.tables import (
    DAY,
    delete_folder,
    drop_old_versions,
    read_current,
    read_table,
    refresh,
    stored,
)
from .streaming.runs import (
    BRONZE_STORED,
    Audit,
    RunSummary,
    audit_stream,
    bronze_stream,
    finish,
    quarantine_stream,
    silver_stream,
)

SILVER_STORED = stored(SILVER, DAY)


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment. A full refresh is a run into a new `root`."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


@dataclass(frozen=True)
class Update:
    """What one update did. The summaries are the streams' own reports; `audit` is counted from what was stored."""

    bronze: RunSummary
    silver: RunSummary
    audit: Audit
    seconds: float
    on_time: bool

    @property
    def drop_rate(self) -> float:
        """Share of the update's raw rows that no typed row can come of."""
        return self.audit.quarantined / self.audit.rows if self.audit.rows else 0.0

    @property
    def drop_alert(self) -> bool:
        return self.drop_rate > monitors.MAX_DROP_RATE

    @property
    def late_rate(self) -> float:
        """Share of the update's raw rows that came behind the watermark and had to be repaired."""
        return self.audit.repaired / self.audit.rows if self.audit.rows else 0.0

    @property
    def late_alert(self) -> bool:
        """Many late rows: a back-fill, a slow source, or a watermark that one wrong capture time has moved too far."""
        return self.late_rate > monitors.MAX_LATE_RATE


def bronze_table(spark: SparkSession, layout: Layout) -> DataFrame:
    return bronze.kept(read_table(spark, layout.table("bronze"), BRONZE_STORED))


def day_paths(layout: Layout) -> DayPaths:
    return DayPaths.of(layout.table("silver"))


def silver_table(spark: SparkSession, layout: Layout, since: dt.date | None = None) -> DataFrame:
    """Typed rows: packed days, those of the stream, and those that came too late for it; from the day `since` on."""
    return typed_rows(spark, day_paths(layout), since)


def pack(spark: SparkSession, layout: Layout, typed: RunSummary) -> list[dt.date]:
    """Pack the days that the typed stream's last run has closed."""
    return pack_closed_days(spark, day_paths(layout), typed.watermark) if typed.watermark else []


def tidy_up(spark: SparkSession, layout: Layout, keep: int = 96) -> None:
    """Delete files that packed days have replaced, once no reader is older than `keep` updates. To be run by hand or by a schedule."""
    tidy(spark, day_paths(layout), keep)


def momentum_view(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_current(spark, layout.table("momentum"), stored(MOMENTUM))


def volatility_view(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_current(spark, layout.table("volatility"), stored(VOLATILITY))


def create_views(spark: SparkSession, layout: Layout, prefix: str = "") -> None:
    """Name the current tables for SQL: bronze, silver, momentum, volatility.

    A view keeps the version it was created on; create it again after an update.
    """
    tables = {
        "bronze": bronze_table,
        "silver": silver_table,
        "momentum": momentum_view,
        "volatility": volatility_view,
    }
    for name, table in tables.items():
        table(spark, layout).createOrReplaceTempView(f"{prefix}{name}")


def _moment(as_of: str | dt.datetime) -> dt.datetime:
    """In UTC, as `as_of_column` takes it."""
    moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return moment if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)


def refresh_views(
    spark: SparkSession, layout: Layout, as_of: str | dt.datetime, keep_versions: int = 96
) -> None:
    """Recompute the views: momentum from the last days' rows, volatility from day states. A day of quarter-hour versions is kept."""
    moment = _moment(as_of)
    silver = silver_table(spark, layout, moment.date() - dt.timedelta(days=gold.DAYS_READ))
    staging = fresh_path(spark, "momentum")
    try:
        refresh(gold.momentum(silver, as_of, staging=staging), layout.table("momentum"))
    finally:
        delete_folder(spark, staging)
    states = states_within(spark, day_paths(layout), moment - dt.timedelta(days=7), moment)
    refresh(gold.volatility_of_states(states), layout.table("volatility"))
    for view in ("momentum", "volatility"):
        drop_old_versions(spark, layout.table(view), keep_versions)


def refresh_monitors(
    spark: SparkSession, layout: Layout, as_of: str | dt.datetime, days: int = 7, keep_versions: int = 96
) -> None:
    """Store freshness and coverage of the view, missing captures, and captures per day."""
    raw = bronze_table(spark, layout)
    tables = {
        "freshness": monitors.freshness_coverage(momentum_view(spark, layout), as_of),
        "capture_gaps": monitors.capture_gaps(raw, as_of, days),
        "capture_growth": monitors.capture_growth(raw, as_of, days),
    }
    for name, rows in tables.items():
        refresh(rows, layout.table(name))
        drop_old_versions(spark, layout.table(name), keep_versions)


def take_in(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    source: str,
    slot_minutes: int | None = None,
    max_files: int | None = None,
    raw: DataFrame | None = None,
    state_partitions: int | None = None,
    **options,
) -> tuple[RunSummary, RunSummary, Audit]:
    """The streams of an update: raw rows, quarantine, typed rows, and the audit that repairs late ones.

    Options go to `silver_stream`, for example `split_hot_keys=False`.
    """
    if raw is None:
        raw = bronze.from_landing(stream_landing(spark, landing, max_files), source, slot_minutes)
    taken = finish(bronze_stream(raw, layout.table("bronze"), layout.checkpoint("bronze")))
    path = layout.table("bronze")
    rejects = quarantine_stream(spark, path, layout.table("quarantine"), layout.checkpoint("quarantine"), max_files)
    try:
        typed = finish(
            silver_stream(
                spark, path, layout.table("silver"), layout.checkpoint("silver"), max_files, state_partitions, **options
            )
        )
        finish(rejects)
    except BaseException:
        rejects.stop()
        raise
    # Of a run without input, raw rows may still be left to audit: they were judged by some earlier watermark.
    dropped_to = typed.dropped_to or typed.watermark
    query, audit = audit_stream(
        spark, path, day_paths(layout), layout.table("metrics"), layout.checkpoint("audit"), max_files, dropped_to
    )
    finish(query)
    return taken, typed, audit


def run(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    source: str,
    as_of: str | dt.datetime | None = None,
    slot_minutes: int | None = None,
    max_files: int | None = None,
    raw: DataFrame | None = None,
    state_partitions: int | None = None,
    **options,
) -> Update:
    """Take in what has landed since the last run, pack closed days, recompute the views and the monitors.

    `raw` replaces the landing reader by another stream of raw rows, for example
    `spark.readStream.format("snapshot_files")`. `as_of` defaults to the time when
    all is taken in, so captures that land during the run are in the views.
    """
    pin_utc(spark)
    began = time.monotonic()
    taken, typed, audit = take_in(spark, landing, layout, source, slot_minutes, max_files, raw, state_partitions, **options)
    pack(spark, layout, typed)
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    refresh_views(spark, layout, as_of)
    refresh_monitors(spark, layout, as_of)
    seconds = time.monotonic() - began
    return Update(taken, typed, audit, seconds, seconds <= monitors.LATENCY_SECONDS)
