"""Alarms on missing captures, as a stream of their own.

A source's captured slots are kept in state until the watermark has passed them. An event-time timer then closes every slot
up to the watermark: one without rows is an alarm row. Rows are cut to one per source and slot, each input split for itself
first, before they meet in a source's state, so a source with very many rows sends it a row a slot and split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import slot
from ..operators.dedup import dedup_stream
from ..plans.monitors import CADENCE_MINUTES
from ..session import LARGE_STATE_SETTINGS
from ..sources.tables import append_stream

ALARM = "source string, slot timestamp"


class Gaps(StatefulProcessor):
    """For one source: `next`, the first slot that is not closed yet (in slots since the epoch), and the captured ones from there on."""

    def __init__(self, minutes: int):
        self.millis = minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "slot long")
        self.captured = handle.getMapState("captured", "slot long", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slots = {int(t.value // 1_000_000 // self.millis) for part in rows for t in part["slot"]}
        started = self.next.exists()
        first = self.next.get()[0] if started else min(slots)
        for number in slots:
            if number >= first:
                self.captured.updateValue((number,), (True,))
        if not started:
            # A first slot is closed when the watermark has passed its end.
            self.next.update((first,))
            self.handle.registerTimer((first + 1) * self.millis)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first = self.next.get()[0]
        open_ = max(first, timerValues.getCurrentWatermarkInMs() // self.millis)  # the slot that the watermark lies in
        missing = []
        for number in range(first, open_):
            if self.captured.containsKey((number,)):
                self.captured.removeKey((number,))
            else:
                missing.append(number)
        self.next.update((open_,))
        self.handle.registerTimer((open_ + 1) * self.millis)
        if missing:
            yield pd.DataFrame({"source": key[0], "slot": pd.to_datetime([n * self.millis for n in missing], unit="ms")})

    def close(self) -> None:
        pass


def gap_alarms(rows: DataFrame, minutes: int = CADENCE_MINUTES, delay: str = "1 hour", ts: str = "snapshot_id") -> DataFrame:
    """A stream of (source, slot): slots from each source's first capture on that the watermark has passed without a row of it.

    A source that falls silent gives alarms as far as other sources move the watermark; where all are silent, nothing does.
    """
    slots = rows.select("source", slot(F.col(ts), minutes).alias("slot"))
    once = dedup_stream(slots, ("source", "slot"), "slot", delay)
    return once.groupBy("source").transformWithStateInPandas(
        statefulProcessor=Gaps(minutes), outputStructType=ALARM, outputMode="Append", timeMode="EventTime"
    )


def alarm_stream(rows: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None, **options) -> StreamingQuery:
    """Store the alarms of what is available now. Timers need the state store that is kept outside the heap: it is set while the stream starts."""
    settings, name = rows.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = settings.get(name)
    settings.set(name, LARGE_STATE_SETTINGS[name])
    try:
        return append_stream(gap_alarms(rows, **options), path, checkpoint, state_partitions=state_partitions)
    finally:
        settings.set(name, before)
