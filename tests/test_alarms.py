"""Alarms on missing captures, from a stream with timers."""

import datetime as dt

from tidemark.streaming.alarms import ALARM, alarm_stream

SCHEMA = "source string, snapshot_id timestamp"


def test_alarms_follow_the_watermark_and_come_once(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run(*rows):
        """Rows as (source, minutes after the hour 0) in one batch; the alarms so far, in minutes."""
        start = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)
        if rows:
            frame = spark.createDataFrame([(s, start + dt.timedelta(minutes=m)) for s, m in rows], SCHEMA)
            frame.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(SCHEMA).parquet(path)
        alarm_stream(stream, out, checkpoint, state_partitions=2, minutes=15, delay="30 minutes").awaitTermination()
        found = spark.read.schema(ALARM).parquet(out).collect()
        zero = dt.datetime(2024, 1, 30)
        return sorted((r["source"], (r["slot"] - zero).total_seconds() / 60) for r in found)

    # Copies, and rows of one slot at several times; nothing is closed but what the watermark (20) has passed.
    assert run(("a", 0), ("a", 3), ("a", 3), ("a", 50), ("b", 2)) == []
    # Watermark 95: slot 15 of a is missing, 30 came in time though out of order; b has missed five.
    got = run(("a", 31), ("a", 60), ("a", 75), ("a", 125))
    assert got == [("a", 15.0), ("b", 15.0), ("b", 30.0), ("b", 45.0), ("b", 60.0), ("b", 75.0)]
    # A long gap, closed at one go, and no alarm twice.
    got = run(("a", 600))
    assert [m for s, m in got if s == "a"] == [15.0, 90.0, 105.0, *[15.0 * k for k in range(9, 38)]]
    assert len(got) == len(set(got)) and ("b", 540.0) in got and ("b", 570.0) not in got
