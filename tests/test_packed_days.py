"""Packed days: few clustered files, whole readers, late rows, digests, and repairs that read only what they must."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from test_sources_and_streams import capture, land, typed_keys

from tidemark import medallion
from tidemark.plans import gold
from tidemark.sources import packed_days, read_table
from tidemark.sources.packed_days import days_to_read, known_keys, pack_closed_days, packed, tidy, typed_rows


def data_files(root):
    return sorted(p for p in glob.glob(f"{root}/**/*.parquet", recursive=True))


def packed_files(rows):
    return [f for f in rows.inputFiles() if "/silver_packed/" in f]


def day_of(number):
    return dt.date(2024, 1, number)


@pytest.fixture
def place(spark, tmp_path):
    """A landing area and a table of three days, each of three captures and a batch of its own."""
    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    for day in (28, 29, 30):
        for hour in ("01", "09", "17"):
            land(landing, "a.jsonl", capture(f"2024-01-{day}T{hour}:00:00Z", *"abcdef"), f"2024-01-{day}", hour)
    _, typed, _ = medallion.take_in(spark, landing, layout, "s", max_files=3, state_partitions=4)
    return landing, layout, typed


def test_closed_days_are_few_files_and_hold_the_same_rows(spark, place):
    landing, layout, typed = place
    paths = medallion.day_paths(layout)
    before = typed_keys(spark, layout)
    assert len(data_files(f"{paths.live}/dt=2024-01-28")) >= 3
    assert medallion.pack(spark, layout, typed) == [day_of(28), day_of(29)]
    for day in (28, 29):
        assert len(data_files(f"{paths.packed}/n=000000000001/dt=2024-01-{day}")) == 1
    assert typed_keys(spark, layout) == before and len(before) == 54
    # Nothing new, nothing to do; the open day stays where it is.
    assert medallion.pack(spark, layout, typed) == []
    assert packed(spark, paths).through == day_of(29)
    # Only the days asked for are listed.
    some = packed_files(typed_rows(spark, paths, since=day_of(29)))
    assert len(some) == 1 and "n=000000000001/dt=2024-01-29" in some[0]


def test_large_days_become_narrow_ranges(spark, tmp_path):
    paths = packed_days.DayPaths.of(str(tmp_path / "t"))
    rows = spark.range(0, 20_000, 1, 40).selectExpr(
        "IF(id % 3 = 0, 'HOT', concat('s', id % 97)) AS symbol", "timestamp_seconds(1706400000 + id % 86400) AS observed_at"
    )
    typed = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in packed_days.SILVER if f.name not in rows.columns])
    typed.withColumn("dt", F.to_date("observed_at")).write.partitionBy("dt").parquet(paths.live)
    size = sum(os.path.getsize(f) for f in data_files(paths.live))
    pack_closed_days(spark, paths, dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc), file_bytes=size // 5)
    files = data_files(paths.packed)
    assert 4 <= len(files) <= 7 < len(data_files(paths.live))
    per_file = spark.read.parquet(*files).groupBy(F.input_file_name()).agg(F.min("symbol"), F.max("symbol"), F.min("observed_at"), F.max("observed_at")).collect()
    bounds = sorted(((r[1], r[3]), (r[2], r[4])) for r in per_file)
    assert sum(b[0][0] == b[1][0] == "HOT" for b in bounds) >= 1  # the hot symbol is cut by time
    assert typed_rows(spark, paths).count() == 20_000


def test_a_reader_keeps_what_it_planned_with(spark, place):
    landing, layout, typed = place
    planned = medallion.silver_table(spark, layout)
    medallion.pack(spark, layout, typed)
    again = medallion.silver_table(spark, layout)
    land(landing, "late.jsonl", capture("2024-01-28T05:00:00Z", "z"), "2024-01-28", "05")
    _, typed, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert audit.repaired == 1
    watermark = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)
    assert pack_closed_days(spark, medallion.day_paths(layout), watermark) == [day_of(28)]
    assert planned.count() == 54 and again.count() == 54 and medallion.silver_table(spark, layout).count() == 55
    # A packing that died leaves a folder that no manifest names.
    os.makedirs(f"{layout.table('silver_packed')}/n=000000000003/dt=2024-01-28")
    assert medallion.silver_table(spark, layout).count() == 55


def test_late_rows_of_packed_days_come_once_and_are_packed_in(spark, place):
    landing, layout, typed = place
    paths = medallion.day_paths(layout)
    medallion.pack(spark, layout, typed)
    late = capture("2024-01-28T09:00:00Z", "a", "new") + capture("2000-01-01T00:00:00Z", "old")
    land(landing, "late.jsonl", late, "2024-01-28", "09")
    _, typed, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert audit.repaired == 2
    keys = typed_keys(spark, layout)
    assert len(keys) == len(set(keys)) == 56
    written = pack_closed_days(spark, paths, typed.watermark or dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc))
    assert written == [dt.date(2000, 1, 1), day_of(28)] and typed_keys(spark, layout) == keys
    # The same rows once more: all are known now, and no folder is made for them.
    land(landing, "again.jsonl", late, "2024-01-28", "10")
    folders = sorted(os.listdir(paths.late))
    _, _, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert audit.repaired == 0 and typed_keys(spark, layout) == keys and sorted(os.listdir(paths.late)) == folders


def test_digests_rule_days_out(spark, place):
    _, layout, typed = place
    paths = medallion.day_paths(layout)
    medallion.pack(spark, layout, typed)
    at = lambda text: dt.datetime.fromisoformat(f"2024-01-{text}:00:00+00:00")

    def rows(*keys):
        return spark.createDataFrame(list(keys), "symbol string, observed_at timestamp").withColumn("dt", F.to_date("observed_at"))

    known = rows(("A", at("28T09")), ("NEW", at("29T09")))
    assert days_to_read(spark, paths, known) == ({day_of(28), day_of(29)}, {day_of(28)})
    files = packed_files(known_keys(spark, paths, known, -1))
    assert len(files) == 1 and "dt=2024-01-28" in files[0]
    read = known_keys(spark, paths, known, -1).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("/silver_packed/")[-1].split("/")[1] for r in read} == {"dt=2024-01-28"}
    # No key is ever ruled out wrongly.
    everything = typed_rows(spark, paths).select("symbol", "observed_at", "dt")
    for row in everything.where("dt < DATE '2024-01-30'").collect():
        assert row["dt"] in days_to_read(spark, paths, rows((row["symbol"], row["observed_at"].replace(tzinfo=dt.timezone.utc))))[1]
    # An old row of a day that is not there reads nothing; an open day is always read.
    assert days_to_read(spark, paths, rows(("X", dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc))))[1] == set()
    assert days_to_read(spark, paths, rows(("X", at("30T01"))))[1] == {day_of(30)}
    assert days_to_read(spark, paths, rows(("X", at("30T01"))).limit(0)) == (set(), set())


def test_an_update_without_old_rows_looks_nothing_up(spark, place, monkeypatch):
    landing, layout, typed = place
    medallion.pack(spark, layout, typed)
    from tidemark.streaming import runs

    asked = []
    monkeypatch.setattr(runs, "known_keys", lambda *args: asked.append(1) or known_keys(*args))
    land(landing, "b.jsonl", capture("2024-01-30T18:00:00Z", *"abc"), "2024-01-30", "18")
    _, _, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert (audit.rows, audit.repaired, asked) == (3, 0, [])
    # A row of the year 2000 looks up its own day alone.
    land(landing, "c.jsonl", capture("2000-01-01T00:00:00Z", "q"), "2000-01-01", "00")
    land(landing, "d.jsonl", capture("2024-01-30T18:15:00Z", *"abc"), "2024-01-30", "18")
    _, _, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert (audit.repaired, asked) == (1, [1])


def test_tidy_deletes_only_what_no_kept_reader_needs(spark, place):
    landing, layout, typed = place
    paths = medallion.day_paths(layout)
    medallion.pack(spark, layout, typed)
    land(landing, "late.jsonl", capture("2024-01-28T05:00:00Z", "z"), "2024-01-28", "05")
    medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    pack_closed_days(spark, paths, dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc))
    keys = typed_keys(spark, layout)
    tidy(spark, paths, keep=2)
    assert os.path.exists(f"{paths.packed}/n=000000000001/dt=2024-01-28") and typed_keys(spark, layout) == keys
    assert not os.path.exists(f"{paths.live}/dt=2024-01-28") and os.path.exists(f"{paths.live}/dt=2024-01-30")
    tidy(spark, paths, keep=1)
    assert typed_keys(spark, layout) == keys
    # The stream goes on, and what it adds is read with the rest.
    land(landing, "e.jsonl", capture("2024-01-31T20:00:00Z", *"abc"), "2024-01-31", "20")
    update = medallion.run(spark, landing, layout, "s", "2024-01-31 20:05:00", state_partitions=4)
    assert (update.late_rate, update.late_alert) == (0.0, False)
    late = medallion.Update(update.bronze, update.silver, medallion.Audit(rows=100, quarantined=0, repaired=6), 1.0, True)
    assert (late.late_rate, late.late_alert) == (0.06, True)
    assert update.audit.repaired == 0 and len(typed_keys(spark, layout)) == len(keys) + 3
    assert medallion.momentum_view(spark, layout).count() == 3
    assert read_table(spark, layout.table("bronze")).count() > 0


def test_states_of_packed_days_serve_views_that_cut_days(spark, place):
    landing, layout, typed = place
    paths = medallion.day_paths(layout)
    medallion.pack(spark, layout, typed)
    # Late rows of a packed day, with a new lowest and a new closing price, are not packed yet.
    land(landing, "late.jsonl", capture("2024-01-28T05:00:00Z", "a", price=0.25) + capture("2024-01-28T23:00:00Z", "b", price=7.0), "2024-01-28", "05")
    medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    every = medallion.silver_table(spark, layout).where("observed_at IS NOT NULL")
    for start, end in (("2024-01-28 00:00:00", "2024-01-31 00:00:00"), ("2024-01-28 08:00:00", "2024-01-30 10:00:00"), ("2024-01-29 00:00:00", "2024-01-29 09:00:00")):
        moments = [dt.datetime.fromisoformat(t) for t in (start, end)]
        got = packed_days.states_within(spark, paths, *moments)
        want = gold.day_states(every.where(F.col("observed_at").between(*[F.lit(t).cast("timestamp") for t in (start, end)])))
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # Whole packed days are not read again.
    whole = packed_days.states_within(spark, paths, *(dt.datetime(2024, 1, d) for d in (28, 30)))
    assert packed_files(whole) == [] and any("/silver_states/" in f for f in whole.inputFiles())
    cut = packed_days.states_within(spark, paths, dt.datetime(2024, 1, 28, 8), dt.datetime(2024, 1, 30))
    assert len(packed_files(cut)) == 1 and "dt=2024-01-28" in packed_files(cut)[0]


def test_totals_of_a_run_need_no_kept_reports(spark, tmp_path):
    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    for i in range(5):
        land(landing, f"{i}.jsonl", capture(f"2024-01-30T1{i}:00:00Z", "a", "b"), hour=f"1{i}")
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        taken, typed, _ = medallion.take_in(spark, landing, layout, "s", max_files=1, state_partitions=4)
    finally:
        spark.conf.set(name, before)
    assert taken.complete and taken.rows_in == 10 and taken.metrics["bronze"]["rows_in"] == 10
    assert typed.complete and typed.rows_in == 10 and typed.watermark is not None
    again, typed, _ = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert again.rows_in == 0 and typed.rows_in == 0


def test_each_closed_day_is_packed_by_a_task_of_its_own(spark, place):
    _, layout, typed = place
    medallion.pack(spark, layout, typed)
    names = [os.path.basename(f).split("-")[1] for f in data_files(medallion.day_paths(layout).packed)]
    assert len(names) == len(set(names)) == 2


def test_small_days_stay_whole_beside_a_large_one(spark, tmp_path):
    paths = packed_days.DayPaths.of(str(tmp_path / "t"))
    rows = spark.range(0, 21_000, 1, 20).selectExpr(
        "concat('s', id % 97) AS symbol", "timestamp_seconds(1706400000 + IF(id < 20000, id, 86400 * (1 + id % 3) + id)) AS observed_at"
    )
    typed = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in packed_days.SILVER if f.name not in rows.columns])
    typed.withColumn("dt", F.to_date("observed_at")).write.partitionBy("dt").parquet(paths.live)
    size = sum(os.path.getsize(f) for f in data_files(f"{paths.live}/dt=2024-01-28"))
    written = pack_closed_days(spark, paths, dt.datetime(2024, 2, 10, tzinfo=dt.timezone.utc), file_bytes=size // 2)
    assert written == [day_of(28), day_of(29), day_of(30), day_of(31)]
    folder = f"{paths.packed}/n=000000000001"
    assert [len(data_files(f"{folder}/dt={day}")) for day in written[1:]] == [1, 1, 1]
    assert 2 <= len(data_files(f"{folder}/dt={written[0]}")) <= 4
    keys = typed_rows(spark, paths).select("symbol", "observed_at")
    assert keys.count() == 21_000 and keys.exceptAll(rows).count() == 0


def test_a_first_update_looks_nothing_up(spark, tmp_path, monkeypatch):
    from tidemark.streaming import runs

    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    asked = []
    monkeypatch.setattr(runs, "known_keys", lambda *args: asked.append(1) or known_keys(*args))
    for day in (28, 30):
        land(landing, "a.jsonl", capture(f"2024-01-{day}T01:00:00Z", *"abc"), f"2024-01-{day}", "01")
    # One batch takes both days in: it has dropped nothing, whatever the watermark it leaves.
    _, typed, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert (audit.rows, audit.repaired, asked) == (6, 0, [])
    assert typed.watermark.date() == day_of(30) and typed.dropped_to < typed.watermark
    # Rows that the next one drops are looked up. So are rows left over from a run that ended before its audit.
    land(landing, "b.jsonl", capture("2024-01-29T01:00:00Z", *"abc"), "2024-01-29", "01")
    _, typed, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert (audit.repaired, asked) == (3, [1]) and typed.dropped_to.date() == day_of(30)
    land(landing, "c.jsonl", capture("2024-01-27T01:00:00Z", *"abc"), "2024-01-27", "01")
    with monkeypatch.context() as broken:
        broken.setattr(medallion, "audit_stream", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    _, typed, audit = medallion.take_in(spark, landing, layout, "s", state_partitions=4)
    assert typed.dropped_to is None and audit.repaired == 3
    assert len(typed_keys(spark, layout)) == 12
