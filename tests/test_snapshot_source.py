"""The source by short name: lines with lineage, conditions that choose folders, and streams by commits."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from test_sources_and_streams import capture, land, typed_keys

from tidemark import medallion
from tidemark.plans import bronze
from tidemark.sources import landing as landing_area
from tidemark.sources import read_landing, read_snapshots, read_table, register, snapshot_files, stream_snapshots, write_landing
from tidemark.streaming import bronze_stream, finish


@pytest.mark.parametrize("split_bytes", [1, 50, 1 << 20])
def test_lines_equal_the_built_in_reader(spark, tmp_path, split_bytes):
    root = str(tmp_path)
    land(root, "a.jsonl", capture("2024-01-30T10:00:00Z", *"abcdefgh"))
    land(root, "b.jsonl", ["broken {", *capture("2024-01-30T11:30:00.5Z", "ñ"), '{"symbol":"no stamp"}'], hour="11")
    with open(f"{root}/dt=2024-01-30/hh=11/c.jsonl", "wb") as file:
        file.write(b'{"symbol":"\xff"}\r\n\r\n' + json.dumps({"symbol": "last"}).encode())
    ours = read_snapshots(spark, root, splitBytes=split_bytes)
    theirs = read_landing(spark, root).where("value <> ''")
    shape = lambda df, kept: sorted(tuple(r) for r in df.select(*kept).collect())
    assert shape(ours, ["value", "dt", "hh"]) == shape(theirs, ["value", "dt", "hh"])
    raw = [shape(bronze.from_landing(x, "s", 15), ["snapshot_id", "payload", "source"]) for x in (ours, theirs)]
    assert raw[0] == raw[1]
    times = {os.path.basename(r["source_file"]): r["landed_at"].timestamp() for r in ours.select("source_file", "landed_at").distinct().collect()}
    for name, moment in times.items():
        folder = "hh=10" if name == "a.jsonl" else "hh=11"
        assert abs(os.path.getmtime(f"{root}/dt=2024-01-30/{folder}/{name}") - moment) < 1


def test_a_flat_area_and_foreign_columns(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"symbol":"abcdefgh"}]')
    lines = read_snapshots(spark, str(tmp_path))
    assert [(r["value"], r["dt"], r["hh"]) for r in lines.collect()] == [('{"symbol": "abcdefgh"}', None, None)]
    # A row that nothing stamps goes to the quarantine.
    raw = bronze.from_landing(lines, "s")
    assert [r["reason"] for r in bronze.quarantine(raw).collect()] == ["capture_time_implausible"]
    with pytest.raises(Exception, match="has the columns"):
        spark.read.format("snapshot_files").schema("x string").load(str(tmp_path)).collect()


def opened(reader):
    return sorted(os.path.relpath(r[0], reader.path) for p in reader.partitions() for r in p.ranges)


def test_conditions_choose_the_folders(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2024-01-29", "2024-01-30"):
        for hour in ("00", "10", "23"):
            land(root, "a.jsonl", capture(f"{day}T{hour}:10:00Z", "abcdef"), day, hour)
    at = lambda text: dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    def reader(*conditions, lines=False, **options):
        made = snapshot_files._BatchReader({"path": root, "hourFolders": "true", **options}, lines)
        assert list(made.pushFilters(list(conditions))) == list(conditions)
        return opened(made)

    stamp = ("snapshot_id",)
    assert len(reader()) == 6
    assert reader(GreaterThanOrEqual(stamp, at("2024-01-30T10:10:00"))) == ["dt=2024-01-30/hh=10/a.jsonl", "dt=2024-01-30/hh=23/a.jsonl"]
    assert reader(LessThan(stamp, at("2024-01-29T10:00:00"))) == ["dt=2024-01-29/hh=00/a.jsonl", "dt=2024-01-29/hh=10/a.jsonl"]
    assert reader(EqualTo(stamp, at("2024-01-29T23:10:00"))) == ["dt=2024-01-29/hh=23/a.jsonl"]
    # A slot of a day: a row of 23 h is stamped 0 h.
    assert len(reader(EqualTo(stamp, at("2024-01-29T00:00:00")), slotMinutes="1440")) == 4
    assert len(reader(EqualTo(stamp, at("2024-01-29T23:10:00")), hourFolders="false")) == 6
    assert len(reader(EqualTo(("dt",), dt.date(2024, 1, 30)), lines=True)) == 3
    register(spark)
    load = spark.read.format("snapshot_files").option("hourFolders", "true").load(root)
    recent = load.where(F.col("snapshot_id") > F.lit("2024-01-30 10:00:00").cast("timestamp"))
    assert sorted(str(r["snapshot_id"]) for r in recent.collect()) == ["2024-01-30 10:10:00", "2024-01-30 23:10:00"]
    assert recent.rdd.getNumPartitions() == 1
    assert read_snapshots(spark, root).where("dt = DATE '2024-01-30' AND hh = '10'").count() == 1


def test_folders_out_of_range_are_not_read(spark, tmp_path):
    """A file there that cannot be read does no harm."""
    root = str(tmp_path)
    land(root, "a.jsonl", capture("2024-01-30T10:10:00Z", "abcdef"))
    land(root, "b.json", ["broken"], "2024-01-29", "05")
    os.remove(f"{root}/dt=2024-01-29/hh=05/b.json")
    os.symlink("/nowhere/at/all", f"{root}/dt=2024-01-29/hh=05/b.json")
    assert read_snapshots(spark, root).where("dt = DATE '2024-01-30'").count() == 1


def frame(spark, moment, *symbols):
    return spark.createDataFrame([(s,) for s in symbols], "symbol string").withColumn("at", F.lit(moment).cast("timestamp"))


def test_stream_by_commits_sees_whole_captures_in_order(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    reader = snapshot_files._CommitReader({"path": landing}, True)
    assert reader.latestOffset() == reader.initialOffset() == {"commit": -1}

    def update():
        finish(bronze_stream(bronze.from_landing(stream_snapshots(spark, landing, commits="true"), "s"), out, checkpoint))
        return sorted(json.loads(r["payload"])["symbol"] for r in read_table(spark, out).collect())

    assert write_landing(frame(spark, "2024-01-30 10:00:00", "aaaa", "bbbb"), landing, "at", commit=True) == 0
    assert update() == ["aaaa", "bbbb"]
    # A file that no commit names is not there yet, however old it claims to be.
    land(landing, "stray.jsonl", capture("2024-01-30T10:00:00Z", "stray"))
    assert update() == ["aaaa", "bbbb"]
    assert write_landing(frame(spark, "2024-01-29 10:00:00", "cccc"), landing, "at", commit=True) == 1
    assert write_landing(frame(spark, "2024-01-31 10:00:00", "dddd"), landing, "at", commit=True) == 2
    assert update() == ["aaaa", "bbbb", "cccc", "dddd"]
    assert update() == ["aaaa", "bbbb", "cccc", "dddd"]
    names = [r[0] for p in reader.partitions({"commit": 0}, {"commit": 1}) for r in p.ranges]
    assert len(names) == 1 and "dt=2024-01-29/hh=10" in names[0]
    assert not [n for n in os.listdir(landing) if n.startswith("_staging")]
    # Other readers see the same files, and no commits.
    assert read_landing(spark, landing).count() == 5 and read_snapshots(spark, landing).count() == 5


def test_two_writers_never_share_a_number(spark, tmp_path, monkeypatch):
    landing = str(tmp_path / "in")
    write_landing(frame(spark, "2024-01-30 10:00:00", "aaaa"), landing, "at", commit=True)
    monkeypatch.setattr(landing_area, "_newest_commit", lambda *args: -1)  # a look that came too early
    assert write_landing(frame(spark, "2024-01-30 11:00:00", "bbbb"), landing, "at", commit=True) == 1


def test_the_cost_of_an_offset_does_not_grow_with_the_area(tmp_path, monkeypatch):
    landing = str(tmp_path / "in")

    def commit(number):
        path = f"{landing}/{snapshot_files.commit_path(number)}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as file:
            json.dump({"files": [[f"dt=2024-01-01/hh=00/{number}.txt", 10, 1]]}, file)

    calls = []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def get_file_info(self, asked):
            found = self.inner.get_file_info(asked)
            calls.append(len(found))
            return found

        def open_input_file(self, path):
            calls.append(path)
            return self.inner.open_input_file(path)

    reader = snapshot_files._CommitReader({"path": landing}, True)
    own = reader._open
    monkeypatch.setattr(reader, "_open", lambda: (Counted(own()[0]), own()[1]))
    for number in range(3):
        commit(number)
    assert reader.latestOffset() == {"commit": 2} and len(calls) == 2
    for hour in range(1_000):
        os.makedirs(f"{landing}/dt=2024-01-{hour % 28 + 1:02d}/hh={hour % 24:02d}", exist_ok=True)
    for number in range(3, 2_002):
        commit(number)
    calls.clear()
    assert reader.latestOffset() == {"commit": 2_001}
    assert calls == [3, 2]  # the folders of a thousand commits, and the newest of them
    calls.clear()
    assert len(reader.partitions({"commit": 2_000}, {"commit": 2_001})) == 1 and len(calls) == 1


def test_update_through_the_source_puts_stamps_ahead_aside(spark, tmp_path):
    """As with the built-in source: one wrong stamp does not make all that follows late."""
    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    raw = lambda: bronze.from_landing(stream_snapshots(spark, landing), "s")
    land(landing, "a.jsonl", capture("2099-01-30T10:00:00Z", "x") + capture("2024-01-30T10:00:00Z", "a"))
    medallion.run(spark, landing, layout, "s", "2024-01-30 11:00:00", raw=raw())
    land(landing, "b.jsonl", capture("2024-01-30T11:00:00Z", "a", "b"), hour="11")
    update = medallion.run(spark, landing, layout, "s", "2024-01-30 11:10:00", raw=raw())
    assert typed_keys(spark, layout) == [("A", "2024-01-30 10:00:00"), ("A", "2024-01-30 11:00:00"), ("B", "2024-01-30 11:00:00")]
    assert update.audit.repaired == 0 and update.silver.late_rows == 0
    assert [r["reason"] for r in spark.read.json(layout.table("quarantine")).collect()] == ["capture_time_implausible"]
