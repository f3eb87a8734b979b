"""`spark.read.format("snapshot_files")`: landed captures as a Python data source.

The built-in file sources in `landing` are the fast path. This one offers the
same rows by short name with a declared schema, in batch and as a stream, for
landing areas that also hold whole responses (.json files with a list of
objects) beside JSON lines.

Options: path; source (text put on every row); slotMinutes (cut capture times to
a slot); splitBytes (work per task); settleSeconds (a stream leaves files younger
than this for its next batch); hourFolders (see below); commits (see below). A .json
file is read as a whole by one task.

It has two schemas. By default rows have the declared capture schema, stamped by the
source itself; a row without any stamp is refused, as the schema has no NULL. With
`.schema(LINES)` they are lines with their folder, file and the file's time, as
`landing.read_landing` gives them: they travel as Arrow, nothing is parsed in Python, and
the JVM stamps and judges them. `read_snapshots` and `stream_snapshots` do that.

Filters: conditions on dt and hh of LINES, and on snapshot_id if `hourFolders` says that each
row lies in the folder of its capture's hour, as `write_landing` puts it, choose the
folders that are listed and read at all. Spark applies the condition again.

A stream goes forward by (modification time, path), so a file must not appear with
a time before those already read. Where times are coarse or files become visible
some time after they are stamped, set settleSeconds above that delay. With `commits` it
goes forward by the numbered commits that `write_landing(..., commit=True)` leaves
instead: a batch reads the commits' own lists of files, so what it costs depends on what is new, not
on what the area holds, and no file is lost by coming into sight late.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import re
import sys
import time
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

NAME = "snapshot_files"
BATCH_ROWS = 10_000
READ_BYTES = 4 << 20
# Commits lie in folders of so many, so two listings find the newest.
COMMITS, COMMITS_A_FOLDER = "_commits", 1_000
HOUR = dt.timedelta(hours=1)
_COMPARISONS = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
LINES = StructType(
    [
        StructField("value", StringType()),
        StructField("dt", DateType()),
        StructField("hh", StringType()),
        StructField("source_file", StringType()),
        StructField("landed_at", TimestampType()),
    ]
)
ROWS = pa.schema(
    [
        pa.field("snapshot_id", pa.timestamp("us", tz="UTC"), nullable=False),
        pa.field("payload", pa.string(), nullable=False),
        pa.field("source", pa.string(), nullable=False),
    ]
)


def register(spark: SparkSession) -> None:
    # Sent to the workers by value, so they need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SnapshotFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_snapshots(spark: SparkSession, path: str, **options) -> DataFrame:
    """Landed lines as `landing.read_landing` gives them, whole responses (.json) too; conditions on dt and hh choose folders."""
    register(spark)
    return spark.read.format(NAME).schema(LINES).options(**options).load(path)


def stream_snapshots(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same as a stream, by file times or by commits."""
    register(spark)
    return spark.readStream.format(NAME).schema(LINES).options(**options).load(path)


def commit_path(number: int) -> str:
    return f"{COMMITS}/{number // COMMITS_A_FOLDER:06d}/{number:012d}.json"


class SnapshotFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return StructType(
            [
                StructField("snapshot_id", TimestampType(), False),
                StructField("payload", StringType(), False),
                StructField("source", StringType(), False),
            ]
        )

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(self.options, self._lines(schema))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        by_commit = str(self.options.get("commits", "false")).lower() == "true"
        return (_CommitReader if by_commit else _StreamReader)(self.options, self._lines(schema))

    def _lines(self, schema: StructType) -> bool:
        if schema.names == LINES.names:
            return True
        if schema.names == self.schema().names:
            return False
        raise ValueError(f"{NAME} has the columns {self.schema().names} or {LINES.names}, not {schema.names}")


class _Ranges(InputPartition):
    """Byte ranges (path, start, end, modified) that one task reads."""

    def __init__(self, ranges: list[tuple[str, int, int, int]]):
        self.ranges = ranges


class _Files:
    """Listing and reading shared by the readers."""

    def __init__(self, options, lines: bool = False):
        self.path = options["path"]
        self.source = options.get("source", NAME)
        self.slot = int(options.get("slotMinutes", 0)) * 60
        self.split_bytes = int(options.get("splitBytes", 64 << 20))
        self.settle_ns = int(float(options.get("settleSeconds", 0)) * 1e9)
        self.hour_folders = str(options.get("hourFolders", "false")).lower() == "true"
        self.lines = lines
        # The first and last hour folder to look into, if a condition says so.
        self.first_hour: dt.datetime | None = None
        self.last_hour: dt.datetime | None = None

    def _open(self):
        if re.match(r"^[a-z][a-z0-9+.-]*://", self.path):
            return pafs.FileSystem.from_uri(self.path)
        local = self.path.removeprefix("file:")
        return pafs.LocalFileSystem(), local

    def _listing(self) -> list[tuple[int, str, int]]:
        """(modified, path, size) of all complete files in the folders asked for, oldest first."""
        filesystem, root = self._open()
        whole = self.first_hour is None and self.last_hour is None
        return sorted(self._found(filesystem, root, whole, None))

    def _found(self, filesystem, folder: str, whole: bool, day: dt.datetime | None) -> Iterator[tuple[int, str, int]]:
        """Files below `folder`. Unless it is taken whole, day and hour folders out of range are not entered."""
        for info in filesystem.get_file_info(pafs.FileSelector(folder, recursive=whole)):
            parts = info.path[len(folder) :].strip("/").split("/")
            if any(p.startswith(("_", ".")) for p in parts):
                continue
            if info.type == pafs.FileType.File:
                if info.size:
                    yield info.mtime_ns, info.path, info.size
            elif not whole:
                own_day, begin, hours = _folder_time(parts[-1], day)
                if begin is None or self._in_range(begin, hours):
                    # Only a day may be in range in part.
                    yield from self._found(filesystem, info.path, begin is not None and hours == 1, own_day)

    def _in_range(self, begin: dt.datetime, hours: int) -> bool:
        last = begin + (hours - 1) * HOUR
        return (self.first_hour is None or last >= self.first_hour) and (self.last_hour is None or begin <= self.last_hour)

    def _split(self, files: list[tuple[int, str, int]]) -> list[InputPartition]:
        """Cut large line files, and pack small ones, to about `split_bytes` per task."""
        tasks: list[InputPartition] = []
        current: list[tuple[str, int, int, int]] = []
        filled = 0
        for modified, path, size in files:
            step = size if path.endswith(".json") else self.split_bytes
            for start in range(0, size, step):
                end = min(start + step, size)
                if current and filled + end - start > self.split_bytes:
                    tasks.append(_Ranges(current))
                    current, filled = [], 0
                current.append((path, start, end, modified))
                filled += end - start
        if current:
            tasks.append(_Ranges(current))
        return tasks

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        return self._read_lines(partition) if self.lines else self._read_rows(partition)

    def _read_lines(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        filesystem, _ = self._open()
        for path, start, end, modified in partition.ranges:
            day, hour = _folder_of(path)
            with io.BufferedReader(filesystem.open_input_file(path), READ_BYTES) as file:
                for values in _values(file, path, start, end):
                    n = len(values)
                    columns = [
                        values,
                        pa.array([day] * n, pa.date32()),
                        pa.array([hour] * n, pa.string()),
                        pa.array([path] * n, pa.string()),
                        pa.array([modified // 1000] * n, pa.timestamp("us", tz="UTC")),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=LINES.names)

    def _read_rows(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        filesystem, _ = self._open()
        stamps: list[dt.datetime] = []
        payloads: list[str] = []
        for path, start, end, _ in partition.ranges:
            with io.BufferedReader(filesystem.open_input_file(path), 1 << 20) as file:
                for payload, row in _payloads(file, path, start, end):
                    stamps.append(_capture_time(row, path, self.slot))
                    payloads.append(payload)
                    if len(payloads) == BATCH_ROWS:
                        yield self._batch(stamps, payloads)
                        stamps, payloads = [], []
        if payloads:
            yield self._batch(stamps, payloads)

    def _batch(self, stamps, payloads) -> pa.RecordBatch:
        source = pa.array([self.source] * len(payloads), pa.string())
        columns = [pa.array(stamps, ROWS.field(0).type), pa.array(payloads, pa.string()), source]
        return pa.record_batch(columns, schema=ROWS)


class _BatchReader(_Files, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrow the folders to those that conditions allow. Every condition is left for Spark to apply."""
        for condition in filters:
            if not isinstance(condition, _COMPARISONS):
                continue
            column = condition.attribute
            if column == ("dt",) and self.lines:
                self._narrow(condition, _midnight(condition.value), 24)
            elif column == ("snapshot_id",) and self.hour_folders and not self.lines:
                moment = condition.value
                moment = moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)
                self._narrow(condition, moment.replace(minute=0, second=0, microsecond=0), 1)
        return filters

    def _narrow(self, condition: Filter, begin: dt.datetime, hours: int) -> None:
        """begin: the first of the `hours` folders that the condition's value lies in."""
        # A capture time cut to a slot may be that of a later hour's row.
        last = begin + (hours - 1) * HOUR + dt.timedelta(seconds=self.slot)
        if isinstance(condition, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            self.first_hour = max(self.first_hour or begin, begin)
        if isinstance(condition, (EqualTo, LessThan, LessThanOrEqual)):
            self.last_hour = min(self.last_hour or last, last)

    def partitions(self) -> list[InputPartition]:
        # Spark asks for at least one partition, also of an empty folder.
        return self._split(self._listing()) or [_Ranges([])]


class _StreamReader(_Files, DataSourceStreamReader):
    """Offsets name the last file read, so a replayed batch reads the same files."""

    def initialOffset(self) -> dict:
        return {"modified": 0, "path": ""}

    def latestOffset(self) -> dict:
        horizon = time.time_ns() - self.settle_ns
        settled = [f for f in self._listing() if f[0] <= horizon]
        if not settled:
            return self.initialOffset()
        return {"modified": settled[-1][0], "path": settled[-1][1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = ((o["modified"], o["path"]) for o in (start, end))
        return self._split([f for f in self._listing() if low < f[:2] <= high])

    def commit(self, end: dict) -> None:
        """Files stay where they are; the checkpoint alone remembers progress."""


class _CommitReader(_Files, DataSourceStreamReader):
    """Offsets are numbers of commits. Neither the area nor the list of older commits is gone through."""

    def initialOffset(self) -> dict:
        return {"commit": -1}

    def latestOffset(self) -> dict:
        filesystem, root = self._open()
        newest = f"{root}/{COMMITS}"
        for _ in range(2):  # the newest folder, and in it the newest commit
            found = filesystem.get_file_info(pafs.FileSelector(newest, allow_not_found=True))
            names = [i.path for i in found if not i.base_name.startswith((".", "_"))]
            if not names:
                return self.initialOffset()
            newest = max(names)
        return {"commit": int(newest.rsplit("/", 1)[1].removesuffix(".json"))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        filesystem, root = self._open()
        files: list[tuple[int, str, int]] = []
        for number in range(start["commit"] + 1, end["commit"] + 1):
            with filesystem.open_input_file(f"{root}/{commit_path(number)}") as file:
                files += [(modified, f"{root}/{name}", size) for name, size, modified in json.loads(file.read())["files"]]
        return self._split(files)

    def commit(self, end: dict) -> None:
        """Commits stay where they are; the checkpoint alone remembers progress."""


def _midnight(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc)


def _folder_time(name: str, day: dt.datetime | None) -> tuple[dt.datetime | None, dt.datetime | None, int]:
    """(day, first hour, hours) that a folder's name stands for; no hour if it is neither a day nor an hour of `day`."""
    found = re.fullmatch(r"dt=(\d{4})-(\d{2})-(\d{2})", name)
    if found:
        own = dt.datetime(*map(int, found.groups()), tzinfo=dt.timezone.utc)
        return own, own, 24
    found = re.fullmatch(r"hh=(\d{2})", name)
    if found and day:
        return day, day + int(found[1]) * HOUR, 1
    return day, None, 0


def _folder_of(path: str) -> tuple[dt.date | None, str | None]:
    found = re.search(r"dt=(\d{4}-\d{2}-\d{2})/hh=(\d{2})/", path)
    return (dt.date.fromisoformat(found[1]), found[2]) if found else (None, None)


def _values(file, path: str, start: int, end: int) -> Iterator[pa.Array]:
    """The texts of the rows that begin inside the range, many at a time."""
    if path.endswith(".json"):
        yield _texts([payload.encode() for payload, _ in _payloads(file, path, start, end)])
        return
    if start:
        # A line that begins before the range belongs to the previous one.
        file.seek(start - 1)
        file.readline()
    while file.tell() < end:
        # Whole lines only: what is read ends with a line.
        block = file.read(min(READ_BYTES, end - file.tell()))
        block += file.readline() if not block.endswith(b"\n") else b""
        yield _texts([line for x in block.split(b"\n") if (line := x.rstrip(b"\r"))])


def _texts(lines: list[bytes]) -> pa.Array:
    try:
        return pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())


def _payloads(file, path: str, start: int, end: int) -> Iterator[tuple[str, object]]:
    """(payload text, parsed object or None) of the rows that begin inside the range."""
    if path.endswith(".json"):
        # A whole response: a list of objects, or one object. One that cannot be read is one row, for the quarantine.
        text = file.read().decode("utf-8", "replace")
        try:
            found = json.loads(text)
        except ValueError:
            yield text, None
            return
        for row in found if isinstance(found, list) else [found]:
            yield json.dumps(row, ensure_ascii=False), row
        return
    if start:
        # A line that begins before the range belongs to the previous one.
        file.seek(start - 1)
        file.readline()
    while file.tell() < end:
        line = file.readline()
        if not line:
            return
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if text:
            try:
                yield text, json.loads(text)
            except ValueError:
                yield text, None


def _capture_time(row: object, path: str, slot_seconds: int) -> dt.datetime:
    """The row's own stamp, else its dt=/hh= directory; never the clock."""
    stamp = row.get("_ingestion_ts") if isinstance(row, dict) else None
    try:
        moment = dt.datetime.fromisoformat(stamp)
    except (TypeError, ValueError):
        day = re.search(r"dt=(\d{4}-\d{2}-\d{2})/hh=(\d{2})/", path)
        if not day:
            raise ValueError(f"no capture time in row or path: {path}") from None
        moment = dt.datetime.fromisoformat(f"{day[1]}T{day[2]}:00:00")
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    if slot_seconds:
        epoch = moment.timestamp() // slot_seconds * slot_seconds
        moment = dt.datetime.fromtimestamp(epoch, dt.timezone.utc)
    return moment
