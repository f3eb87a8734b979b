"""Closed days of the typed table, packed into few clustered files.

A stream leaves a file for each state task and day at every update, and late rows lie beside them. Once a day is
closed (the watermark has passed its end, so that the stream can add nothing to it), its rows are written again,
clustered by key and time, into a numbered folder of packed days. A manifest, one row a day, tells which folder holds a
day, how far days are packed, and up to which batch late rows are in them. It is stored as a view is: a new
version counts at once or not at all, folders are never written again, so a reader keeps what it has
planned with. Late rows of a packed day stay beside it until the next packing writes that day again.

Beside each packed day lies a digest of its keys: bitmaps with a bit set for each key's hash, about `BITS_A_KEY` bits a key. A
key whose bit is not set is not in the day; so a repair reads the days that may hold one of its keys, and no others. And
beside each lie the states that views need of it, one row a symbol, so a refresh reads rows of changed days only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import KEYS
from ..plans import gold
from ..schemas import PRICE, SILVER
from .tables import BATCH, DAY, _files, current_version, delete_folder, drop_old_versions, exists, read_current, read_table, refresh, stored

LAYOUT = ("dt", *KEYS)
FILE_BYTES = 128 << 20
BITS_A_KEY = 16
# Fixed value: the bits of one bitmap, as Spark's bitmap functions have them.
BITMAP_BITS = 32_768

TYPED = stored(SILVER, DAY)
LATE = stored(SILVER, DAY, BATCH)
FOLDER = T.StructField("n", T.LongType())
MANIFEST = T.StructType(
    [DAY, T.StructField("folder", T.LongType()), T.StructField("through", T.DateType()), T.StructField("late_batch", T.LongType())]
)
STATES = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("low", PRICE),
        T.StructField("high", PRICE),
        T.StructField("close", PRICE),
        T.StructField("close_at", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
        FOLDER,
        DAY,
    ]
)
DIGEST = T.StructType(
    [T.StructField("buckets", T.LongType()), T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType()), FOLDER, DAY]
)


@dataclass(frozen=True)
class DayPaths:
    """Folders of a typed table: the stream's, the late rows', and those of its packed days."""

    live: str
    late: str
    packed: str
    digest: str
    states: str
    manifest: str

    @classmethod
    def of(cls, table: str) -> DayPaths:
        return cls(table, f"{table}_late", f"{table}_packed", f"{table}_digest", f"{table}_states", f"{table}_days")


@dataclass(frozen=True)
class Packed:
    """What the manifest says. No day is packed before the first packing."""

    folders: dict[dt.date, int] = field(default_factory=dict)
    through: dt.date | None = None
    late_batch: int = -1


def packed(spark: SparkSession, paths: DayPaths) -> Packed:
    if current_version(spark, paths.manifest) is None:
        return Packed()
    rows = read_current(spark, paths.manifest, MANIFEST).collect()  # a row a day
    return Packed({r["dt"]: r["folder"] for r in rows if r["folder"] is not None}, rows[0]["through"], rows[0]["late_batch"])


def _day_folder(root: str, number: int, day: dt.date) -> str:
    return f"{root}/n={number:012d}/dt={day.isoformat()}"


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the optimizer leaves out; one made of an empty list starts Python workers."""
    return spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _days_of(spark: SparkSession, root: str, schema: T.StructType, folders: Iterable[tuple[dt.date, int]]) -> DataFrame:
    paths = [_day_folder(root, number, day) for day, number in folders]
    if not paths:
        return _no_rows(spark, schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def typed_rows(
    spark: SparkSession,
    paths: DayPaths,
    since: dt.date | None = None,
    days: Collection[dt.date] | None = None,
    late_rows: Column | None = None,
    packed_days: Collection[dt.date] | None = None,
) -> DataFrame:
    """Each typed row once: packed days from their folders, the others and late rows from where they came.

    With `since` or `days` only those days' folders are listed and read. `late_rows`: a condition on the batch of late rows.
    `packed_days`: of packed days only these are read.
    """
    state = packed(spark, paths)
    wanted = [
        (day, number)
        for day, number in sorted(state.folders.items())
        if (since is None or day >= since) and (days is None or day in days) and (packed_days is None or day in packed_days)
    ]
    rows = read_table(spark, paths.live, TYPED) if exists(spark, paths.live) else _no_rows(spark, TYPED)
    if state.through is not None:
        rows = rows.where(F.col("dt") > F.lit(state.through))
        whole = _days_of(spark, paths.packed, stored(SILVER, FOLDER, DAY), wanted)
        rows = rows.unionByName(whole.drop("n"))
    late = _late(spark, paths, state)
    if late_rows is not None:
        late = late.where(late_rows)
    rows = rows.unionByName(late.drop("batch"))
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    if days is not None:
        rows = rows.where(F.col("dt").isin(sorted(days)))
    return rows


def _late(spark: SparkSession, paths: DayPaths, state: Packed) -> DataFrame:
    """Late rows that are not packed yet."""
    if not exists(spark, paths.late):
        return _no_rows(spark, LATE)
    late = read_table(spark, paths.late, LATE)
    if state.through is None:
        return late
    return late.where((F.col("dt") > F.lit(state.through)) | (F.col("batch") > state.late_batch))


def _names(spark: SparkSession, folder: str, prefix: str) -> dict[str, str]:
    """Path by the value in the name, of the sub-folders named `prefix`=value."""
    files, path = _files(spark, folder)
    if not files.exists(path):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return {n.removeprefix(f"{prefix}="): f"{folder}/{n}" for n in names if n.startswith(f"{prefix}=")}


def _days(spark: SparkSession, folder: str) -> dict[dt.date, str]:
    return {dt.date.fromisoformat(day): path for day, path in _names(spark, folder, "dt").items() if day[0].isdigit()}


def _bytes(spark: SparkSession, folder: str) -> int:
    files, path = _files(spark, folder)
    return files.getContentSummary(path).getLength()


def pack_closed_days(
    spark: SparkSession, paths: DayPaths, watermark: dt.datetime, file_bytes: int = FILE_BYTES
) -> list[dt.date]:
    """Pack the days that end at or before `watermark`, and packed days that got late rows; returns the days written.

    `watermark` must be one that the stream has used. Run it when the stream and the repair of late rows have
    ended; readers need not wait. Files hold about `file_bytes` as stored before, in ranges of (day, key, time). A day
    of no more is one file by one task; a larger one is cut into as many ranges as it fills files.
    """
    state = packed(spark, paths)
    through = watermark.date() - dt.timedelta(days=1)
    if state.through is not None:
        through = max(through, state.through)
    batches = {int(n): path for n, path in _names(spark, paths.late, "batch").items()}
    done = {n: path for n, path in batches.items() if exists(spark, f"{path}/_SUCCESS")}
    late_batch = max(done, default=-1)

    sources: dict[dt.date, list[str]] = {}
    for day, path in _days(spark, paths.live).items():
        if day <= through and (state.through is None or day > state.through):
            sources.setdefault(day, []).append(path)
    for n, folder in done.items():
        # Listed again only while it may hold rows that are not packed yet.
        for day, path in _days(spark, folder).items() if n > state.late_batch or through != state.through else ():
            if day <= through and (n > state.late_batch or state.through is None or day > state.through):
                sources.setdefault(day, []).append(path)
    if not sources:
        if through != state.through or late_batch != state.late_batch:
            _store(spark, paths, Packed(state.folders, through, late_batch))
        return []
    for day in sources.keys() & state.folders.keys():
        sources[day].append(_day_folder(paths.packed, state.folders[day], day))

    sizes = {day: sum(_bytes(spark, path) for path in own) for day, own in sources.items()}
    number = max((int(n) for n in _names(spark, paths.packed, "n")), default=0) + 1
    folder = f"{paths.packed}/n={number:012d}"
    whole = {day for day, size in sizes.items() if size <= file_bytes}
    large = sizes.keys() - whole
    tasks = []
    if whole:
        # Ranges of days alone never cut one; with more ranges asked for than there are days, each day is one.
        rows = typed_rows(spark, paths, days=whole, late_rows=F.col("batch") <= late_batch)
        tasks.append(rows.repartitionByRange(4 * len(whole), "dt"))
    if large:
        rows = typed_rows(spark, paths, days=large, late_rows=F.col("batch") <= late_batch)
        tasks.append(rows.repartitionByRange(-(-sum(sizes[day] for day in large) // file_bytes), *LAYOUT))
    ranges = reduce(DataFrame.unionByName, tasks).sortWithinPartitions(*LAYOUT)
    ranges.write.partitionBy("dt").parquet(folder)
    written = sorted(_days(spark, folder))
    _write_digest(spark, paths, number, folder)
    states = gold.day_states(read_table(spark, folder, TYPED))
    states.repartitionByRange("dt", "symbol").write.partitionBy("dt").parquet(f"{paths.states}/n={number:012d}")
    _store(spark, paths, Packed({**state.folders, **dict.fromkeys(written, number)}, through, late_batch))
    return written


def _store(spark: SparkSession, paths: DayPaths, state: Packed) -> None:
    rows = [(day, number, state.through, state.late_batch) for day, number in sorted(state.folders.items())]
    rows = rows or [(None, None, state.through, state.late_batch)]
    refresh(spark.createDataFrame(rows, MANIFEST).coalesce(1), paths.manifest)


def _slot(buckets: Column) -> Column:
    return F.pmod(F.xxhash64(*KEYS), buckets * BITMAP_BITS)


def _write_digest(spark: SparkSession, paths: DayPaths, number: int, folder: str) -> None:
    keys = read_table(spark, folder, TYPED).select("dt", *KEYS)
    sizes = keys.groupBy("dt").agg(F.ceil(F.count("*") * BITS_A_KEY / BITMAP_BITS).alias("buckets"))
    placed = keys.join(sizes, "dt").withColumn("slot", _slot(F.col("buckets")))
    bitmap = F.bitmap_construct_agg(F.pmod("slot", F.lit(BITMAP_BITS)))
    by_bucket = placed.groupBy("dt", "buckets", F.expr(f"slot DIV {BITMAP_BITS}").alias("bucket")).agg(bitmap.alias("bitmap"))
    by_bucket.repartitionByRange("dt", "bucket").write.partitionBy("dt").parquet(f"{paths.digest}/n={number:012d}")


def days_to_read(spark: SparkSession, paths: DayPaths, rows: DataFrame) -> tuple[set[dt.date], set[dt.date]]:
    """(days of `rows`, those of them that may already hold one of their keys): open days, and packed ones whose digest does not rule it out.

    rows: with dt and the key. Late rows that are not packed yet are in no digest.
    """
    state = packed(spark, paths)
    days = {r["dt"] for r in rows.select("dt").distinct().collect()}  # at most a row for each day there is
    closed = {day: state.folders[day] for day in days & state.folders.keys()}
    open_ = {day for day in days if state.through is None or day > state.through}
    if not closed:
        return days, open_
    digests = _days_of(spark, paths.digest, DIGEST, sorted(closed.items()))
    sizes = digests.select("dt", "buckets").distinct()
    asked = rows.select("dt", *KEYS).join(sizes, "dt").withColumn("slot", _slot(F.col("buckets")))
    asked = asked.select("dt", F.expr(f"slot DIV {BITMAP_BITS}").alias("bucket"), F.pmod("slot", F.lit(BITMAP_BITS)).alias("bit"))
    byte = F.conv(F.hex(F.expr("substring(bitmap, CAST(bit DIV 8 + 1 AS INT), 1)")), 16, 10).cast("long")
    held = asked.join(digests.select("dt", "bucket", "bitmap"), ["dt", "bucket"]).where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
    return days, open_ | {r["dt"] for r in held.select("dt").distinct().collect()}


def known_keys(spark: SparkSession, paths: DayPaths, rows: DataFrame, batch: int) -> DataFrame:
    """Keys that the table has, of all days that may hold one of `rows`; without late rows of `batch`."""
    days, read = days_to_read(spark, paths, rows)
    whole = typed_rows(spark, paths, days=read, late_rows=F.lit(False)).select(*KEYS)
    late = _late(spark, paths, packed(spark, paths)).where((F.col("batch") != batch) & F.col("dt").isin(sorted(days)))
    return whole.unionByName(late.select(*KEYS))


def states_within(spark: SparkSession, paths: DayPaths, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """One state per symbol and day of the rows with `start` <= time <= `end` (UTC).

    Whole packed days come from their stored states, a row a symbol; rows are read of the days that `start` and `end`
    cut, of days that are not packed yet, and of late rows beside packed ones.
    """
    state = packed(spark, paths)
    midnight = lambda day: dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc)
    start, end = (t.replace(tzinfo=dt.timezone.utc) if t.tzinfo is None else t.astimezone(dt.timezone.utc) for t in (start, end))
    whole = {d: n for d, n in state.folders.items() if midnight(d) >= start and midnight(d + dt.timedelta(days=1)) <= end}
    cut = [d for d in state.folders if start.date() <= d <= end.date() and d not in whole]
    rows = typed_rows(spark, paths, since=start.date(), packed_days=cut)
    at = F.col("observed_at")
    fresh = gold.day_states(rows.where((at >= F.lit(start)) & (at <= F.lit(end)) & (F.col("dt") <= F.lit(end.date()))))
    stored_states = _days_of(spark, paths.states, STATES, sorted(whole.items())).select(*fresh.columns)
    return gold.merged_states(stored_states.unionByName(fresh))


def tidy(spark: SparkSession, paths: DayPaths, keep: int = 96) -> None:
    """Delete what no reader of the newest `keep` manifests needs: replaced folders, and the files packed days were made of.

    The stream's own log goes on naming deleted files; readers ask for later days only, so they do not meet them.
    """
    versions = sorted(_names(spark, paths.manifest, "v"))
    kept = [read_table(spark, f"{paths.manifest}/v={v}", MANIFEST) for v in versions[-keep:] if exists(spark, f"{paths.manifest}/v={v}/_SUCCESS")]
    if not kept:
        return
    rows = [r for frame in kept for r in frame.collect()]
    used = {r["folder"] for r in rows}
    through = min(r["through"] for r in rows)
    late_batch = min(r["late_batch"] for r in rows)
    for root in (paths.packed, paths.digest, paths.states):
        for number, folder in _names(spark, root, "n").items():
            if int(number) not in used and int(number) < max((u for u in used if u is not None), default=0):
                delete_folder(spark, folder)
    for day, folder in _days(spark, paths.live).items():
        if day <= through:
            delete_folder(spark, folder)
    for n, batch in _names(spark, paths.late, "batch").items():
        if int(n) <= late_batch:
            for day, folder in _days(spark, batch).items():
                if day <= through:
                    delete_folder(spark, folder)
    drop_old_versions(spark, paths.manifest, keep)
