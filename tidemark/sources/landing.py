"""The landing area: JSON lines under dt=YYYY-MM-DD/hh=HH, one object per line."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_utc, slot, to_payload
from .snapshot_files import COMMITS, commit_path
from .tables import _files

STAMP_KEY = "_ingestion_ts"
MAX_FILE_AGE = "36500d"
LANDING = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("dt", T.DateType()),
        T.StructField("hh", T.StringType()),
    ]
)


def write_landing(rows: DataFrame, path: str, captured_at: str, mode: str = "append", commit: bool = False) -> int | None:
    """Land rows as JSON lines stamped with their capture time.

    With `commit` the files are written aside, moved into place, and then named in the next numbered commit, all
    or nothing; its number is returned. A stream by commits sees them from then on (`snapshot_files`).

    Each task takes a range of hours, so a task opens few files and an hour is
    spread over few tasks. Ranges go on by input split, so an hour with a third
    of all rows is shared out too. The number of ranges is set, as opening files
    dominates and adaptive execution would merge small amounts into one task.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stamp = F.col(captured_at)
    columns = [c for c in rows.columns if c != captured_at]
    placed = rows.select(
        "*",
        F.to_date(stamp).alias("_dt"),
        F.date_format(stamp, "HH").alias("_hh"),
        F.spark_partition_id().alias("_split"),
    ).repartitionByRange(ranges, "_dt", "_hh", "_split")
    # Text is made after the shuffle: ranges are sampled first, and columns are smaller.
    aside = f"{path}/_staging-{uuid.uuid4().hex}"
    (
        placed.select(
            to_payload([*columns, iso_utc(stamp).alias(STAMP_KEY)]).alias("value"),
            F.col("_dt").alias("dt"),
            F.col("_hh").alias("hh"),
        )
        .write.mode(mode)
        .partitionBy("dt", "hh")
        .text(aside if commit else path)
    )
    return _publish(rows.sparkSession, path, aside) if commit else None


def _publish(spark: SparkSession, path: str, aside: str) -> int:
    """Move the files under `aside` into the area, and name them in a commit.

    A commit is a file that is created or not; two writers cannot take one number on a store that refuses to create a
    file twice. Files that were moved by a writer that died belong to no commit.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files, folder = _files(spark, aside)
    root = files.makeQualified(hadoop.Path(path)).toString()
    listed, moved = files.listFiles(folder, True), []
    while listed.hasNext():
        found = listed.next()
        name = found.getPath().toString()[len(files.makeQualified(folder).toString()) + 1 :]
        if name.startswith(("_", ".")) or "/_" in name or "/." in name:
            continue
        target = hadoop.Path(f"{root}/{name}")
        files.mkdirs(target.getParent())
        if not files.rename(found.getPath(), target):
            raise OSError(f"could not move {name} into {path}")
        moved.append((name, found.getLen(), found.getModificationTime() * 1_000_000))
    files.delete(folder, True)
    text = json.dumps({"files": moved}).encode()
    number = _newest_commit(files, hadoop, root) + 1
    while True:
        target = hadoop.Path(f"{root}/{commit_path(number)}")
        try:
            out = files.create(target, False)
        except Py4JJavaError:
            if not files.exists(target):
                raise
            number += 1  # another writer was first
            continue
        out.write(text)
        out.close()
        return number


def _newest_commit(files, hadoop, root: str) -> int:
    newest = hadoop.Path(f"{root}/{COMMITS}")
    for _ in range(2):
        if not files.exists(newest):
            return -1
        names = [s.getPath() for s in files.listStatus(newest) if not s.getPath().getName().startswith((".", "_"))]
        if not names:
            return -1
        newest = max(names, key=lambda p: p.getName())
    return int(newest.getName().removesuffix(".json"))


def write_dead_letters(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """Rejected rows as JSON lines."""
    rejects.write.mode(mode).json(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed lines as (value, dt, hh, source_file, landed_at); dt and hh prune directories.

    The area must have the folders dt= and hh=; a flat one is refused by Spark's reader.
    """
    return _with_origin(spark.read.schema(LANDING).text(path))


def stream_landing(
    spark: SparkSession, path: str, max_files: int | None = None, max_age: str = MAX_FILE_AGE
) -> DataFrame:
    """The same as a stream: each landed file is read once, oldest modification first.

    Files modified more than `max_age` before the newest are passed over by Spark. The default is
    beyond any gap, as copies that keep old times are common. The memory of files seen lasts as long.
    """
    reader = spark.readStream.schema(LANDING).option("maxFileAge", max_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_origin(reader.text(path))


def _with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        "dt",
        "hh",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def capture_time(slot_minutes: int | None = None) -> Column:
    """When a landed line was captured: its own stamp, else its dt/hh directory.

    The time is data, so reading a file again gives the same snapshot. A slot
    width joins re-runs of one scheduled capture into one snapshot.
    """
    stamped = F.get_json_object("value", f"$.{STAMP_KEY}").try_cast("timestamp")
    by_directory = F.try_to_timestamp(
        F.concat_ws(" ", F.col("dt").cast("string"), F.col("hh")), F.lit("yyyy-MM-dd HH")
    )
    moment = F.coalesce(stamped, by_directory)
    return slot(moment, slot_minutes) if slot_minutes else moment
