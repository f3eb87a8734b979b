"""Stored tables: Parquet folders, day-partitioned and clustered by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

DAY = StructField("dt", DateType())
# A table's files stay readable however old they are when a stream comes to them.
MAX_FILE_AGE = "36500d"
VERDICT = StructField("verdict", StringType())
BATCH = StructField("batch", LongType())


def stored(schema: StructType, *partitions: StructField) -> StructType:
    """A table schema as stored: nullable, with its partition columns."""
    return StructType(
        [StructField(f.name, f.dataType) for f in schema.fields] + list(partitions)
    )


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder, whatever store it is on."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _files(spark, path)
    return files.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this package has written, if it is there."""
    files, folder = _files(spark, path)
    files.delete(folder, True)


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """A stored table as a stream of its new files."""
    reader = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append whatever is available now, exactly once, then stop.

    A checkpoint keeps the number of state partitions of its first start;
    `state_partitions` sets it for this stream alone.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if state_partitions is None:
        return writer.start()
    # A stream copies its session's settings when it starts. No other query of the session may be planned
    # at that moment: it would see this number too.
    settings, name = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = settings.get(name)
    settings.set(name, str(state_partitions))
    try:
        return writer.start()
    finally:
        settings.set(name, before)


def clustered(df: DataFrame, key: str = "symbol", ts: str = "observed_at") -> DataFrame:
    """Rows with their day, in tasks that hold narrow ranges of (day, key, time).

    Ranges include the time, so one key with a third of all rows still spreads
    over many tasks, and file statistics serve filters on either column.
    """
    layout = ("dt", key, ts)
    return df.withColumn("dt", F.to_date(ts)).repartitionByRange(*layout).sortWithinPartitions(*layout)


def write_clustered(df: DataFrame, path: str, mode: str = "errorifexists", **columns: str) -> None:
    """Write day folders of clustered files."""
    clustered(df, **columns).write.mode(mode).partitionBy("dt").parquet(path)


def save_clustered_table(df: DataFrame, name: str, key: str = "symbol", **columns: str) -> None:
    """The same as a catalogue table that also declares its clustering column."""
    clustered(df, key, **columns).write.clusterBy(key).format("parquet").saveAsTable(name)


# A view's contents live in numbered folders. A folder counts once Spark has put
# _SUCCESS in it, so readers see the old contents or the new, never a mixture.


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, complete) of the version folders."""
    files, folder = _files(spark, root)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return [
        (int(n[2:]), files.exists(_files(spark, f"{root}/{n}/_SUCCESS")[1])) for n in names if n.startswith("v=")
    ]


def _version_path(root: str, number: int) -> str:
    return f"{root}/v={number:012d}"


def current_version(spark: SparkSession, root: str) -> int | None:
    return max((number for number, complete in _versions(spark, root) if complete), default=None)


def refresh(df: DataFrame, root: str) -> int:
    """Recompute a view: write the next version. Let one refresher at a time do so: on a store
    without atomic folder creation two could take the same number.
    """
    spark = df.sparkSession
    number = max((n for n, _ in _versions(spark, root)), default=0) + 1
    df.write.mode("errorifexists").parquet(_version_path(root, number))
    return number


def read_current(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    number = current_version(spark, root)
    if number is None:
        raise FileNotFoundError(f"no complete version under {root}")
    return read_table(spark, _version_path(root, number), schema)


def drop_old_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Keep the newest `keep` complete versions, for readers still on an older one.

    Incomplete ones older than the newest complete one are of refreshes that died: they go too.
    """
    versions = _versions(spark, root)
    complete = sorted(n for n, done in versions if done)
    died = [n for n, done in versions if not done and complete and n < complete[-1]]
    for number in [*died, *complete[: -max(keep, 1)]]:
        delete_folder(spark, _version_path(root, number))
