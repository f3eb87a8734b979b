"""The value a key had some time earlier, found in ranges of (key, time).

Facts and the times asked for are put in one order by a range partitioning, so a key with any share of the rows, in an hour or
in all, is cut into as many ranges as its rows need. Each task walks its range once and carries the last fact
along. What a range cannot tell (a key's facts may lie in ranges before) is told by the ranges' ends: one row a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

FACT, PROBE, END = 0, 1, 2
_IN = ("key", "at", "kind", "value", "ts", "now")


def value_before(
    df: DataFrame,
    name: str,
    lag_seconds: int = 86_400,
    key: str = "symbol",
    ts: str = "observed_at",
    value: str = "price_usd",
) -> DataFrame:
    """(key, ts, value, name): the key's last value at or before `ts - lag`.

    Equal to LAST_VALUE over RANGE BETWEEN UNBOUNDED PRECEDING AND lag PRECEDING; a known NULL is a value. Rows
    must be unique per (key, ts), with neither NULL. What the ranges found is stored in the session's shared folder.
    """
    types = dict(df.dtypes)
    micros = F.unix_micros(ts)
    none = F.lit(None)
    entry = lambda kind, at, fact: F.struct(F.lit(kind).alias("kind"), at.alias("at"), fact.alias("value"))
    both = df.select(
        F.col(key).alias("key"),
        F.col(ts).alias("ts"),
        F.col(value).alias("now"),
        F.inline(F.array(entry(FACT, micros, F.col(value)), entry(PROBE, micros - lag_seconds * 1_000_000, none.cast(types[value])))),
    ).select(*_IN)

    schema = f"part int, kind int, key {types[key]}, ts {types[ts]}, now {types[value]}, known boolean, found {types[value]}"
    order = ("key", "at", "kind")
    walked = both.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_walk, schema)
    told = settle(walked, "values-before")
    ends = told.where(F.col("kind") == END).select("part", "key", "known", "found")
    asked = told.where(F.col("kind") == PROBE)

    # A key that a range begins with goes on from ranges that end with it; the last one with a fact decides.
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    fact = F.when(F.col("known"), F.struct(F.col("found").alias("v")))
    opened = asked.where("NOT known").select("part", "key").distinct().withColumns({"known": F.lit(False), "found": F.lit(None).cast(types[value])})
    # Of a range's own end and its opening, both with one part, only ends before count.
    marks = ends.withColumn("is_end", F.lit(1)).unionByName(opened.withColumn("is_end", F.lit(0)))
    by_part = marks.groupBy("part", "key").agg(F.max(F.struct("is_end", "known", "found")).alias("end"))
    by_part = by_part.select("part", "key", F.col("end.known").alias("known"), F.col("end.found").alias("found"))
    carried = settle(by_part.withColumn("carried", F.last(fact, ignorenulls=True).over(earlier)).select("part", "key", "carried"), "ends")
    joined = asked.join(carried.where("carried IS NOT NULL"), ["part", "key"], "left")
    result = F.when(F.col("known"), F.col("found")).otherwise(F.col("carried.v"))
    return joined.select(F.col("key").alias(key), F.col("ts").alias(ts), F.col("now").alias(value), result.alias(name))


def _walk(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The probes of a range, in order, each with the last fact of its key before it in the range; then the range's end."""
    part, held = TaskContext.get().partitionId(), None  # held: the last row that a next batch may need
    for batch in source:
        if not batch.num_rows:
            continue
        # The last fact of the batch before stands in front, or a row of its key without one.
        rows = pa.Table.from_batches([batch]).select(_IN)
        rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
        keys, kinds = rows.column("key"), rows.column("kind").to_numpy()
        n = rows.num_rows
        new = np.concatenate([[True], pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False).astype(bool)])
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        last = np.maximum.accumulate(np.where(kinds == FACT, np.arange(n), -1))
        known = last >= begin
        own = np.flatnonzero(kinds == PROBE)
        yield _told(part, PROBE, rows.take(pa.array(own)), known[own], rows.column("value").take(pa.array(last[own], mask=~known[own])))
        at = last[-1] if known[-1] else n - 1
        held = rows.slice(int(at), 1)
        if not known[-1]:
            field = held.schema.field("kind")
            held = held.set_column(held.schema.get_field_index("kind"), field, pa.array([END], field.type))
    if held is not None:
        yield _told(part, END, held, held.column("kind").to_numpy() == FACT, held.column("value"))


def _told(part: int, kind: int, rows: pa.Table, known: np.ndarray, found: pa.ChunkedArray) -> pa.RecordBatch:
    n = rows.num_rows
    columns = [pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.int32())]
    columns += [*(rows.column(c) for c in ("key", "ts", "now")), pa.array(known, pa.bool_()), found]
    table = pa.table(columns, names=["part", "kind", "key", "ts", "now", "known", "found"]).combine_chunks()
    return (table.to_batches() or [pa.RecordBatch.from_pylist([], schema=table.schema)])[0]
