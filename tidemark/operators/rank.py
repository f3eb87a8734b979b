"""Global RANK() without sending every row through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def rank_descending(
    df: DataFrame,
    value: str,
    name: str,
    slices: int | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Add RANK() OVER (ORDER BY value DESC NULLS LAST) as BIGINT column `name`.

    The input is written once, so every step below sees the same rows. Ranks are
    found per distinct value: values are counted, cut into ranges, and a value's
    rank is one plus the rows in higher ranges plus the rows with higher values
    in its own range. Equal values are one row by then, so ties cannot overload a
    range. What is written lies in `staging`, for the caller to delete.
    """
    rows = settle(df, "rank-rows", staging)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranks = settle(_value_ranks(rows, value, slices, staging), "rank-values", staging)

    # Fewer than `slices` values can each hold more than a 1/slices share of the
    # rows, so this side is bounded whatever the data; the others join by shuffle.
    heavy_value = F.col("_rows") * slices > F.col("_total")
    heavy = ranks.where(heavy_value).select(
        F.col("_value").alias("_heavy_value"), F.col("_rank").alias("_heavy_rank")
    )
    marked = rows.join(F.broadcast(heavy), F.col(value).eqNullSafe(F.col("_heavy_value")), "left")
    by_broadcast = marked.where("_heavy_rank IS NOT NULL").select(
        *rows.columns, F.col("_heavy_rank").alias(name)
    )
    light = ranks.where(~heavy_value).select("_value", "_rank")
    by_shuffle = (
        marked.where("_heavy_rank IS NULL")
        .join(light, F.col(value).eqNullSafe(F.col("_value")))
        .select(*rows.columns, F.col("_rank").alias(name))
    )
    return by_broadcast.unionAll(by_shuffle)


def _value_ranks(rows: DataFrame, value: str, slices: int, staging: str | None) -> DataFrame:
    """(_value, _rows, _total, _rank) for every distinct value; _total counts all rows."""
    counts = rows.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    descending = F.col("_value").desc_nulls_last()
    # The range bounds come from a sample; written down, they hold for all readers.
    sliced = settle(
        counts.repartitionByRange(slices, descending).withColumn("_slice", F.spark_partition_id()),
        "rank-slices",
        staging,
    )
    # One row per slice: `slices` rows at most.
    above = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum("_rows").alias("_slice_rows"))
        .select(
            "_slice",
            F.sum("_slice_rows").over(Window.partitionBy()).alias("_total"),
            F.coalesce(F.sum("_slice_rows").over(above), F.lit(0)).alias("_before"),
        )
    )
    higher = (
        Window.partitionBy("_slice").orderBy(descending).rowsBetween(Window.unboundedPreceding, -1)
    )
    return sliced.join(F.broadcast(offsets), "_slice").select(
        "_value",
        "_rows",
        "_total",
        (F.lit(1) + F.col("_before") + F.coalesce(F.sum("_rows").over(higher), F.lit(0))).alias("_rank"),
    )
