"""Table schemas and the list of payload fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
MONEY = T.DecimalType(20, 2)


@dataclass(frozen=True)
class PayloadField:
    """One typed column read from the JSON payload."""

    column: str
    key: str
    type: T.DataType
    upper: bool = False


# JSON keys, output names and types of the typed layer.
PAYLOAD_FIELDS = (
    PayloadField("symbol", "symbol", T.StringType(), upper=True),
    PayloadField("name", "name", T.StringType()),
    PayloadField("price_usd", "current_price", PRICE),
    PayloadField("volume_24h_usd", "total_volume", MONEY),
    PayloadField("market_cap_usd", "market_cap", MONEY),
    PayloadField("pct_change_1h", "price_change_percentage_1h_in_currency", T.DoubleType()),
    PayloadField("pct_change_24h", "price_change_percentage_24h", T.DoubleType()),
    PayloadField("pct_change_7d", "price_change_percentage_7d_in_currency", T.DoubleType()),
)

# A field the layer does not read by default; pass it to `silver.typed` to add it.
CIRCULATING_SUPPLY = PayloadField("circulating_supply", "circulating_supply", T.DecimalType(20, 2))

BRONZE = T.StructType(
    [
        T.StructField("snapshot_id", T.TimestampType(), False),
        T.StructField("payload", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
    ]
)

# What the stored raw table has besides: where a row came from, when its file landed, unasked-for fields.
LINEAGE = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("_rescued_data", T.StringType()),
    ]
)

BRONZE_LINEAGE = T.StructType(
    [
        T.StructField("_ingestion_ts", T.TimestampType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("_rescued_data", T.StringType()),
    ]
)

SILVER = T.StructType(
    [T.StructField(f.column, f.type) for f in PAYLOAD_FIELDS]
    + [T.StructField("observed_at", T.TimestampType())]
)

MOMENTUM = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price_usd", PRICE),
        T.StructField("pct_change_24h", T.DoubleType()),
        T.StructField("volume_24h_usd", MONEY),
        T.StructField("market_cap_usd", MONEY),
        T.StructField("momentum_rank", T.IntegerType()),
        T.StructField("observed_at", T.TimestampType()),
    ]
)

VOLATILITY = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("realized_volatility_7d", T.DoubleType()),
        T.StructField("n_observations", T.LongType()),
        T.StructField("last_observed_at", T.DateType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order; refuse a missing column or another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: want {f.dataType.simpleString()}, got "
        + (actual[f.name].simpleString() if f.name in actual else "nothing")
        for f in schema.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise TypeError("schema mismatch: " + "; ".join(wrong))
    return df.select(*schema.names)
