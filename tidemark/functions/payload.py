"""JSON payload expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAYLOAD_FIELDS, PayloadField


def to_payload(columns: Sequence[str | Column]) -> Column:
    """One row as JSON text. A NULL column leaves its key out."""
    return F.to_json(F.struct(*columns))


def parse(
    df: DataFrame,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
    keep: Iterable[str | Column] = (),
) -> DataFrame:
    """Typed columns of the payload, read in one pass over the text.

    A wrong-typed or overflowing field becomes NULL and leaves its neighbours
    alone, so one bad number never fails a batch. Decimals are read from the
    digits of the text, not through a double. Text that is no object gives NULLs.

    The document is unpacked by a generator: a filter on a parsed column then
    stays above it, where otherwise it would be pushed below and parse the text a
    second time. Filters on other columns still reach the scan.
    """
    schema = T.StructType([T.StructField(f"_{f.column}", f.type) for f in fields])
    by_key = T.StructType([T.StructField(f.key, f.type) for f in fields])
    document = F.from_json("payload", by_key).cast(schema)
    parsed = df.select("*", F.inline(F.array(document)))
    typed = []
    for f in fields:
        value = F.col(f"_{f.column}")
        typed.append((F.upper(value) if f.upper else value).alias(f.column))
    return parsed.select(*typed, *keep)


def with_document(df: DataFrame, payload: str = "payload", name: str = "document") -> DataFrame:
    """Add the payload as a VARIANT: parsed once, where it is stored, and never again. Broken text gives NULL."""
    return df.select("*", F.inline(F.array(F.struct(F.try_parse_json(payload).alias(name)))))


def typed_document(
    df: DataFrame,
    fields: Sequence[PayloadField] = PAYLOAD_FIELDS,
    keep: Iterable[str | Column] = (),
    name: str = "document",
) -> DataFrame:
    """The columns of `parse`, read from the stored VARIANT. A new field needs no new reading of the text."""
    typed = []
    for f in fields:
        value = F.try_variant_get(name, f"$['{f.key}']", f.type.simpleString())
        typed.append((F.upper(value) if f.upper else value).alias(f.column))
    return df.select(*typed, *keep)


def rescued_document(df: DataFrame, known: Iterable[str], name: str = "document", column: str = "_rescued_data") -> DataFrame:
    """Add the fields outside `known` as `with_rescued` does, from the stored VARIANT."""
    expected = F.array(*[F.lit(k) for k in known])
    fields = F.try_variant_get(name, "$", "map<string,string>")
    extra = F.map_filter(fields, lambda key, _: ~F.array_contains(expected, key))
    opened = df.select("*", F.inline(F.array(F.struct(extra.alias("_extra")))))
    return opened.withColumn(column, F.when(F.cardinality("_extra") > 0, F.to_json("_extra"))).drop("_extra")


def not_an_object(payload: Column) -> Column:
    """True where the text is not a JSON object (broken, a list, a bare value, NULL)."""
    return F.json_object_keys(payload).isNull()


def with_rescued(df: DataFrame, payload: str, known: Iterable[str], name: str = "_rescued_data") -> DataFrame:
    """Add the fields outside `known` as JSON text, or NULL where there are none.

    As in `parse`, a generator unpacks the document, so it is read once whatever is filtered above.
    """
    expected = list(known)
    fields = F.from_json(payload, T.MapType(T.StringType(), T.StringType()))
    extra = F.map_filter(fields, lambda key, _: ~key.isin(expected))
    opened = df.select("*", F.inline(F.array(F.struct(extra.alias("_extra")))))
    return opened.withColumn(name, F.when(F.cardinality("_extra") > 0, F.to_json("_extra"))).drop("_extra")
