"""What the text operators share: tables, words, Arrow batches, stored intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import settle

__all__ = ["HOLD_OUT", "WORD_BYTES", "SLICES", "batches", "bounded_sample", "in_train", "lean", "narrow", "packed", "settle", "slice_of", "table", "word_bytes"]

# Lower-cases A-Z and turns every other ASCII character that is not a letter or
# digit into a space. Bytes of 0x80 and above (all of a non-ASCII character) stay.
WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)

# One document in five is kept out of every training set.
HOLD_OUT = 5


# Texts are long rows: a task needs few of them at a time, and holds every batch several times over.
ARROW_BYTES = 4 << 20


def narrow(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold at most `ARROW_BYTES`, as queries are planned when they run. A lower setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    size = re.fullmatch(r"(-?\d+)([bkmg]?)b?", now.strip().lower())
    if size and not 0 < int(size[1]) * units[size[2] or "b"] <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    narrow(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bytes(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, lower-cased letters and non-ASCII characters."""
    return text.translate(WORD_BYTES).split() if text else []


def in_train(doc_id: Column | str) -> Column:
    """Whether a document may be learned from: crc32 of its id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % HOLD_OUT != 0


def packed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, id, text): all columns of `docs` in one struct, so none can clash with an operator's own names."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].alias("id"), docs[text].alias("text"))


# Samples are chosen by the hash of a row, out of so many slices.
SLICES = 1 << 20


def slice_of(*keys: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(SLICES))


def bounded_sample(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """All of `rows`, or about `most` of them (at most 1.2 times as many, but for chance) chosen by a hash of `keys`.

    Name all that tells rows apart: rows with equal keys are in or out together. Should such rows alone break the bound,
    they count as one. The choice depends on the rows alone, so a repeated run takes the same ones.
    """
    count = rows.count()
    if count <= most:
        return rows
    chosen = rows.where(slice_of(*keys) < int(SLICES * most / count))
    return chosen if chosen.count() <= 1.2 * most else chosen.dropDuplicates(keys)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, with the worker's freed memory given back at the end of a task: workers go on to other stages."""

    def whole(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(source)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def batches(most_bytes: int, column: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cut Arrow batches so that the text `column` of each holds about `most_bytes` at most (or one row)."""

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            begin = total = 0
            for i, length in enumerate(lengths):
                if total and total + length > most_bytes:
                    yield batch.slice(begin, i - begin)
                    begin, total = i, 0
                total += int(length)
            if begin < batch.num_rows:
                yield batch.slice(begin)

    return cut
