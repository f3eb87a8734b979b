"""Sequence packing by minimum bin slack: each sequence gets the fullest combination of the lengths that are left.

1. Texts become token ids with an end id behind them. One that is longer than a sequence is cut into whole
   sequences, the rest of it in front. Pieces are stored with their length and their number among the
   pieces of this length that the task made.
2. Pieces are counted by length: `capacity` numbers, whatever the corpus. The plan is made from these alone. A
   sequence takes the longest length left and the subset of the other lengths that fills it best, found by
   dynamic programming over the sums within reach (a bitset, one bit a sum; copies of a length go in
   in powers of two). What was found is removed as often as the counts allow in one go, so the number of
   steps depends on `capacity`, not on the corpus.
3. A piece's rank among all of its length is its number in its task and the count of the tasks before, one
   row a task and length. The plan says for a length which ranks stand in which sequences, and where.

No two sequences are ever compared and no group of pieces meets in one task, so a length that a third of all
pieces have is placed as any other.

Defined cases: a null or empty text is the end id alone; repeated rows, rows that share a doc_id and rows
with a null one are packed each by itself; a text of any length is tokenised in stretches; an empty
table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import batches, settle, table

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
BATCH_BYTES = 1 << 20

# A text is tokenised in stretches of about this many characters.
STRETCH = 1 << 16
# After a letter and before a space a word ends, however the text goes on.
_CUT = re.compile(r"(?<=[A-Za-z])(?= )")
_SPECIAL = "<|endoftext|>"


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in parts of about `size` characters, each tokenised as it is within the whole."""
    begin = 0
    while len(text) - begin > size:
        found = _CUT.search(text, begin + size)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


class Ids:
    """Token ids of texts, as the vocabulary file's own library gives them.

    Texts below U+0100 go through a second library with the same ranks, which is three times as fast and has no
    two opinions there on what a letter, a number or a space is; all others through the first.
    """

    def __init__(self, path: str, ranks_path: str):
        self.exact = Tokenizer.from_file(path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _part(self, text: str) -> np.ndarray:
        if len(text) <= 2 * STRETCH and _SPECIAL not in text:
            try:
                text.encode("latin-1")
                return np.array(self.fast.encode_ordinary(text), np.uint32)
            except UnicodeEncodeError:
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def of(self, text: str | None) -> np.ndarray:
        return np.concatenate([self._part(part) for part in stretches(text)]) if text else np.empty(0, np.uint32)


@lru_cache(maxsize=2)
def ids_of(path: str, ranks_path: str) -> Ids:
    return Ids(path, ranks_path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole sequences, and in front of them the rest."""
    first = length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    path: str | None = None,
    ranks_path: str | None = None,
    keep_ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, part, nth): nth counts the pieces of a length within a part, a task.

    ids are packed unsigned 32-bit integers; without `keep_ids` the column is left out. Store the result: another
    run of it may make other parts.
    """
    path, ranks_path = path or public_tokenizers.path(VOCABULARY), ranks_path or public_tokenizers.path(RANKS)

    def run(source: Iterator[pa.RecordBatch]):
        known, part = ids_of(path, ranks_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches(BATCH_BYTES)(source):
            row, number, start, length, digest, packed_ids = [], [], [], [], [], []
            for i, text_ in enumerate(batch.column(1).to_pylist()):
                ids = np.append(known.of(text_), np.uint32(END_ID)).astype("<u4")
                for j, (begin, size) in enumerate(cut(len(ids), capacity)):
                    own = ids[begin : begin + size].tobytes()
                    row.append(i)
                    number.append(j)
                    start.append(begin)
                    length.append(size)
                    digest.append(zlib.crc32(own))
                    if keep_ids:
                        packed_ids.append(own)
            lengths = np.array(length, np.int64)
            columns = {
                "doc_id": batch.column(0).take(pa.array(row, pa.int64())),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(lengths),
                "ids_crc32": pa.array(digest, pa.int64()),
                **({"ids": pa.array(packed_ids, pa.binary())} if keep_ids else {}),
                "part": pa.array(np.full(len(row), part), pa.int32()),
                "nth": pa.array(_numbered(lengths, seen)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    ids = "ids binary, " if keep_ids else ""
    schema = f"doc_id long, piece int, start long, length long, ids_crc32 long, {ids}part int, nth long"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """A running number for each length, going on from `seen`, which is carried forward."""
    order = np.argsort(lengths, kind="stable")
    along = lengths[order]
    begins = np.flatnonzero(np.diff(along, prepend=-1))
    sizes = np.diff(np.append(begins, len(along)))
    numbers = np.empty(len(lengths), np.int64)
    numbers[order] = np.arange(len(along)) - np.repeat(begins, sizes) + seen[along]
    seen += np.bincount(lengths, minlength=len(seen))
    return numbers


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Copies by length of the combination that fills `room` best; long lengths are preferred among equals.

    Bit s of `sums` says that some of the lengths looked at so far add up to s.
    """
    sums, within = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            copies = min(copies, left)
            steps.append((length, copies, sums))
            sums |= sums << length * copies & within
            left -= copies
            copies *= 2
        if sums >> room & 1:
            break
    total, taken = sums.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + copies
            total -= length * copies
    return taken


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(copies by length, number of sequences packed so), in turn, until all of `counts` are placed."""
    left, made = {length: n for length, n in counts.items() if n}, []
    while left:
        longest = max(left)
        others = {**left, longest: left[longest] - 1}
        own = fullest(others, capacity - longest)
        own[longest] = own.get(longest, 0) + 1
        times = min(left[length] // copies for length, copies in own.items())
        made.append((own, times))
        for length, copies in own.items():
            left[length] -= copies * times
            if not left[length]:
                del left[length]
    return made


class Places:
    """For each length the stretches of ranks that one step of the plan places, ready for look-up."""

    def __init__(self, made: list[tuple[dict[int, int], int]]):
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: dict[int, int] = {}
        sequence = 0
        for own, times in made:
            offset = 0
            for length in sorted(own, reverse=True):
                first = ranks.get(length, 0)
                found.setdefault(length, []).append((first, own[length], sequence, offset))
                ranks[length] = first + own[length] * times
                offset += length * own[length]
            sequence += times
        self.sequences = sequence
        self.by_length = {length: np.array(rows, np.int64) for length, rows in found.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces with these lengths and ranks."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for own in np.unique(length):
            rows, here = self.by_length[int(own)], np.flatnonzero(length == own)
            row = rows[np.searchsorted(rows[:, 0], rank[here], "right") - 1]
            within, copies = rank[here] - row[:, 0], row[:, 1]
            sequence[here] = row[:, 2] + within // copies
            offset[here] = row[:, 3] + within % copies * own
        return sequence, offset


def place(stored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`stored` pieces (they must be a stored table) with `sequence_id` and `offset` instead of `part` and `nth`."""
    per_part = stored.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = stored.sparkSession.sparkContext.broadcast(Places(plan(counts, capacity)))
    kept = [c for c in stored.columns if c not in ("part", "nth")]
    ranked = stored.join(ahead, ["part", "length"]).select(*kept, (F.col("nth") + F.col("ahead")).alias("rank"))

    def run(source: Iterator[pa.RecordBatch]):
        for batch in source:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            sequence, offset = places.value.of(length, rank)
            columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    types = ", ".join(f"{c} {t}" for c, t in stored.dtypes if c in kept)
    return ranked.mapInArrow(run, f"{types}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of every piece. Options go to `pieces`."""
    return place(settle(pieces(docs, capacity, **options), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids): the packed sequences themselves, at most a sequence's ids in a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda total, x: total + x["length"]).alias("length"),
        F.aggregate("parts", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"),
        F.transform("parts", lambda x: x["doc_id"]).alias("doc_ids"),
    )


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep_ids=False)
