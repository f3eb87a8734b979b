"""Byte-level BPE: every distinct word is encoded once, for the whole corpus.

1. The most frequent words of a bounded sample of texts are encoded (at most `FREQUENT` words of at
   most `FREQUENT_BYTES` bytes, so their table has a fixed bound) and travel to the tasks. This
   changes no result, only how many words need the shuffle below.
2. Texts are split into pre-tokens. A frequent word becomes its number; any other one is
   exploded with its position.
3. The others are brought together by a shuffle on the word. There each distinct word is merged by
   the ranks, once for the whole corpus, and all its positions get its ids.
4. A text is put together by position from the ids of its frequent and other words.

A word that the sample does not show twice is rare in the corpus (its share is below some millionths but by
chance), so it fills no task of that shuffle. A word of more than `FREQUENT_BYTES` bytes is in no table, however
common: these are dealt by the word and by one of `LONG_SHARES` shares of the documents, and merged once a share.

A text's numbers are dealt out by document once (compressed); the other words are read from there and
come back there. Decoding joins ids to the table of their bytes (one entry an id, a fixed size); asked for with the
encoding it is done in the same tasks.

Texts are pre-tokenised in Python, as the split pattern needs Unicode classes; a text whose
characters are all below U+0100 takes a pattern with these classes written out.

Defined cases: null and empty texts have no ids and decode to no bytes; rows are kept
apart by doc_id and text, so rows that share a doc_id (or have a null one) are each encoded, and
repeated rows are given repeatedly; a word of any length is merged whole; extra columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, bounded_sample, lean, narrow, settle, table

FREQUENT = 300_000
FREQUENT_BYTES = 48
LONG_SHARES = 1_024
# Tokens that are decoded at a time.
STRETCH = 1 << 16
SAMPLE_TEXTS = 40_000
BATCH_BYTES = 1 << 20

RANKS = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


# The Unicode classes of the split pattern, for characters below U+0100 only: letters, numbers, white space.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = r"\t-\r \x85\xa0"


@lru_cache(maxsize=2)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a text. White space is Unicode's White_Space, as in the library that the ranks are for."""
    general = regex.compile(pattern)
    if pattern != public_tokenizers.PATTERN:
        return general.findall
    known = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
        rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
    )

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return general.findall(text)
        return known.findall(text)

    return split


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: again and again the leftmost pair of lowest rank is joined."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _merge_long(word, ranks)
    get, none = ranks.get, len(ranks) + 1
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [get(a + b, none) for a, b in itertools.pairwise(parts)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs over linked parts: n log n."""
    n = len(word)
    end = list(range(1, n + 1))  # the part that begins at i ends here; 0: no part begins at i
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


def _packed_ids(ids: list[int]) -> bytes:
    """Two bytes an id, or four and one more in front, if one is too large."""
    small = max(ids, default=0) < 1 << 16
    return np.array(ids, "<u2").tobytes() if small else b"\0" + np.array(ids, "<u4").tobytes()


def _unpacked_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4", offset=1) if len(packed) & 1 else np.frombuffer(packed, "<u2")


class Frequent:
    """The ids of each number (from 1) of a frequent word."""

    def __init__(self, ids: list[list[int]]):
        self.lengths = np.array([0, *map(len, ids)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.array([x for own in ids for x in own], "<u4")


def frequent_words(texts: DataFrame, pattern: str, most: int = FREQUENT) -> list[str]:
    """The words that stand most often in a bounded sample of (id, text), at least twice, all above a count of which there are at most `most`."""

    def run(source):
        counts: Counter = Counter()
        split = splitter(pattern)
        for batch in batches(BATCH_BYTES)(source):
            for text in batch.column(1).to_pylist():
                counts.update(w for w in split(text) if len(w) <= FREQUENT_BYTES) if text else None
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    counted = bounded_sample(texts, ["id", "text"], SAMPLE_TEXTS).mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = settle(counted.where((F.col("n") > 1) & (F.octet_length("word") <= FREQUENT_BYTES)), "frequent")
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # a few hundred rows
    total, least = 0, None
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return []
    return counted.where(level >= least).orderBy(F.desc("n"), "word").select("word").toArrow().column(0).to_pylist()


def _squeeze(numbers: np.ndarray) -> bytes:
    """Numbers below 2^22, frequent ones in fewer bytes, compressed.

    A number below 2^7 is one byte, below 2^14 two; the top bit says that a byte follows.
    First bytes, second bytes and third bytes lie together, as they are alike.
    """
    long = numbers[numbers >= 1 << 7]
    longer = long[long >= 1 << 14]
    first = np.where(numbers >= 1 << 7, numbers & 127 | 128, numbers).astype(np.uint8)
    second = np.where(long >= 1 << 14, long >> 7 & 127 | 128, long >> 7).astype(np.uint8)
    head = np.array([len(first), len(second)], "<u4").tobytes()
    plain = head + first.tobytes() + second.tobytes() + (longer >> 14).astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(plain)


def _stretch(squeezed: bytes) -> np.ndarray:
    plain = zstandard.ZstdDecompressor().decompress(squeezed)
    n, m = np.frombuffer(plain, "<u4", 2).tolist()
    first, second, third = (np.frombuffer(plain, np.uint8, *x).astype(np.int64) for x in ((n, 8), (m, 8 + n), (-1, 8 + n + m)))
    more = second >= 128
    second[more] = second[more] & 127 | third << 7
    longer = first >= 128
    first[longer] = first[longer] & 127 | second << 7
    return first


def skeletons(docs: DataFrame, frequent, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, h, numbers, words, nameless) of each (id, text, nameless): numbers of the frequent words in order, 0 for each of the others, and those (packed).

    frequent: a broadcast of word to number. h: a hash of the text, which tells rows of one id apart.
    """

    def run(source):
        number, split = frequent.value.get, splitter(pattern)
        for batch in batches(BATCH_BYTES)(source):
            squeezed, others = [], []
            pack = zstandard.ZstdCompressor(level=3).compress
            for text in batch.column(1).to_pylist():
                words = split(text) if text else []
                numbers = np.fromiter((number(w, 0) for w in words), np.int64, len(words))
                squeezed.append(_squeeze(numbers))
                rest = [words[i] for i in np.flatnonzero(numbers == 0)]
                others.append(pack(json.dumps(rest, ensure_ascii=False).encode()) if rest else None)
            columns = [pa.array(squeezed, pa.binary()), pa.array(others, pa.binary())]
            columns = [batch.column(0), batch.column(2), *columns, batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "numbers", "words", "nameless"])

    keyed = docs.select("id", "text", F.xxhash64("text").alias("h"), "nameless")
    return keyed.mapInArrow(lean(run), "id long, h long, numbers binary, words binary, nameless boolean")


def exploded(dealt: DataFrame) -> DataFrame:
    """(id, h, place, word) of the words of `skeletons`; place counts these words alone. h is 0 but for ids with several texts."""

    def run(source: Iterator[pa.RecordBatch]):
        for batch in batches(BATCH_BYTES, 3)(source):
            lists = [json.loads(zstandard.decompress(w)) if w else [] for w in batch.column(3).to_pylist()]
            lengths = np.array([len(w) for w in lists], np.int64)
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = (np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            take = pa.array(row, pa.int64())
            words = pa.array([w for own in lists for w in own], pa.string())
            columns = [batch.column(0).take(take), batch.column(5).take(take), pa.array(place), words]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "place", "word"])

    # A hash in every row would be most of what is shuffled; rows of an id lie together, so it is known where it is needed.
    own = Window.partitionBy("id")
    told = dealt.withColumn("tag", F.when(F.min("h").over(own) != F.max("h").over(own), F.col("h")).otherwise(F.lit(0)))
    # In Python, so that every use reads all columns and can share one exchange.
    return told.mapInArrow(lean(run), "id long, h long, place int, word string")


def encoded(words: DataFrame, path: str) -> DataFrame:
    """(id, h, found) of (id, h, place, word): every distinct word is merged once, in the task that has all its rows.

    found: place and ids, both packed.
    """

    def run(source):
        ranks = load_ranks(path)
        last, ids = None, b""
        for batch in source:  # in order of the word
            out = []
            for place, word in zip(batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist(), strict=True):
                if word != last:
                    last, ids = word, _packed_ids(merge(word, ranks))
                out.append(place.to_bytes(4, "big") + ids)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], names=["id", "h", "found"])

    share = F.when(F.octet_length("word") > FREQUENT_BYTES, F.pmod(F.xxhash64("id"), F.lit(LONG_SHARES))).otherwise(F.lit(0))
    together = words.repartition("word", share).sortWithinPartitions("word")
    return together.mapInArrow(lean(run), "id long, h long, found binary")


def _put_together(numbers: np.ndarray, known: Frequent, others: list[np.ndarray]) -> bytes:
    """Ids of a text: of the frequent words by number, of the others in turn where the number is 0."""
    lengths = known.lengths[numbers]
    gaps = np.flatnonzero(numbers == 0)
    lengths[gaps] = [len(x) for x in others]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    source = np.repeat(known.starts[numbers] - starts, lengths) + np.arange(ends[-1] if len(ends) else 0)
    if not len(gaps):
        return known.flat[source].tobytes()
    own = np.zeros(len(source), bool)
    own[np.repeat(starts[gaps], lengths[gaps]) + np.arange(lengths[gaps].sum()) - np.repeat(np.cumsum(lengths[gaps]) - lengths[gaps], lengths[gaps])] = True
    ids = np.empty(len(source), "<u4")
    ids[~own] = known.flat[source[~own]]
    ids[own] = np.concatenate(others)
    return ids.tobytes()


def encode(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    doc_id: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
    tokens: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, ids): one row per row of `docs`; ids as packed unsigned 32-bit integers, little end first.

    With the table `tokens` also `decoded`, as by `decode`.
    """
    narrow(docs.sparkSession)
    path = path or public_tokenizers.path(RANKS)
    # A row without a doc_id goes by its text. Should that be another's doc_id, h tells the two apart.
    own_id = F.coalesce(F.col(doc_id), F.xxhash64(F.col(text)))
    texts = docs.select(own_id.alias("id"), F.col(text).alias("text"), F.col(doc_id).isNull().alias("nameless"))
    words = frequent_words(texts, pattern, frequent)
    ranks, context = load_ranks(path), docs.sparkSession.sparkContext
    numbers = context.broadcast({w: i for i, w in enumerate(words, 1)})
    known = context.broadcast(Frequent([merge(w.encode(), ranks) for w in words]))
    listed = context.broadcast(Bytes(tokens)) if tokens is not None else None

    dealt = skeletons(texts, numbers, pattern).repartition("id")
    # Repeated rows bring the same words again: one of each place is enough.
    filled = encoded(exploded(dealt), path).groupBy("id").agg(F.collect_set(F.struct("h", "found")).alias("filled"))
    # All columns, as in the other use of the exchange: then it is made once.
    whole = dealt.join(filled, "id", "left").select("id", "h", "numbers", "words", "filled", "nameless")

    def assemble(source: Iterator[pa.RecordBatch]):
        for batch in batches(BATCH_BYTES, 2)(source):
            out = []
            for h, squeezed, filled_ in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4)), strict=True):
                own = sorted(x["found"] for x in filled_ or () if x["h"] in (0, h))
                out.append(_put_together(_stretch(squeezed), known.value, [_unpacked_ids(x[4:]) for x in own]))
            columns = {"doc_id": pa.compute.if_else(batch.column(5), pa.scalar(None, pa.int64()), batch.column(0)), "ids": pa.array(out, pa.binary())}
            if listed is not None:
                columns["decoded"] = pa.array(map(listed.value.of, out), pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return whole.mapInArrow(lean(assemble), "doc_id long, ids binary" + (", decoded binary" if tokens is not None else ""))


def token_bytes(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(token_id, bytes): the table that decoding joins."""
    ranks = load_ranks(path or public_tokenizers.path(RANKS))
    # By Arrow: a list of rows would start Python workers of their own on the executors.
    return spark.createDataFrame(pa.table({"token_id": pa.array(ranks.values(), pa.int32()), "bytes": pa.array(ranks, pa.binary())}))


class Bytes:
    """The bytes of each id, end to end, of the table (token_id, bytes). One row for each id of the vocabulary, whatever the corpus."""

    def __init__(self, tokens: DataFrame):
        rows = tokens.toArrow()
        ids = rows.column(0).to_numpy()
        values = dict(zip(ids.tolist(), rows.column(1).to_pylist(), strict=True))
        size = int(ids.max(initial=-1)) + 1
        self.lengths = np.array([len(values.get(i, b"")) for i in range(size)], np.int32)
        self.known = np.isin(np.arange(size), ids)
        self.flat = np.frombuffer(b"".join(values.get(i, b"") for i in range(size)), np.uint8)
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)

    def of(self, packed: bytes) -> bytes:
        """The bytes of packed ids, joined. An id that is not in the table is an error."""
        ids, parts = np.frombuffer(packed, "<u4"), []
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise KeyError("an id without bytes")
        for begin in range(0, len(ids), STRETCH):
            own = ids[begin : begin + STRETCH]
            lengths = self.lengths[own]
            ends = np.cumsum(lengths)
            source = np.repeat(self.starts[own] - (ends - lengths), lengths) + np.arange(ends[-1])
            parts.append(self.flat[source].tobytes())
        return b"".join(parts)


def decode(encoded: DataFrame, tokens: DataFrame) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each row's ids, joined from the table `tokens`, where the ids are."""
    listed = encoded.sparkSession.sparkContext.broadcast(Bytes(tokens))

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            out = pa.array(map(listed.value.of, batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), out], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(lean(run), "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame, keep_ids: bool = False) -> DataFrame:
    return decoded.select(
        "doc_id",
        *(["ids"] if keep_ids else []),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents"), tokens=token_bytes(spark)))
