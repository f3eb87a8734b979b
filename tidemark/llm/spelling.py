"""Spelling variants: words that differ by one code point, found by pairs of numbered trie nodes.

1. Words are counted in the tasks and then over the corpus. Those that count are numbered in order of falling
   frequency (equal ones by code points), so that of several words the first is the one with the least number.
2. Tries. Words in alphabetical order are a trie: with the word before it a word shares the nodes of their common
   beginning, and its other nodes are new. Tasks hold ranges of the order and number the nodes they meet. Only
   the nodes that a range's first word shares with the range before can have two numbers; one row a range (its
   first and last word) tells which is meant. The same with reversed words gives the nodes of endings.
3. Pairs. Of a word w, for each place i: (node of the beginning before i, node of the ending after i) with the
   code point at i skipped, and (node of the beginning before i, node of the ending from i) with nothing skipped.
   Two words meet in a pair of the first kind if they differ by a replaced code point there. A word's second kind
   meets another's first kind if the other has one more code point there; of equal neighbours only the first
   counts as the one too many. So each two near words meet in exactly one pair, and no others do.
4. A pair's words differ at one place, so they are at most as many as the alphabet has letters, and one.
   Each gets the number of the others and the least of their numbers. Sums and minima by word are the result.
5. A variant points to its form; forms grow tenfold at each step, so pointers doubled five times reach the root.

Pairs of words are never listed, and no word's neighbours are collected.

Defined cases: null and empty texts have no runs; a null doc_id is an empty text in the hash; repeated rows count
again; a run of any length is a word (its rows grow with its length); an empty table gives no rows; extra
columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, settle, table

LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is at least so many times as frequent as its variant.
TIMES = 10
# One run in so many loses a code point, by a hash.
SPOILED = 31
BATCH_BYTES = 4 << 20
# So many different words are held in a task before their counts are handed on.
HELD_WORDS = 200_000

# Fixed value: the letters that words are made of.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER = re.compile("[A-Z]+")


def spoil(word: str, head: int, one_in: int = SPOILED) -> str:
    """The word, or the word without a code point if the hash says so. head: the hash of what goes before it."""
    hashed = crc32(word.encode(), head)
    if hashed % one_in:
        return word
    place = hashed % len(word)
    return word[:place] + word[place + 1 :]


def runs(text: str, least: int = LEAST_LENGTH) -> Counter:
    """Lower-cased (A-Z only) runs of letters of at least `least` code points; a shorter one cannot become a word."""
    found = Counter(re.findall(f"[{LETTERS}]{{{least},}}", text))
    lowered: Counter = Counter()
    for run, n in found.items():
        lowered[run.lower() if run.isascii() else _UPPER.sub(lambda m: m[0].lower(), run)] += n
    return lowered


def counted_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, spoiled: int = SPOILED) -> DataFrame:
    """(word, n) of (doc_id, text): the words and their occurrences in all texts."""

    def run(source: Iterator[pa.RecordBatch]):
        held: Counter = Counter()

        def handed_on():
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches(BATCH_BYTES)(source):
            for doc, text in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                if not text:
                    continue
                head = crc32(f"{'' if doc is None else doc}:".encode())
                for own, n in runs(text, least_length).items():
                    word = spoil(own, head, spoiled)
                    if len(word) >= least_length:
                        held[word] += n
            if len(held) > HELD_WORDS:
                yield handed_on()
        yield handed_on()

    listed = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return listed.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n): ids ascend with falling n, equal ones with the word's code points. To be stored."""

    def run(source):
        begin = TaskContext.get().partitionId() << 40
        for batch in source:
            ids = np.arange(begin, begin + batch.num_rows)
            begin += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(ids), *batch.columns], names=["id", "word", "n"])

    order = [F.desc("n"), F.asc("word")]
    return words.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "id long, word string, n long")


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def trie_nodes(words: DataFrame, label: str) -> DataFrame:
    """(id, nodes) of (id, word): the numbers of the trie nodes on the word's path, the root (0) left out."""
    spark = words.sparkSession

    def run(source):
        part = TaskContext.get().partitionId()
        path, last, made = np.empty(0, np.int64), "", 0
        for batch in source:  # in order of the word
            lists, first = [], []
            for word in batch.column(1).to_pylist():
                shared = _common(word, last)
                new = len(word) - shared
                path = np.concatenate([path[:shared], np.arange(made + 1, made + new + 1)])
                first.append(made == 0)
                made, last = made + new, word
                lists.append(path)
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            nodes = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists) if lists else np.empty(0, np.int64)))
            columns = [batch.column(0), batch.column(1), pa.array([part] * len(lists), pa.int32()), pa.array(first), nodes]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "word", "part", "first", "nodes"])

    in_order = words.select("id", "word").repartitionByRange("word").sortWithinPartitions("word")
    stored = settle(in_order.mapInArrow(run, "id long, word string, part int, first boolean, nodes array<long>"), label)

    # Two rows for each task that had words.
    firsts = {r["part"]: r["word"] for r in stored.where("first").select("part", "word").collect()}
    lasts = {
        r["part"]: (r["last"]["word"], r["last"]["nodes"])
        for r in stored.groupBy("part").agg(F.max(F.struct("word", "nodes")).alias("last")).collect()
    }
    known: dict[int, np.ndarray] = {}  # of a part: the true numbers of its nodes 1, 2, ..., which it shares with the part before
    before, path = "", np.empty(0, np.int64)
    for part in sorted(firsts):
        known[part] = path[: _common(firsts[part], before)]
        before, nodes = lasts[part]
        path = _true(np.array(nodes, np.int64), part, known[part])
    shared = spark.sparkContext.broadcast(known)

    def settle_numbers(source):
        for batch in source:
            lists = batch.column(2)
            flat, lengths = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            parts = np.repeat(batch.column(1).to_numpy(), lengths)
            out = np.empty(len(flat), np.int64)
            for part in np.unique(parts):
                here = parts == part
                out[here] = _true(flat[here], int(part), shared.value[int(part)])
            offsets = (lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(out))], names=["id", "nodes"])

    return stored.select("id", "part", "nodes").mapInArrow(settle_numbers, "id long, nodes array<long>")


def _true(nodes: np.ndarray, part: int, known: np.ndarray) -> np.ndarray:
    """Numbers that hold everywhere, of a part's own numbers: those that it shares, or else with the part in front."""
    out = ((part + 1) << 40) + nodes
    old = nodes <= len(known)
    out[old] = known[nodes[old] - 1]
    return out


# What a row of a pair says of its word.
WHOLE, SKIPPED, SKIPPED_FIRST = 0, 1, 2


def node_pairs(tries: DataFrame) -> DataFrame:
    """(before, after, entry) of (id, word, beginnings, endings): entry is the word's id times 4 and what it is there."""

    def run(source):
        for batch in batches(1 << 18)(source):
            before, after, entry = [], [], []
            for id_, word, heads, tails in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                points = np.frombuffer(word.encode("utf-32-le"), "<u4")
                n = len(points)
                head, tail = (np.concatenate([[0], np.array(x, np.int64)]) for x in (heads, tails))
                is_first = np.concatenate([[True], points[1:] != points[:-1]])
                before += [head, head[:n]]
                after += [tail[::-1], tail[n - 1 :: -1]]
                entry += [np.full(n + 1, id_ * 4 + WHOLE), id_ * 4 + np.where(is_first, SKIPPED_FIRST, SKIPPED)]
            columns = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64)) for x in (before, after, entry)]
            yield pa.RecordBatch.from_arrays(columns, names=["before", "after", "entry"])

    return tries.select("id", "word", "beginnings", "endings").mapInArrow(run, "before long, after long, entry long")


def _met(before: np.ndarray, after: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, n_near, nearest) of each entry with others near it in its pair; rows are sorted, no pair is cut.

    nearest: the least id of the others. The whole word of a pair is its least entry kind, and there is one at most.
    """
    new = np.concatenate([[True], (before[1:] != before[:-1]) | (after[1:] != after[:-1])])
    begins = np.flatnonzero(new)
    pair = np.cumsum(new) - 1
    id_, kind = entry >> 2, entry & 3
    none = np.iinfo(np.int64).max

    def least_two(chosen):
        """Of the chosen entries of each pair: how many, the least id, and the least but one."""
        ids = np.where(chosen, id_, none)
        least = np.minimum.reduceat(ids, begins)
        second = np.minimum.reduceat(np.where(ids == least[pair], none, ids), begins)
        return np.add.reduceat(chosen.astype(np.int64), begins), least, second

    skipped, least, second = least_two(kind != WHOLE)
    firsts, least_first, _ = least_two(kind == SKIPPED_FIRST)
    whole_n, whole, _ = least_two(kind == WHOLE)
    least, second, whole, least_first = (x[pair] for x in (least, second, whole, least_first))
    skipped, firsts, whole_n = (x[pair] for x in (skipped, firsts, whole_n))
    other = np.where(least == id_, second, least)
    n_near = np.where(kind == WHOLE, firsts, skipped - 1 + np.where(kind == SKIPPED_FIRST, whole_n, 0))
    nearest = np.where(kind == WHOLE, least_first, np.where(kind == SKIPPED_FIRST, np.minimum(other, whole), other))
    seen = n_near > 0
    return id_[seen], n_near[seen], nearest[seen]


def neighbours(pairs: DataFrame) -> DataFrame:
    """(id, n_near, nearest): for each word with near words how many, and the least of their ids."""

    def run(source):
        held = [np.empty(0, np.int64)] * 3
        for batch in source:  # in order of the pair
            rows = [np.concatenate([old, c.to_numpy()]) for old, c in zip(held, batch.columns[:3], strict=True)]
            if not len(rows[0]):
                continue
            # The last pair may go on in the next batch.
            last = len(rows[0]) - int(((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])).sum())
            held = [x[last:] for x in rows]
            if last:
                yield _batch(_met(*(x[:last] for x in rows)))
        if len(held[0]):
            yield _batch(_met(*held))

    together = pairs.repartition("before", "after").sortWithinPartitions("before", "after")
    met = together.mapInArrow(run, "id long, n_near long, nearest long")
    return met.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("nearest").alias("nearest"))


def _batch(columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["id", "n_near", "nearest"])


def roots(forms: DataFrame, steps: int = 5) -> DataFrame:
    """(id, root) of (id, form): the last of id's forms. 2 ** steps forms in a row are followed."""
    reached = forms.select("id", F.col("form").alias("root"))
    for _ in range(steps):
        onward = reached.select(F.col("id").alias("_from"), F.col("root").alias("_to"))
        joined = reached.join(onward, reached["root"] == onward["_from"], "left")
        reached = settle(joined.select("id", F.coalesce("_to", "root").alias("root")), "spelling-roots")
        if not reached.join(forms.select(F.col("id").alias("root")), "root", "left_semi").limit(1).count():
            break
    return reached


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    spoiled: int = SPOILED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the texts."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    words = settle(numbered(settle(counted_words(texts, least_length, least_count, spoiled), "spelling-counts")), "spelling-words")
    beginnings = trie_nodes(words, "spelling-beginnings").select("id", F.col("nodes").alias("beginnings"))
    endings = trie_nodes(words.select("id", F.reverse("word").alias("word")), "spelling-endings").select("id", F.col("nodes").alias("endings"))
    tries = words.join(beginnings, "id").join(endings, "id")
    near = settle(neighbours(node_pairs(tries)), "spelling-near")

    # The least id is the most frequent near word, of equals the first.
    best = words.select(F.col("id").alias("nearest"), F.col("n").alias("form_n"), F.col("word").alias("form_word"))
    judged = words.join(near, "id", "left").join(best, "nearest", "left")
    is_form = F.coalesce(F.col("form_n") >= times * F.col("n"), F.lit(False))
    told = settle(
        judged.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            *[F.when(is_form, F.col(c)).alias(a) for c, a in (("form_word", "form"), ("form_n", "form_n"), ("nearest", "form_id"))],
        ),
        "spelling-forms",
    )
    last = roots(told.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    named = last.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return told.join(named, "id", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
