"""Benchmark decontamination with a positional inverted index of the training text.

1. Statistics: how often each word of the benchmark stands in the training text,
   counted over all documents (map-side combined: one row per word and task).
2. Probes: of every window of `size` words of an item, the `PROBES` positions with
   the rarest words. Every occurrence of a window shows all of its probes.
3. Index: postings (word, document, positions) of the probe words, stored.
4. Lookup: postings join the probes on the word; position minus place in the item
   is where the item would begin. Lists intersect where two probes of an item agree
   on that beginning (exact) or, if asked for, nearly do (proximity).
5. Check: the item's words are compared at each agreed beginning, word by word,
   with the whole text of the document. A proximity match is compared too: some window stands in the text but for one word
   changed, dropped or added. Such an edit touches one probe of three at most, and moves the others by one word, so
   the two left meet nearly: none is missed.

The benchmark is worked on in blocks of at most `BLOCK_WORDS` words, so what
travels to every task (a block's words) has a fixed bound; a larger benchmark is
more passes. Postings are joined by shuffle or broadcast as sizes tell Spark; a
word that stands in very many documents can be split by the skew join.

Defined cases: null or empty texts have no words and are never hit; an item without
words has no window; repeated items count once per item_id (an item_id with several
texts is hit if one of them is), and a null item_id is one more id; documents that
share a doc_id, or have a null one, are judged each by its own text, and of those with a null
one each stays or goes by itself; extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, lean, narrow, settle, table, word_bytes

SIZE = 10
PROBES = 2
# With proximity matches: one word may be changed or missing, and two probes of its window still meet.
NEAR_PROBES = 3
SLOP = 5
# Windows of fewer words have no near match.
NEAR_LEAST = 4
BLOCK_WORDS = 500_000
BATCH_BYTES = 8 << 20


def window_starts(words: list[bytes], size: int) -> list[list[int]]:
    """For each place the starts of the windows that hold it. Of windows with equal words only the first counts.

    An occurrence of any of these is one of the first, and is compared from there with the whole item: so an item
    that repeats a word or a phrase has no more windows to look up than different ones.
    """
    width = min(size, len(words))
    first: dict[tuple[bytes, ...], int] = {}
    for start in range(len(words) - width + 1):
        first.setdefault(tuple(words[start : start + width]), start)
    held: list[list[int]] = [[] for _ in words]
    for start in first.values():
        for place in range(start, start + width):
            held[place].append(start)
    return held


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(item, version, place, word, length, starts): the words of each text, one row a place. version tells texts of one id apart."""

    def run(source):
        for batch in source:
            for item, text_ in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = word_bytes(text_)
                if words:
                    version = int.from_bytes(hashlib.sha256(b" ".join(words)).digest()[:7], "big")
                    n = len(words)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * n, pa.int64()),
                            pa.array([version] * n, pa.int64()),
                            pa.array(np.arange(n, dtype=np.int32)),
                            pa.array(words, pa.binary()).cast(pa.string()),
                            pa.array([n] * n, pa.int32()),
                            pa.array(window_starts(words, size), pa.list_(pa.int32())),
                        ],
                        names=["item", "version", "place", "word", "length", "starts"],
                    )

    listed = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).distinct()
    return listed.mapInArrow(lean(run), "item long, version long, place int, word string, length int, starts array<int>").distinct()


def word_counts(docs: DataFrame, words: set[bytes]) -> DataFrame:
    """(word, n): occurrences in all texts of (id, text) of those `words` that stand there."""

    def run(source):
        ids = {w: i for i, w in enumerate(sorted(words))}
        counts = np.zeros(len(ids), np.int64)
        for batch in batches(BATCH_BYTES)(source):
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = [ids[w] for w in word_bytes(text) if w in ids]
                counts += np.bincount(found, minlength=len(ids)) if len(found) * 4 > len(ids) else 0
                if len(found) * 4 <= len(ids):
                    np.add.at(counts, found, 1)
        seen = np.flatnonzero(counts)
        names = np.array(sorted(words), object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(names[seen]), pa.binary()).cast(pa.string()), pa.array(counts[seen])], names=["word", "n"]
        )

    return docs.select("id", "text").mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def probes(items: DataFrame, counts: DataFrame, most: int = PROBES) -> DataFrame:
    """(item, version, place, word, length) of the places that are among the `most` rarest of some window."""
    rated = items.join(counts, "word", "left").fillna(0, ["n"])
    each = rated.select("item", "version", "place", "word", "length", "n", F.explode("starts").alias("start"))
    rarest = Window.partitionBy("item", "version", "start").orderBy("n", "word", "place")
    chosen = each.withColumn("rank", F.row_number().over(rarest)).where(F.col("rank") <= most)
    return chosen.select("item", "version", "place", "word", "length").distinct()


def postings(docs: DataFrame, words: set[bytes]) -> DataFrame:
    """(word, id, positions): where each of `words` stands in each text of (id, text)."""

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            out_word, out_id, lengths, flat = [], [], [0], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                own: dict[bytes, list[int]] = {}
                for place, word in enumerate(word_bytes(text)):
                    if word in words:
                        own.setdefault(word, []).append(place)
                for word, places in own.items():
                    out_word.append(word)
                    out_id.append(doc)
                    flat += places
                    lengths.append(len(places))
            lists = pa.ListArray.from_arrays(np.cumsum(lengths).astype(np.int32), pa.array(flat, pa.int32()))
            columns = [pa.array(out_word, pa.binary()).cast(pa.string()), pa.array(out_id, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "id", "positions"])

    return docs.select("id", "text").mapInArrow(lean(run), "word string, id long, positions array<int>")


def alignments(index: DataFrame, probe_rows: DataFrame, near: bool = False, slop: int = SLOP) -> DataFrame:
    """(id, item, version, exact, near): documents and beginnings at which two probes of an item agree.

    With `near` also where two probes lie within about `slop` words (2 slop at most) of where they should be to each
    other: stretches of 2 slop beginnings, by their first. An item of one word needs one probe.
    """
    met = index.join(probe_rows, "word").select("id", "item", "version", "length", "place", F.explode("positions").alias("position"))
    met = met.withColumn("begin", (F.col("position") - F.col("place")).cast("int"))
    two = (F.min("place") < F.max("place")) | (F.max("length") == 1)
    # A document's postings come from one task, so these group mostly before the shuffle.
    found = met.groupBy("id", "item", "version", "begin").agg(two.alias("two")).where("two").drop("two")
    if near:
        window = F.floor(F.col("begin") / slop)
        spread = met.withColumn("window", F.explode(F.array(window, window - 1)))
        close = spread.groupBy("id", "item", "version", "window").agg(two.alias("two")).where("two")
        none = F.lit(None).cast("int")
        found = found.withColumn("near", none).unionByName(
            close.select("id", "item", "version", none.alias("begin"), (F.col("window") * slop).cast("int").alias("near"))
        )
    else:
        found = found.withColumn("near", F.lit(None).cast("int"))
    return found.groupBy("id", "item", "version").agg(F.collect_set("begin").alias("exact"), F.collect_set("near").alias("near"))


def _matched_from(text: np.ndarray, item: np.ndarray, begin: int) -> np.ndarray:
    """For each place of the item, and the one behind it, how many words from there on are those of the text, if the item began at `begin`."""
    low, high = max(0, -begin), min(len(item), len(text) - begin)
    same = np.zeros(len(item) + 1, bool)
    if low < high:
        same[low:high] = text[begin + low : begin + high] == item[low:high]
    at = np.arange(len(same))
    stop = np.minimum.accumulate(np.where(same, len(same), at)[::-1])[::-1]
    return stop - at


def stands_nearly(text: np.ndarray, item: np.ndarray, begins: range, size: int) -> bool:
    """Whether a window of the item stands in the text, at one of `begins` or next to one, with one word changed, dropped or added at most.

    A window is `size` words, or the whole of a shorter item; one of fewer than `NEAR_LEAST` words has no near match.
    """
    width = min(size, len(item))
    if width < NEAR_LEAST:
        return False
    start = np.arange(len(item) - width + 1)
    matched = {b: _matched_from(text, item, b) for b in range(begins.start - 1, begins.stop + 1)}
    for begin in begins:
        head = np.minimum(matched[begin][start], width)
        place, rest = start + head, width - head  # the first word that differs, and how many there are from it on
        # Changed: the words behind it are as they should be. Dropped: they come a word earlier. Added: it and they come a word later.
        after = np.minimum(place + 1, len(item))
        for other, at, needed in ((begin, after, rest - 1), (begin - 1, after, rest - 1), (begin + 1, place, rest)):
            if (matched[other][at] >= needed).any():
                return True
    return False


def _hits(words: list[bytes], found: list[dict], size: int) -> tuple[int, list[int], list[int]]:
    """Number of hit words; items with an occurring window; items with a proximity match alone."""
    hit = np.zeros(len(words) + 1, np.int32)
    exact, near = set(), set()
    number: dict[bytes, int] = {}
    of = lambda listed: np.array([number.setdefault(w, len(number)) for w in listed], np.int32)
    text = of(words)
    for one in found:
        item = of(one["words"].encode().split(b" "))
        width = min(size, len(item))
        same_item = False
        for begin in set(one["exact"] or ()):
            low, high = max(0, -begin), min(len(item), len(text) - begin)
            unlike = np.flatnonzero(text[begin + low : begin + high] != item[low:high])
            # Stretches between the places that differ.
            starts, ends = np.append(-1, unlike) + 1, np.append(unlike, high - low)
            for start, end in zip(starts[ends - starts >= width], ends[ends - starts >= width], strict=True):
                hit[begin + low + start] += 1
                hit[begin + low + end] -= 1
                same_item = True
        if same_item:
            exact.add(one["item"])
        elif one["item"] not in near and any(stands_nearly(text, item, range(b - 1, b + 2 * SLOP + 1), size) for b in one["near"] or ()):
            near.add(one["item"])
    in_order = lambda ids: sorted(ids, key=lambda i: (i is None, i or 0))
    return int((np.cumsum(hit) > 0).sum()), in_order(exact), in_order(near - exact)


def judge(
    docs: DataFrame,
    items: DataFrame,
    size: int = SIZE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    near: bool = False,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, near_items, contaminated), one row per row of `docs`.

    items: ids whose windows occur; near_items: ids with a proximity match and no window (with `near`): a window but for one word changed, dropped or added.
    """
    return _judge(docs, items, size, doc_id, text, item_id, item_text, near, block_words).drop("key")


def _judge(docs, items, size, doc_id="doc_id", text="text", item_id="item_id", item_text="text", near=False, block_words=BLOCK_WORDS) -> DataFrame:
    """`judge` with the row's key, by which what is found comes back to it: never null, and one for each id and text."""
    narrow(docs.sparkSession)
    texts = docs.select(_key(doc_id, text).alias("id"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    words = settle(item_words(items, item_id, item_text, size), "item-words")
    blocks = max(1, -(-words.count() // block_words))
    found = None
    for block in range(blocks):
        part = words if blocks == 1 else words.where(F.pmod(F.xxhash64("item", "version"), F.lit(blocks)) == block)
        found = found.unionByName(_look_up(texts, part, near)) if block else _look_up(texts, part, near)
    whole = words.groupBy("item", "version").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
    whole = whole.select("item", "version", F.array_join("w.word", " ").alias("words"))
    same = found["version"].eqNullSafe(whole["version"]) & found["item"].eqNullSafe(whole["item"])
    met = found.join(whole, same).select("id", found["item"], "words", "exact", "near").groupBy("id").agg(F.collect_list(F.struct("item", "words", "exact", "near")).alias("found"))
    return _compare(texts.join(settle(met, "alignments"), "id", "left").select("id", "text", "found", "doc_id"), size)


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = SIZE, doc_id: str = "doc_id", **names) -> DataFrame:
    """`docs` without the contaminated documents (all rows of a doc_id one of whose rows is; of a null one, the row itself)."""
    by_itself = lambda no_id, key: F.when(no_id, key).otherwise(F.lit(0))
    judged = _judge(docs, items, size, doc_id, **names).where("contaminated")
    gone = judged.select(F.col("doc_id").alias("gone"), by_itself(F.col("doc_id").isNull(), F.col("key")).alias("gone_key")).distinct()
    own_key = by_itself(docs[doc_id].isNull(), F.xxhash64(docs[doc_id], docs[names.get("text", "text")]))
    return docs.join(settle(gone, "contaminated"), docs[doc_id].eqNullSafe(F.col("gone")) & (own_key == F.col("gone_key")), "left_anti")


def _look_up(texts: DataFrame, part: DataFrame, near: bool) -> DataFrame:
    vocabulary = lambda df: {r[0].encode() for r in df.select("word").distinct().toLocalIterator()}
    counts = settle(word_counts(texts, vocabulary(part)), "word-counts")
    chosen = settle(probes(part, counts, NEAR_PROBES if near else PROBES), "probes")
    index = settle(postings(texts, vocabulary(chosen)), "postings")
    return settle(alignments(index, chosen, near), "alignments")


def _compare(joined: DataFrame, size: int) -> DataFrame:
    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            out = []
            for text, found in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = word_bytes(text)
                out.append((len(words), *(_hits(words, found, size) if found else (0, [], []))))
            n, hit, exact, near = zip(*out, strict=True) if out else ((), (), (), ())
            columns = [pa.array(n, pa.int64()), pa.array(hit, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (exact, near))]
            names = ["doc_id", "n_words", "n_hit", "items", "near_items", "key"]
            yield pa.RecordBatch.from_arrays([batch.column(3), *columns, batch.column(0)], names=names)

    judged = joined.mapInArrow(lean(run), "doc_id long, n_words long, n_hit long, items array<long>, near_items array<long>, key long")
    return judged.withColumn("contaminated", F.col("n_hit") > 0)


def _contract(judged: DataFrame, *more: Column) -> DataFrame:
    as_text = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(as_text, ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        *more,
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contract(judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op3_decontaminate and the items that stand in a text nearly (`near_items`)."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    return _contract(judged, F.size("near_items").cast("long").alias("n_near_items"), F.col("near_items"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
), ks AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k)
), occ AS (SELECT DISTINCT doc_id, item_id, s, dw.k AS k FROM dw JOIN win ON dw.phrase = win.phrase AND dw.k = win.k),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
