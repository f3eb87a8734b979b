"""Ranked lexical search: the best documents for each item, by branch and bound over trees of documents.

1. A document is cut down to the terms that some item has, with their occurrences, and stored; it keeps its own
   number of terms. Documents per term, documents and terms in all are counted over the whole table.
2. Document trees. A task orders each document's terms by how many documents hold them, most first, and puts
   the documents into a prefix tree, `TREE_DOCS` of them a tree: documents share the path of their common first
   terms. Each node knows the most occurrences of each term below it, and the smallest m below it.
3. Search. A term's part of a score grows with its occurrences and falls with m, so a node's maxima and minimum
   bound all scores below it. For each item a tree is gone through depth first, best branch first; a branch
   that cannot reach the item's lowest kept score is cut off. Documents of a leaf that is reached are scored.
4. A fixed share of all documents is searched first; its lowest kept scores are known to all tasks that
   search the rest, so a task returns few documents, and these alone are shuffled to be ranked.

Items are worked on in blocks of `BLOCK_TERMS` terms (and the last item's, which is one text's), so what travels to a
task has a fixed bound; more items are more passes over the documents, never a join of both tables. All numbers of
scores are 64-bit integers.

Defined cases: null or empty texts have no terms: such items have no results, such documents are never found and not
counted; an item repeats its terms if its text does; rows that share an item_id, or have a null one, are
items each by itself, with results each; documents that share a doc_id, or have a null one, are found each by its own text
(a null doc_id comes last among equal scores); empty tables give no rows; extra columns do not matter.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, settle, table, word_bytes

MOST = 10
BLOCK_TERMS = 200_000
BATCH_BYTES = 8 << 20
TREE_DOCS = 4_096
# A tree has at most so many pairs of document and term (or one document).
TREE_PAIRS = 1_000_000
LEAF_DOCS = 16
# One document in so many is searched first.
FIRST_SHARE = 16

# Fixed values of the score: b as parts in a hundred, and the scale of a term's part.
SHORT, LONG, SCALE = 100 - 75, 75, 1_000_000_000


def numbered_items(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(number, item_id, terms, times, part, upto) of each item with a term; upto counts the terms of its part so far. To be stored."""

    def run(source):
        part, upto, row = TaskContext.get().partitionId(), 0, 0
        for batch in source:
            number, item, terms, times, ends = [], [], [], [], []
            for i, text_ in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                own = Counter(word_bytes(text_))
                if own:
                    number.append((part << 40) + row)
                    row += 1
                    item.append(i)
                    terms.append([t.decode() for t in own])
                    times.append(list(own.values()))
                    upto += len(own)
                    ends.append(upto)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number, pa.int64()),
                    batch.column(0).take(pa.array(item, pa.int64())),
                    pa.array(terms, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int64())),
                    pa.array([part] * len(number), pa.int32()),
                    pa.array(ends, pa.int64()),
                ],
                names=["number", "item_id", "terms", "times", "part", "upto"],
            )

    kind = items.schema[item_id].dataType.simpleString()
    schema = f"number long, item_id {kind}, terms array<string>, times array<long>, part int, upto long"
    return items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def blocks(stored: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[DataFrame]:
    """The items in blocks: each ends with the item that brings it to `block_terms` terms."""
    per_part = stored.groupBy("part").agg(F.max("upto").alias("n"))  # a row for each file of the table
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    placed = stored.join(ahead, "part").withColumn("block", F.floor((F.col("ahead") + F.col("upto") - 1) / block_terms))
    numbers = [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]  # a number for each pass
    for number in numbers:
        yield placed.where(F.col("block") == number)


def vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, times) of each (doc_id, text): its terms in all, and those of `vocabulary` (a broadcast of term to number), packed."""

    def run(source: Iterator[pa.RecordBatch]):
        number = vocabulary.value.get
        for batch in batches(BATCH_BYTES)(source):
            n, terms, times = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = word_bytes(text)
                own = Counter(map(number, words))
                own.pop(None, None)
                n.append(len(words))
                terms.append(np.fromiter(own, "<i4", len(own)).tobytes())
                times.append(np.fromiter(own.values(), "<i4", len(own)).tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms binary, times binary")


def holders(stored: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of `size` terms; summed up in tasks first."""

    def run(source):
        counts = np.zeros(size, np.int64)
        for batch in source:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")
            counts += np.bincount(flat, minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["term", "n"])

    counted = stored.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most a row for each term of the block
    counts = np.zeros(size, np.int64)
    counts[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return counts


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def _merged(terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms, ascending, with the most times of each."""
    order = np.argsort(terms, kind="stable")
    along = terms[order]
    begins = np.flatnonzero(np.diff(along, prepend=-1))
    return along[begins], np.maximum.reduceat(times[order], begins)


def part(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score, before its weight."""
    return SCALE * times // (1000 * times + 8 * m)


class Tree:
    """Documents in a prefix tree over their terms, which are ranks: the term in most documents is 0.

    Documents are kept in the order of the tree, so a node is a stretch [begin, end) of them. Nodes are numbered
    depth first; a node's subtree is the stretch of numbers up to `after`.
    """

    def __init__(self, docs: list[tuple[int | None, int, np.ndarray, np.ndarray]], leaf_docs: int = LEAF_DOCS):
        """docs: (doc_id, m, ranks ascending, times of each)."""
        docs = sorted(docs, key=lambda d: d[2].astype(">u4").tobytes())
        self.ids = [d[0] for d in docs]
        self.paths = [d[2] for d in docs]
        m = np.array([d[1] for d in docs], np.int64)
        sizes = np.array([len(p) for p in self.paths], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.terms = np.concatenate(self.paths)
        times = np.concatenate([d[3] for d in docs]).astype(np.int64)
        self.parts = part(times, np.repeat(m, sizes))
        self.begin: list[int] = []
        self.end: list[int] = []
        self.after: list[int] = []
        self.children: list[list[int]] = []
        tops: list[tuple[np.ndarray, np.ndarray]] = []
        lows: list[int] = []
        self._grow(leaf_docs, m, times, tops, lows)
        # For each term the nodes that have it below them, and the bound on its part there.
        counts = np.array([len(t) for t, _ in tops], np.int64)
        node = np.repeat(np.arange(len(tops)), counts)
        term, most = (np.concatenate(x) for x in zip(*tops, strict=True))
        bound = part(most, np.array(lows, np.int64)[node])
        order = np.argsort(term, kind="stable")
        self.node, self.bound = node[order], bound[order]
        self.known, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(order))

    def _grow(self, leaf_docs, m, times, tops, lows) -> None:
        """Number the nodes from the root down, then fill in their maxima from the leaves up."""
        work = [(0, len(self.paths), 0, -1)]
        while work:
            begin, end, depth, parent = work.pop()
            number = len(self.begin)
            self.begin.append(begin)
            self.end.append(end)
            self.after.append(number + 1)
            self.children.append([])
            tops.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            lows.append(int(m[begin:end].min()))
            if parent >= 0:
                self.children[parent].append(number)
            if end - begin > leaf_docs:
                # The first path is a prefix of none or sorts first, so both ends of the stretch tell what all share.
                shared = _shared(self.paths[begin], self.paths[end - 1], depth)
                cuts = self._branches(begin, end, shared)
                if len(cuts) > 2:
                    work += [(a, b, shared, number) for a, b in zip(cuts[:-1], cuts[1:], strict=True)][::-1]
        for number in range(len(self.begin) - 1, -1, -1):
            own = self.children[number]
            if own:
                self.after[number] = max(self.after[child] for child in own)
                tops[number] = _merged(*(np.concatenate(x) for x in zip(*(tops[child] for child in own), strict=True)))
            else:
                held = slice(self.starts[self.begin[number]], self.starts[self.end[number]])
                tops[number] = _merged(self.terms[held], times[held])

    def _branches(self, begin: int, end: int, depth: int) -> list[int]:
        """Where the documents of [begin, end) part by the term at `depth`; those that end there come first."""
        cuts, last = [begin], None
        for i in range(begin, end):
            path = self.paths[i]
            here = int(path[depth]) if len(path) > depth else -1
            if last is not None and here != last:
                cuts.append(i)
            last = here
        return [*cuts, end]

    def bounds(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each node what no document below it scores above."""
        total = np.zeros(len(self.begin), np.int64)
        at = np.searchsorted(self.known, terms)
        for i, w in zip(at, weight, strict=True):
            if i < len(self.known):
                own = slice(self.first[i], self.first[i + 1])
                total[self.node[own]] += w * self.bound[own]
        return total

    def search(self, terms: np.ndarray, weight: np.ndarray, dense: np.ndarray, best: Best) -> None:
        """Offer `best` every document that may belong to it. terms: ascending ranks the tree may have; dense: zeros for all ranks."""
        terms, weight = _present(self.known, terms, weight)
        if not len(terms):
            return
        bounds = self.bounds(terms, weight)
        dense[terms] = weight
        stack = [0]
        while stack:
            node = stack.pop()
            if not best.may_take(int(bounds[node])):
                continue
            own = self.children[node]
            if own:
                stack += sorted((child for child in own if best.may_take(int(bounds[child]))), key=bounds.__getitem__)
                continue
            begin, end = self.begin[node], self.end[node]
            held = slice(self.starts[begin], self.starts[end])
            scores = np.add.reduceat(dense[self.terms[held]] * self.parts[held], self.starts[begin:end] - self.starts[begin])
            for i in np.flatnonzero(scores >= best.least):
                best.offer(int(scores[i]), self.ids[begin + i])
        dense[terms] = 0


def _shared(a: np.ndarray, b: np.ndarray, from_: int) -> int:
    """How many first terms two paths share; at least `from_`."""
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[from_:n] != b[from_:n])
    return from_ + int(unlike[0]) if len(unlike) else n


def _present(known: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    here = known[at] == terms
    return terms[here], weight[here]


class Best:
    """The documents kept for an item: the `most` best, equal scores by ascending doc_id, a null one last."""

    def __init__(self, most: int, floor: int):
        self.most, self.floor = most, max(floor, 1)
        self.heap: list[tuple[int, int, int]] = []

    @property
    def least(self) -> int:
        """A score below this cannot be kept; one equal to it may."""
        return max(self.floor, self.heap[0][0]) if len(self.heap) == self.most else self.floor

    def may_take(self, bound: int) -> bool:
        return bound >= self.least

    def offer(self, score: int, doc: int | None) -> None:
        if score < self.floor:
            return
        entry = (score, 0 if doc is None else 1, 0 if doc is None else -doc)
        if len(self.heap) < self.most:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> list[tuple[int | None, int]]:
        return [(-doc if named else None, score) for score, named, doc in self.heap]


def best_of_tasks(stored: DataFrame, queries, n_docs: int, n_terms: int, most: int = MOST, tree_docs: int = TREE_DOCS) -> DataFrame:
    """(number, doc_id, score): of each task the `most` best documents of each item, but none below the item's floor.

    queries: a broadcast of (rank of each term, weight of each rank, [(number, ranks, times, floor)]).
    """

    def trees(source):
        rank = queries.value[0]
        docs, pairs = [], 0
        for batch in source:
            for doc, n, terms, times in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                own = rank[np.frombuffer(terms, "<i4")]
                if not len(own):
                    continue
                order = np.argsort(own)
                if docs and (len(docs) == tree_docs or pairs + len(own) > TREE_PAIRS):
                    yield Tree(docs)
                    docs, pairs = [], 0
                docs.append((doc, SHORT + LONG * n * n_docs // n_terms, own[order], np.frombuffer(times, "<i4")[order]))
                pairs += len(own)
        if docs:
            yield Tree(docs)

    def run(source):
        _, weight, items = queries.value
        kept = [Best(most, floor) for *_, floor in items]
        dense = np.zeros(len(weight), np.int64)
        for tree in trees(source):
            for best, (_, ranks, times, _) in zip(kept, items, strict=True):
                tree.search(ranks, weight[ranks] * times, dense, best)
        out = [(item[0], doc, score) for item, best in zip(items, kept, strict=True) for doc, score in best.rows()]
        number, doc, score = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (number, doc, score)], names=["number", "doc_id", "score"])

    return stored.select("doc_id", "n", "terms", "times").mapInArrow(run, "number long, doc_id long, score long")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = MOST,
    block_terms: int = BLOCK_TERMS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    tree_docs: int = TREE_DOCS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `most` best documents of each item, of a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    listed = settle(numbered_items(items, item_id, item_text), "search-items")
    results = [
        _search_block(spark, texts, block, most, tree_docs) for block in blocks(listed, block_terms)
    ]
    if not results:
        none = spark.createDataFrame([], "number long, doc_id long, score long")
        results = [_ranked(none, most)]
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found.join(listed.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def _search_block(spark: SparkSession, texts: DataFrame, block: DataFrame, most: int, tree_docs: int) -> DataFrame:
    context = spark.sparkContext
    rows = block.select("number", "terms", "times").collect()  # a block of items
    listed = sorted({t for row in rows for t in row["terms"]})
    number = {t: i for i, t in enumerate(listed)}
    vocabulary = context.broadcast({t.encode(): i for t, i in number.items()})
    stored = settle(vectors(texts, vocabulary), "search-vectors")
    vocabulary.destroy()
    n_docs, n_terms = stored.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = holders(stored, len(listed))
    rank = np.empty(len(listed), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(listed))
    weight = np.empty(len(listed), np.int64)
    weight[rank] = weights(df, n_docs)
    asked = []
    for row in rows:
        own = rank[[number[t] for t in row["terms"]]]
        order = np.argsort(own)
        asked.append((row["number"], own[order], np.array(row["times"], np.int64)[order]))

    def found(share: DataFrame, floors: dict[int, int], label: str) -> DataFrame:
        queries = context.broadcast((rank, weight, [(*item, floors.get(item[0], 1)) for item in asked]))
        done = settle(best_of_tasks(share, queries, n_docs, max(n_terms, 1), most, tree_docs), label)
        queries.destroy()
        return done

    # The n-th best score of some documents is one that all documents together reach, so nothing below it is of use.
    is_first = F.pmod(F.xxhash64("terms", "times", "doc_id"), F.lit(FIRST_SHARE)) == 0
    first = found(stored.where(is_first), {}, "search-first")
    lowest = _ranked(first, most).where(F.col("rank") == most).select("number", "score").collect()  # a row for each item of the block
    rest = found(stored.where(~is_first), {r["number"]: r["score"] for r in lowest}, "search-rest")
    return _ranked(first.unionByName(rest), most)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

OP11_SQL = f"""
WITH tf AS (
  SELECT row, doc_id, term, count(*) AS tf
  FROM (SELECT row, doc_id, {_TERMS} AS term FROM (SELECT *, row_number() OVER () AS row FROM documents)) GROUP BY ALL
), d AS (SELECT row, doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
m AS (SELECT row, CAST(100 - 75 + (75 * n * n_docs) // n_terms AS BIGINT) AS m FROM d, c),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, c GROUP BY term
), q AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT item, item_id, {_TERMS} AS term FROM (SELECT *, row_number() OVER () AS item FROM benchmark)) GROUP BY ALL
), scored AS (
  SELECT item, item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""
