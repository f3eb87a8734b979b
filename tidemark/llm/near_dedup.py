"""Near-duplicate texts: DartMinHash signatures, banded joining, exact check.

Signature. A text is a weighted set of hashed word 5-shingles. Each element owns a
strip [0, weight) x [0, infinity) of the plane weight x rank and throws darts into
it at rate 1: the strip is cut into cells, a hash of (element, cell) gives the
Poisson number of darts in a cell, further hashes their weights, ranks and
coordinates. The darts of an element are the same in every text; a text sees those
below its weight. Keeping the earliest dart (lowest rank) of each of k coordinates
gives k samples that two texts share with the probability of their weighted
Jaccard similarity. Only ranks up to about k(ln k + 3) / total weight are looked
at (later ones where a coordinate stayed empty), so the work is k log k + elements.

Join. Texts with equal shingle sets are one class, stood for by its smallest
doc_id. Each class puts r coordinates a band into b buckets. In a bucket, all are
paired with its smallest member (linear, whatever its size); pairs are checked
exactly. Buckets whose members are not yet in one component are then searched for links
between different components: small ones as pairs, larger ones in blocks of a fixed
size, two blocks a task, from which only links come out. At similarity 0.8 a pair shares no bucket with a
probability of (1 - 0.8^r)^b, 3e-6 for the defaults. Links are exact: none below
the threshold counts. Components of the links are the groups.

Defined cases: a null or empty text, or one without a word, links with nothing; a
text of fewer words than a shingle is one shingle of all its words; rows with the
same doc_id are one document (if their texts differ, links are checked on the largest
of them); a row without a doc_id is no document that a group could be named by: it is returned by itself, kept, without a
class or component; texts of any length share a block with few others; extra columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTES, batches, lean, narrow, settle, table
from tidemark.llm.components import components
from tidemark.llm.hashing import hash_spans, mix, seeded, shingle_hashes, unit, word_spans

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
BATCH_BYTES = 2 << 20
# Buckets of more members are compared block by block inside tasks; of fewer, as rows of pairs.
LISTED = 16
BLOCK = 128
# A block has about so many shingles besides, so very long texts are few in a block.
BLOCK_SHINGLES = 1 << 20
# Shingles that are compared at a time.
COLUMNS = 4096

# Rank cells are [0, FIRST), [FIRST, 2 FIRST), [2 FIRST, 4 FIRST) ...
FIRST_RANK = 0.125


def weighted_shingles(text: bytes | None, size: int = WORDS, counted: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text in ascending order, and their weights: 1, or how often each stands there."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0)
    data = np.frombuffer(text.translate(WORD_BYTES), np.uint8)
    found, counts = np.unique(shingle_hashes(hash_spans(data, *word_spans(data)), size), return_counts=True)
    return found, counts.astype(np.float64) if counted else np.ones(len(found))


_CDF: dict[float, np.ndarray] = {}


def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2 ... darts in a cell of this area."""
    if mean not in _CDF:
        n = np.arange(int(mean + 12 * math.sqrt(mean) + 24))
        logs = n * math.log(mean) - mean - np.cumsum(np.log(np.maximum(n, 1)))
        _CDF[mean] = np.minimum(np.cumsum(np.exp(logs)), 1.0)
    return _CDF[mean]


def _throw(
    element: np.ndarray, weight: np.ndarray, owner: np.ndarray, limit: np.ndarray, k: int, ranks: np.ndarray
) -> None:
    """Lower ranks[owner, coordinate] to the earliest dart, of those below each owner's limit."""
    flat = ranks.reshape(-1)
    rank_cell, low = 0, 0.0
    while len(element) and low < limit.max():
        high = FIRST_RANK * 2.0**rank_cell
        weight_cell, left = 0, 0.0
        near = limit[owner] > low
        e_all, w_all, o_all = element[near], weight[near], owner[near]
        while len(e_all) and left < w_all.max():
            right = 2.0**weight_cell
            cell = seeded(e_all, 1 + rank_cell * 64 + weight_cell)
            darts = np.searchsorted(_poisson((right - left) * (high - low)), unit(cell), side="right")
            index = np.repeat(np.arange(len(darts)), darts)
            if len(index):
                nth = np.arange(len(index)) - np.repeat(np.cumsum(darts) - darts, darts)
                dart = mix(cell[index] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                rank = low + (high - low) * unit(seeded(dart, 3))
                seen = rank < limit[o_all[index]]
                if right > 1 or w_all.min() < 1:
                    seen &= left + (right - left) * unit(seeded(dart, 4)) < w_all[index]
                place = o_all[index[seen]] * k + (seeded(dart[seen], 5) % np.uint64(k)).astype(np.int64)
                np.minimum.at(flat, place, rank[seen])
            weight_cell, left = weight_cell + 1, right
            near = w_all > left
            e_all, w_all, o_all = e_all[near], w_all[near], o_all[near]
        rank_cell, low = rank_cell + 1, high


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """k ranks for each weighted set, which stand for the darts that have them; empty sets get infinity."""
    ranks = np.full((len(sets), k), np.inf)
    total = np.array([w.sum() for _, w in sets])
    todo = np.flatnonzero(total > 0)
    limit, factor = np.zeros(len(sets)), 1
    while len(todo):
        limit[:] = 0
        limit[todo] = factor * k * (math.log(k) + 3) / total[todo]
        elements, weights = (np.concatenate([sets[i][part] for i in todo]) for part in (0, 1))
        _throw(elements, weights, np.repeat(todo, [len(sets[i][0]) for i in todo]), limit, k, ranks)
        todo, factor = todo[np.isinf(ranks[todo]).any(1)], 2 * factor  # a coordinate without a dart: look further
    return ranks


def band_keys(ranks: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature, different in each band."""
    bits = ranks.view(np.uint64).reshape(len(ranks), bands, rows)
    total = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2])
    for i in range(rows):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return total


def sign(
    docs: DataFrame, size: int = WORDS, bands: int = BANDS, rows: int = ROWS, counted: bool = False
) -> DataFrame:
    """(id, n, h1, h2, bands) of each row of (id, text): number of shingles, a hash of the whole set, band keys."""

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            sets = [weighted_shingles(t, size, counted) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            keys = band_keys(signatures(sets, bands * rows), bands, rows).view(np.int64)
            own = [mix(e + w.astype(np.uint64)) for e, w in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(e) for e, _ in sets], pa.int64()),
                    pa.array(np.array([np.bitwise_xor.reduce(x, initial=0) for x in own], np.uint64).view(np.int64)),
                    pa.array(np.array([np.add.reduce(mix(x), initial=0) for x in own], np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands, keys.reshape(-1)),
                ],
                names=["id", "n", "h1", "h2", "bands"],
            )

    return docs.select("id", "text").mapInArrow(lean(run), "id long, n long, h1 long, h2 long, bands array<long>")


def shingle_rows(docs: DataFrame, size: int = WORDS, counted: bool = False) -> DataFrame:
    """(id, shingles): distinct hashes of each (id, text); if `counted`, the n-th copy of a shingle has a hash of its own.

    So the similarity of two lists as sets is the weighted one of the counts.
    """

    def listed(text: bytes | None) -> np.ndarray:
        found, weights = weighted_shingles(text, size, counted)
        copies = weights.astype(np.int64)
        nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        return mix(np.repeat(found, copies) + nth.astype(np.uint64)) if counted else found

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            sets = [listed(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            hashes = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, hashes)], names=["id", "shingles"])

    return docs.select("id", "text").mapInArrow(lean(run), "id long, shingles array<long>")


def links(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of the pairs whose similarity, counted exactly, is at least `similarity`."""
    side = lambda s: sets.select(F.col("id").alias(s), F.col("shingles").alias(f"{s}_set"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    common = joined.select("a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("n"), (F.size("a_set") + F.size("b_set")).alias("all"))
    value = F.col("n") / (F.col("all") - F.col("n"))
    return common.select("a", "b", value.alias("similarity")).where(F.col("similarity") >= similarity)


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many hashes each list of x shares with each list of y."""
    flat_x, flat_y = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(flat_x, flat_y)
    total = np.zeros((len(x), len(y)), np.float32)
    spots = []
    for lists, flat in ((x, flat_x), (y, flat_y)):
        row = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        place = np.searchsorted(both, flat)
        held = place < len(both)
        held[held] = both[place[held]] == flat[held]
        order = np.argsort(place[held], kind="stable")
        spots.append((row[held][order], place[held][order]))
    for begin in range(0, len(both), COLUMNS):
        part = []
        for lists, (row, place) in zip((x, y), spots, strict=True):
            low, high = np.searchsorted(place, (begin, begin + COLUMNS))
            matrix = np.zeros((len(lists), COLUMNS), np.float32)
            matrix[row[low:high], place[low:high] - begin] = 1
            part.append(matrix)
        total += part[0] @ part[1].T
    return total


_BLOCK = "ids binary, components binary, lengths binary, shingles binary"


def block_links(
    members: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """(a, b): links between members (key, id, component, members, total) of one bucket that are in different components.

    members, total: how many members the bucket has, and how many shingles these have. A bucket's members are dealt
    by hash into blocks of about `block` members and `block_shingles` shingles at most; every two blocks are a row, compared inside a task.
    """

    def pack(group: pa.Table) -> pa.Table:
        lists = group.column("shingles").combine_chunks()
        packed = [
            group.column("id").to_numpy(),
            group.column("component").to_numpy(),
            pa.compute.list_value_length(lists).to_numpy().astype(np.int64),
            lists.flatten().to_numpy(),
        ]
        first = [group.column(c).slice(0, 1) for c in ("key", "block")]
        return pa.table([*first, *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in packed)], names=["key", "block", "ids", "components", "lengths", "shingles"])

    def unpack(row: dict) -> tuple:
        ids, component, lengths, flat = (np.frombuffer(row[c], np.int64) for c in ("ids", "components", "lengths", "shingles"))
        return ids, component, lengths, np.split(flat, np.cumsum(lengths)[:-1])

    def compare(source):
        for batch in source:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                (a, ca, na, xa), (b, cb, nb, xb) = unpack(row["x"]), unpack(row["y"])
                common = common_counts(xa, xb)
                linked = common / (na[:, None] + nb - common) >= similarity
                i, j = np.nonzero(linked & (ca[:, None] != cb))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[i], b[j])), pa.array(np.maximum(a[i], b[j]))], names=["a", "b"])

    blocks = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("total") / block_shingles)).cast("int")
    dealt = members.select("key", "id", "component", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"))
    counts = dealt.select("key", "blocks").distinct()
    rows = dealt.join(sets, "id").groupBy("key", "block").applyInArrow(pack, f"key long, block int, {_BLOCK}")
    rows = settle(rows, "blocks").join(counts, "key")
    whole, number = F.struct("ids", "components", "lengths", "shingles"), F.col("block")
    left = rows.select("key", number.alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), whole.alias("x"))
    right = rows.select("key", F.explode(F.sequence(F.lit(0), "block")).alias("i"), number.alias("j"), whole.alias("y"))
    return left.join(right, ["key", "i", "j"]).select("x", "y").mapInArrow(lean(compare), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    size: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    counted: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept): one row per document.

    class_id is the smallest document with the same shingles, component_id the smallest
    one reachable by links; kept is true for that one alone.
    """
    narrow(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    signed = settle(sign(texts, size, bands, rows, counted), "signatures")
    nameless = signed.where("id IS NULL")
    signed = signed.where("id IS NOT NULL")
    worded = signed.where("n > 0")
    classes = worded.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    reps = worded.join(classes.select("h1", "h2", F.col("rep").alias("id")), ["h1", "h2", "id"], "left_semi")
    buckets = settle(_shared_buckets(reps.select("id", "n", F.explode("bands").alias("key")).distinct()), "buckets")

    near = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)
    first = buckets.where("id <> low").where(near("n", "low_n") if not counted else F.lit(True))
    first = settle(first.select(F.col("low").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    sets = _sets(texts, buckets, size, counted)
    found = settle(links(first, sets, similarity), "links")

    # Buckets that still hold several components: pairs between those.
    comp = components(found)
    placed = buckets.join(comp, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("members"), F.sum("n").alias("total")
    )
    placed = settle(placed.join(mixed.where("least <> most").select("key", "members", "total"), "key"), "mixed")
    few = placed.where(F.col("members") <= LISTED)
    x, y = few.alias("x"), few.alias("y")
    across = x.join(y, F.col("x.key") == F.col("y.key")).where(
        (F.col("x.component") < F.col("y.component"))
        & (near(F.col("x.n"), F.col("y.n")) if not counted else F.lit(True))
    )
    across = across.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    second = settle(across.join(first, ["a", "b"], "left_anti"), "pairs")
    more = links(second, sets, similarity).select("a", "b").unionByName(
        block_links(placed.where(F.col("members") > LISTED), sets, similarity)
    )
    groups = components(found.select("a", "b").unionByName(more))

    member = signed.join(classes, ["h1", "h2"], "left").select("id", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("id")).alias("rep"))
    placed = member.join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    one = placed.groupBy("id").agg(
        F.max("n").alias("n_shingles"), F.min("rep").alias("class_id"), F.min(F.coalesce("component", "rep")).alias("component_id")
    )
    none = F.lit(None).cast("long")
    alone = nameless.select(none.alias("doc_id"), F.col("n").alias("n_shingles"), none.alias("class_id"), none.alias("component_id"), F.lit(True).alias("kept"))
    return one.select(
        F.col("id").alias("doc_id"), "n_shingles", "class_id", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    ).unionByName(alone)


def _shared_buckets(rows: DataFrame) -> DataFrame:
    """(key, id, n, low, low_n) for the buckets with two members or more; low is the smallest member."""
    low = rows.groupBy("key").agg(F.min("id").alias("low"), F.min_by("n", "id").alias("low_n"), F.count("*").alias("members"))
    return rows.join(low.where("members > 1").drop("members"), "key")


def _sets(texts: DataFrame, needed: DataFrame, size: int, counted: bool) -> DataFrame:
    """Shingles of the documents that stand in a shared bucket; of several texts with one id, of the largest."""
    ids = settle(needed.select("id").distinct(), "bucketed")
    one = texts.join(ids, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text"))
    return settle(shingle_rows(one, size, counted), "shingles")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
