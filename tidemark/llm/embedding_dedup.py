"""Near-duplicate embeddings: int8 tile products with error bounds, exact recheck.

1. Equal vectors are one class, counted before anything is compared.
2. Each class vector, scaled to length 1, is quantised to int8 with its own scale s.
   The length e of what quantisation lost is measured per vector, so for every pair
       |x.y - s_x s_y (q_x.q_y)| <= e_x |s_y q_y| + e_y.
3. Classes are dealt by hash into blocks of about `BLOCK` vectors, each packed into
   one row; every two blocks form a tile, one row of a join, multiplied whole. Integer products
   are exact in single precision here, as long as their sums stay below 2^24 (longer
   vectors are multiplied in stretches).
4. Pairs that may reach the threshold by the bound are computed again in double
   precision from the vectors themselves, in the tile's task. No pair at or above it is lost, none below is kept.
5. A tile hands on how many vectors each of its classes links with, and a spanning forest of its links: fewer rows than
   it has vectors, however many links there are. Sums of the first are the link counts, components
   of the second the groups.

Comparing all vectors with all others is quadratic by its nature: pairs per task are
bounded by the block, and no pair becomes a row.

Defined cases: null and empty vectors, zero vectors and those that hold a null or non-finite component
link with nothing; vectors of different lengths do not link; rows repeated whole count
once; a vec_id with several vectors gives one row for each, each a vector by itself with links of its own (that they share
an id links them no more than others); a vector without a vec_id is linked and counted as any other, never names a component, and
is kept only if no vector of its component has an id; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import settle, table
from tidemark.llm.components import components

THRESHOLD = 0.9
BLOCK = 4096
# Rows of a tile that are multiplied at a time, and pairs that are computed again at a time.
STRIP = 512
PAIRS = 1 << 15
_EXACT = 1 << 24


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """codes, scales, lengths of the quantised vectors, and bounds of the length of what was lost."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    slack = 1e-12  # for the rounding of these sums themselves
    return codes, scale, np.linalg.norm(back, axis=1) + slack, np.linalg.norm(unit - back, axis=1) + slack


def candidate_strips(left: tuple, right: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs of two quantised blocks whose cosine may reach the threshold, strip by strip; i < j in one block."""
    (a, sa, _, ea), (b, sb, nb, eb) = left, right
    dims = a.shape[1]
    step = max(1, _EXACT // (127 * 127))
    b32 = b.astype(np.float32)
    for begin in range(0, len(a), STRIP):
        strip = a[begin : begin + STRIP].astype(np.float32)
        if dims <= step:
            product = strip @ b32.T
        else:
            product = sum((strip[:, d : d + step] @ b32[:, d : d + step].T).astype(float) for d in range(0, dims, step))
        # First with the largest bound of the block, then with each pair's own.
        least = (threshold - 1e-6 - ea[begin : begin + STRIP] * nb.max() - eb.max()) / sa[begin : begin + STRIP]
        i, j = np.nonzero(product * sb.astype(product.dtype) >= (least * (1 - 1e-6 * np.sign(least))).astype(product.dtype)[:, None])
        if same:
            i, j = i[begin + i < j], j[begin + i < j]
        value = product[i, j].astype(float) * sa[begin + i] * sb[j]
        may = value + ea[begin + i] * nb[j] + eb[j] >= threshold - 1e-9
        yield begin + i[may], j[may]


def candidates(left: tuple, right: tuple, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The same of all strips."""
    first, second = zip(*candidate_strips(left, right, threshold, same), strict=True)
    return np.concatenate(first), np.concatenate(second)


def exact(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (x[i], y[j]) have a cosine of at least the threshold in double precision."""
    told = np.empty(len(i), bool)
    for begin in range(0, len(i), PAIRS):
        p, q = x[i[begin : begin + PAIRS]], y[j[begin : begin + PAIRS]]
        dot, own, other = (np.einsum("nd,nd->n", *sides) for sides in ((p, q), (p, p), (q, q)))
        told[begin : begin + PAIRS] = dot / (np.sqrt(own) * np.sqrt(other)) >= threshold
    return told


def forest(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, i, j): trees joined by the links (i, j), and the links that joined them.

    labels: for each node the number of its tree, the least node in it. Each round hooks every tree that has a
    link to a lower one under the lowest of them, so no circle can come about.
    """
    taken_i, taken_j = [], []
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        high, low = np.maximum(a, b), np.minimum(a, b)
        order = np.lexsort((low, high))
        first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
        taken_i.append(i[first])
        taken_j.append(j[first])
        parent = np.arange(len(labels))
        parent[high[first]] = low[first]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        labels = parent[labels]
    none = np.empty(0, np.int64)
    return labels, np.concatenate([none, *taken_i]), np.concatenate([none, *taken_j])


def comparable(vector: Column) -> Column:
    values = F.transform(vector, lambda x: x.cast("double"))
    infinite = (float("inf"), float("-inf"))
    bad = lambda x: x.isNull() | F.isnan(x) | x.isin(*infinite)
    return F.coalesce((F.size(values) > 0) & ~F.exists(values, bad) & F.exists(values, lambda x: x != 0), F.lit(False))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by the power of two that brings its largest component near 1: exact, and its square stays in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def _pack(group: pa.Table) -> pa.Table:
    vectors = _scaled(np.array(group.column("vector").to_pylist(), float))
    codes, scale, length, lost = quantise(vectors)
    first = lambda name: group.column(name).slice(0, 1)
    numbers = [group.column(name).to_numpy().astype(np.int64) for name in ("id", "size")]
    packed = [*numbers, codes, scale, length, lost, vectors]
    return pa.table(
        [first("dims"), first("block"), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in packed)],
        names=["dims", "block", *_COLUMNS],
    )


_COLUMNS = ("ids", "sizes", "codes", "scale", "length", "lost", "vectors")
_PACKED = "dims int, block int, " + ", ".join(f"{c} binary" for c in _COLUMNS)


def tiles(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for every two blocks (or a block with itself) of (id, size, vector) with equal dimensions: x and y."""
    sized = vectors.withColumn("dims", F.size("vector"))
    many = sized.groupBy("dims").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = sized.join(many, "dims").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    packed = dealt.select("dims", "blocks", "block", "id", "size", "vector")
    counts = packed.select("dims", "blocks").distinct()
    rows = settle(packed.groupBy("dims", "block").applyInArrow(_pack, _PACKED), "blocks").join(counts, "dims")
    whole = F.struct(*_COLUMNS)
    block_ = F.col("block")
    left = rows.select("dims", block_.alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), whole.alias("x"))
    right = rows.select("dims", F.explode(F.sequence(F.lit(0), "block")).alias("i"), block_.alias("j"), whole.alias("y"))
    return left.join(right, ["dims", "i", "j"])


def _unpacked(row: dict, dims: int) -> tuple:
    codes = np.frombuffer(row["codes"], np.int8).reshape(-1, dims)
    return (codes, *(np.frombuffer(row[c]) for c in ("scale", "length", "lost")))


COUNT, LINK = 0, 1


def tile_links(tile_rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(kind, a, b) of every tile: COUNT, a class and the vectors of the tile that each of its vectors links with in other classes;
    LINK, two classes of a spanning forest of the tile's links."""

    def run(source):
        for batch in source:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                x, y, same = row["x"], row["y"], row["i"] == row["j"]
                (ids_x, ids_y), (sizes_x, sizes_y) = (
                    [np.frombuffer(side[c], np.int64) for side in (x, y)] for c in ("ids", "sizes")
                )
                exact_x, exact_y = (np.frombuffer(side["vectors"]).reshape(-1, row["dims"]) for side in (x, y))
                ahead = 0 if same else len(ids_x)
                ids = ids_x if same else np.concatenate([ids_x, ids_y])
                linked, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
                edges: list[tuple[np.ndarray, np.ndarray]] = []
                for i, j in candidate_strips(_unpacked(x, row["dims"]), _unpacked(y, row["dims"]), threshold, same):
                    true = exact(exact_x, exact_y, i, j, threshold)
                    i, j = i[true], j[true]
                    # Counts stay far below 2^53, where sums of doubles are exact.
                    linked += np.bincount(i, sizes_y[j], len(ids)).astype(np.int64)
                    linked += np.bincount(ahead + j, sizes_x[i], len(ids)).astype(np.int64)
                    labels, *joined = forest(labels, i, ahead + j)
                    edges.append(tuple(joined))
                some = np.flatnonzero(linked)
                i, j = (np.concatenate([e[side] for e in edges]) for side in (0, 1))
                kind = np.repeat(np.array([COUNT, LINK], np.int32), [len(some), len(i)])
                a, b = np.concatenate([ids[some], ids[i]]), np.concatenate([linked[some], ids[j]])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    return tile_rows.mapInArrow(run, "kind int, a long, b long")


def near_vectors(
    rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    doubles = F.transform(F.col(embedding), lambda x: x.cast("double"))
    own = rows.select(F.col(vec_id).alias("id"), doubles.alias("vector"), comparable(F.col(embedding)).alias("ok"))
    keyed = own.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    keyed = keyed.dropDuplicates(["id", "ok", "h1", "h2"])
    classes = keyed.where("ok").groupBy("h1", "h2").agg(
        F.min("id").alias("least"), F.count("*").alias("size"), F.any_value("vector").alias("vector")
    )
    # A class has a number of its own: an id may have several vectors, or be null.
    classes = settle(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    vectors = classes.select(F.col("class").alias("id"), "size", "vector")
    found = settle(tile_links(tiles(vectors, block), threshold), "links")
    groups = components(found.where(F.col("kind") == LINK).select("a", "b")).withColumnRenamed("id", "class")

    linked = found.where(F.col("kind") == COUNT).groupBy(F.col("a").alias("class")).agg(F.sum("b").alias("linked"))
    told = classes.drop("vector").join(linked, "class", "left").join(groups, "class", "left")
    told = settle(told.withColumn("group", F.coalesce("component", "class")).drop("component", "class"), "vector-groups")
    named = told.groupBy("group").agg(F.min("least").alias("component"))
    told = told.join(named, "group").select(
        F.lit(True).alias("ok"),
        "h1",
        "h2",
        (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("links"),
        "component",
    )
    placed = keyed.drop("vector").join(told, ["ok", "h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return placed.select(
        F.col("id").alias("vec_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a, ok b
  WHERE a.vec_id <> b.vec_id AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 ELSE false END
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM component c LEFT JOIN n ON c.vec_id = n.vec_id
"""
