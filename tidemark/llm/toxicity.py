"""Toxicity: non-negative positive-unlabelled learning.

A numpy classifier (one hidden layer over hashed words) is trained from confirmed
toxic texts and unlabelled ones. The risk of the negative class is estimated from
the unlabelled texts and corrected by the class prior,

    R = prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]),

and where the bracket of a mini-batch falls below zero, its gradient is undone
(the non-negative estimator). A word says something of a text by being there, so
features are the distinct hashed words from whose frequencies alone, with the prior,
a text is more likely toxic than not; every text is scored over all its words.

The model is small (a few hundred kilobytes, fixed by parameters) and travels with
the scoring tasks, which need no shuffle. It is fitted on a bounded sample of
rows: at most about `MAX_POSITIVE` confirmed texts and `MAX_UNLABELLED` others;
the same rows give the features and the weights.

Defined cases: a null or empty text has no words and gets the score of a text
without any feature; repeated rows are scored each for itself, and learned from once; a row without a doc_id is
scored, never learned from, and `held_out`; a document whose
labels disagree is not a confirmed one; without any confirmed text every score is
the prior's, 0. Extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, bounded_sample, in_train, lean, narrow, settle, table, word_bytes
from tidemark.llm.hashing import hash_words

SLOTS = 1 << 18
MAX_POSITIVE = 8_000
MAX_UNLABELLED = 16_000
MAX_FEATURES = 512
# A feature stands in this many confirmed texts, and in this share of them, at least.
MIN_TEXTS = 5
MIN_SHARE = 0.005
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Model:
    """slots: sorted hash slots that are features; then the weights of the two layers."""

    slots: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def _slot_sets(texts: list[bytes | None], slots: int) -> list[np.ndarray]:
    """The distinct hashed words of each text."""
    return [np.unique(hash_words(word_bytes(t)) % np.uint64(slots)).astype(np.int64) for t in texts]


def slot_rows(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(id, kind, slots) of each text; docs holds id, text, kind."""

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            sets = _slot_sets(batch.column(1).cast(pa.binary()).to_pylist(), slots)
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([*sets, np.empty(0, np.int64)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.ListArray.from_arrays(offsets, values)], names=["id", "kind", "slots"]
            )

    return docs.select("id", "text", "kind").mapInArrow(lean(run), "id long, kind int, slots array<int>")


def kinds(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, h, kind): kind 1 for a confirmed toxic text, 0 for any other; h: the text's hash. Held-out rows are not there.

    Only the confirmed label is used. A row labelled clean is unlabelled to the learner.
    """
    agreed = (
        labels.groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))
        .where("low = 1 AND high = 1")
        .select("labelled")
    )
    ids = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h")).where(in_train("id"))
    joined = ids.join(agreed, ids["id"] == agreed["labelled"], "left")
    return joined.select("id", "h", F.col("labelled").isNotNull().cast("int").alias("kind"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    seed: int = 7,
) -> Model:
    narrow(docs.sparkSession)
    known = labels.where(in_train("doc_id")).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = min(max(known or 0.0, 1e-3), 0.5)
    rows = settle(kinds(docs, labels, doc_id, text), "toxic-kinds")
    # The unlabelled sample is drawn from all rows, confirmed or not: then the prior of toxic texts is the prior there.
    chosen = bounded_sample(rows.where("kind = 1"), ["id", "h"], max_positive).unionByName(
        bounded_sample(rows.withColumn("kind", F.lit(0)), ["id", "h"], max_unlabelled)
    )
    # The sample's bound is the bound of this broadcast: ids and hashes only, so texts need no shuffle to be found.
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(settle(chosen.distinct(), "toxic-sample")), ["id", "h"])
    # A row that is repeated whole counts once: there may be any number of it.
    found = found.dropDuplicates(["id", "h", "kind"])
    sample = slot_rows(found).toArrow().sort_by([("id", "ascending"), ("kind", "ascending")])
    kind = sample.column("kind").to_numpy()
    lists = sample.column("slots").combine_chunks()
    return fit_slots(kind, np.cumsum([0, *pa.compute.list_value_length(lists).to_pylist()]), lists.flatten().to_numpy(), prior, seed)


def fit_slots(kind: np.ndarray, offsets: np.ndarray, values: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Choose the features and train on texts given as lists of slots."""
    row = np.repeat(np.arange(len(kind)), np.diff(offsets))
    n_p, n_u = int((kind == 1).sum()), int((kind == 0).sum())
    in_p = np.bincount(values[kind[row] == 1], minlength=SLOTS).astype(float)
    in_u = np.bincount(values[kind[row] == 0], minlength=SLOTS).astype(float)
    # By the prior, what share of the texts with a word is toxic; the other count is taken one deviation higher.
    share = prior * (in_p / max(n_p, 1)) / ((in_u + 1 + np.sqrt(in_u)) / max(n_u, 1))
    fit_for = (in_p >= max(MIN_TEXTS, MIN_SHARE * n_p)) & (share >= 0.5)
    strength = np.where(fit_for, in_p, -1)
    slots = np.sort(np.argsort(-strength, kind="stable")[: min(MAX_FEATURES, int(fit_for.sum()))])
    place = np.full(SLOTS, -1)
    place[slots] = np.arange(len(slots))
    keep = place[values] >= 0
    x = np.zeros((len(kind), len(slots)), np.float32)
    x[row[keep], place[values[keep]]] = 1
    return train(x, kind, prior, slots, seed)


def train(
    x: np.ndarray, kind: np.ndarray, prior: float, slots: np.ndarray, seed: int = 7, hidden: int = 16, epochs: int = 60
) -> Model:
    """Mini-batch Adam on the non-negative risk with the sigmoid loss."""
    rng = np.random.default_rng(seed)
    positive, unlabelled = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
    if not len(positive) or not len(slots):
        return Model(slots, np.zeros((len(slots), 1), np.float32), np.zeros(1, np.float32), np.zeros(1, np.float32), -40.0)
    p = [
        (np.abs(rng.standard_normal((len(slots), hidden))) * 0.3).astype(np.float32),
        np.zeros(hidden, np.float32),
        (np.abs(rng.standard_normal(hidden)) * 0.3).astype(np.float32),
        np.array([-1.0], np.float32),
    ]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step, parts = 0, max(1, min(len(unlabelled) // 256, 32))
    for _ in range(epochs):
        pos, unl = rng.permutation(positive), rng.permutation(unlabelled)
        for part in range(parts):
            own_p = np.resize(pos[part::parts] if len(pos) >= parts else pos, max(1, len(pos) // parts))
            own_u = unl[part::parts]
            xb = np.concatenate([x[own_p], x[own_u]])
            n_p, n_u = len(own_p), max(len(own_u), 1)
            h0 = xb @ p[0] + p[1]
            h = np.maximum(h0, 0)
            g = h @ p[2] + p[3][0]
            # Sigmoid loss l(z) = 1 / (1 + e^z): slope -s(1-s) for l(g), s(1-s) for l(-g).
            s = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
            slope = s * (1 - s)
            negative = s[n_p:].sum() / n_u - prior * s[:n_p].mean()
            dg = np.zeros_like(g)
            if negative >= 0:
                dg[:n_p] = -2 * prior * slope[:n_p] / n_p
                dg[n_p:] = slope[n_p:] / n_u
            else:  # undo: step back along the negative part
                dg[:n_p] = prior * slope[:n_p] / n_p
                dg[n_p:] = -slope[n_p:] / n_u
            dh = np.outer(dg, p[2]) * (h0 > 0)
            grads = [xb.T @ dh + 1e-6 * p[0], dh.sum(0), h.T @ dg + 1e-6 * p[2], np.array([dg.sum()])]
            step += 1
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr * gr
                p[i] = (p[i] - 0.02 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(slots, p[0], p[1], p[2], float(p[3][0]))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) of each row of `docs`, over its whole text."""

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            sets = _slot_sets(batch.column(1).cast(pa.binary()).to_pylist(), SLOTS)
            x = np.zeros((len(sets), len(model.slots)), np.float32)
            for i, own in enumerate(sets):
                x[i, np.searchsorted(model.slots, np.intersect1d(own, model.slots, assume_unique=True))] = 1
            value = 1 / (1 + np.exp(-np.clip(model.margin(x).astype(float), -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["id", "score"])

    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(lean(run), "id long, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("id").alias("doc_id"),
        F.coalesce(~in_train("id"), F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
