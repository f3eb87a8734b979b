"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts the hashed 1- to 3-grams of labelled texts per language in the tasks
and sums them; the log-probability matrix (languages x slots, a fixed size) travels
with the tasks. Scoring hashes a batch of texts at once in numpy, gathers the
matrix rows of its n-grams and sums them per text. Nothing is shuffled but counts.

It is fitted on a bounded sample of labelled texts that may be learned from: about `MAX_TEXTS` of each
language, so one that few texts have is learned from all of them, in a table of any size. Priors come from the
true counts. The score is the posterior probability of the language named, of evidence
divided by the square root of its length: n-grams overlap, so their plain product
would be certain of everything.

A long text is scored in stretches, so memory does not grow with it.

Defined cases: a null text, or one without a letter (of Unicode's categories L), is `und` with score 0; without any
labelled text everything is; ties go to the language first in order; repeated rows are
judged each; languages with fewer texts have lower priors; a row without a doc_id is judged, never learned
from, and `held_out`; extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICES, batches, in_train, settle, slice_of, table

SLOTS = 1 << 15
GRAMS = (1, 2, 3)
MAX_TEXTS = 5_000
BATCH_BYTES = 1 << 20
# Matrix rows that are gathered at a time.
STRETCH = 1 << 18
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FACTOR = np.uint32(0x9E3779B1)


def gram_slots(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n of `GRAMS`: slots of the n-grams of all lower-cased texts in order, and the end of each text's."""
    pieces = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    lengths = np.array([len(p) for p in pieces], np.int64)
    flat = np.concatenate([*pieces, np.empty(0, np.uint32)])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    found = []
    code = np.zeros(len(flat), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        code = code[: max(len(flat) - n + 1, 0)] * _FACTOR + flat[n - 1 :] + np.uint32(n)
        if n in GRAMS:
            hashed = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(17)
            inside = owner[: len(hashed)] == owner[n - 1 :]
            found.append((hashed[inside], np.cumsum(np.maximum(lengths - n + 1, 0))))
    return found


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray  # log, one a language
    weights: np.ndarray  # log-probabilities, slots x languages

    def posterior(self, texts: list[str]) -> np.ndarray:
        """One row a text, one column a language."""
        sums, count = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for slots, ends in gram_slots(texts):
            for begin in range(0, len(slots), STRETCH):
                # The texts that have n-grams in this stretch, and where those begin in it.
                end = min(begin + STRETCH, len(slots))
                starts = np.concatenate([[0], ends[:-1]])
                some = np.flatnonzero((ends > begin) & (starts < end) & (ends > starts))
                sums[some] += np.add.reduceat(self.weights[slots[begin:end]], np.maximum(starts[some] - begin, 0))
            count += np.diff(ends, prepend=0)
        value = sums / np.sqrt(np.maximum(count, 1))[:, None] + self.prior
        value = np.exp(value - value.max(1, keepdims=True, initial=-np.inf))
        return value / value.sum(1, keepdims=True)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MAX_TEXTS) -> Model:
    """Learn from the text and the language of rows that may be learned from and have both, about `most` of each language."""

    def run(source):
        total: dict[str, np.ndarray] = {}
        for batch in batches(BATCH_BYTES)(source):
            values, langs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for language in sorted(set(langs)):
                own = [v for v, x in zip(values, langs, strict=True) if x == language]
                total.setdefault(language, np.zeros(SLOTS, np.int64))
                for slots, _ in gram_slots(own):
                    total[language] += np.bincount(slots, minlength=SLOTS)
        for language, own in total.items():
            seen = np.flatnonzero(own)
            # Slot -1 tells of a language whose texts have no n-gram at all.
            columns = [[language] * (len(seen) + 1), np.append(seen, -1).astype(np.int32), np.append(own[seen], 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lang", "slot", "n"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(in_train("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # A row a language, stored: so its true size tells that it may travel to the texts, which need no shuffle.
    sizes = settle(rows.groupBy("lang").agg(F.count("*").alias("texts")), "languages")
    share = sizes.select("lang", F.floor(F.lit(float(SLICES) * most) / F.col("texts")).alias("share"))
    chosen = rows.join(share, "lang").where(slice_of("id", "text") < F.col("share")).select("id", "text", "lang")
    found = chosen.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    true = {r["lang"]: r["texts"] for r in sizes.collect()}  # a row a language
    langs, slots, n = found.column(0).to_pylist(), found.column(1).to_numpy(), found.column(2).to_numpy()
    languages = sorted(set(langs))
    place = np.array([languages.index(x) for x in langs], np.int64)
    counts, texts = np.zeros((SLOTS, len(languages))), np.array([true[x] for x in languages], float)
    counts[slots[slots >= 0], place[slots >= 0]] = n[slots >= 0]
    weights = np.log(counts + 0.5) - np.log(counts.sum(0) + 0.5 * SLOTS)
    return Model(languages, np.log(np.maximum(texts, 1) / max(texts.sum(), 1)), weights.astype(np.float32))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of each row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source):
        known = shared.value
        for batch in batches(BATCH_BYTES)(source):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            named, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            lettered = [i for i, t in enumerate(texts) if _LETTER.search(t)] if known.languages else []
            value = known.posterior([texts[i] for i in lettered])
            for row, i in enumerate(lettered):
                best = int(value[row].argmax())
                named[i], score[i] = known.languages[best], min(1.0, value[row, best])
            columns = [batch.column(0), pa.array(named, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = predict(docs, fit(docs))
    return predicted.select("doc_id", F.coalesce(~in_train("doc_id"), F.lit(True)).alias("held_out"), "lang_pred", "score")
