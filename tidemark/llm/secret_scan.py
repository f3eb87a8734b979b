"""Secret scan: fixed patterns, and strings that look random rather than written.

Two character Markov models (order 1, over the characters a key can be made of) are
trained from labelled samples: what the fixed patterns found is random, all other
runs of such characters in the same texts are ordinary identifiers. A run of at
least `MIN_LENGTH` characters is a secret of kind `random` if the log-likelihood
ratio of the two models, with the prior odds of a secret, says so and each of its
characters says so on average. As found secrets show few forms (hex, say), a string may
instead be random as even draws from the whole alphabet; the better of both counts. A run whose own
repetitions explain it better than even draws do (a row of x, say) is none, nor is one without a letter: rulers, numbers,
dates. Nothing else decides: no count of different characters or of digits.
The tables start from smoothing counts, so without any sample nothing is a secret.

Counts are summed in the tasks: a task gives one row for each model. Training reads a
bounded sample of texts (`MAX_TEXTS`); scanning is one pass without a shuffle, and
the model (two tables of a few kilobytes) travels with the tasks.

Defined cases: a null text is empty and has no spans; fixed spans are leftmost and
non-overlapping per kind and always stay; a random span never overlaps a fixed one;
repeated rows are scanned each; offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, bounded_sample, table

# The patterns, what of a match counts, and its least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, as a longer one is taken whole
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_LENGTH = 16
MAX_TEXTS = 20_000
# One run in so many is a secret; each character must speak for it by this much on average.
PRIOR_ODDS, PER_CHARACTER = 1e-4, 0.5
SMOOTHING = 4.0
BATCH_BYTES = 8 << 20

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_CODE = np.full(128, -1)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_N = len(ALPHABET)


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of what the fixed patterns find, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def codes(run: str) -> np.ndarray:
    """The run's characters as numbers in the alphabet, after the number that stands for the beginning."""
    return np.concatenate([[_N], _CODE[np.frombuffer(run.encode(), np.uint8)]])


def repetition(run: str) -> float:
    """Log of how much likelier the run is under a model that learns its transitions as it reads them than as even draws."""
    after: Counter = Counter()
    pairs: Counter = Counter()
    total = 0.0
    for a, b in itertools.pairwise(run):
        total += math.log((pairs[a, b] * _N + 1) / (after[a] + 1))
        pairs[a, b] += 1
        after[a] += 1
    return total


@dataclass(frozen=True)
class Model:
    """ratio[way, a, b]: log of how much likelier b follows a in random strings than in ordinary ones."""

    ratio: np.ndarray

    def score(self, run: str) -> float:
        c = codes(run)
        return float(self.ratio[:, c[:-1], c[1:]].sum(1).max())

    def is_secret(self, run: str) -> bool:
        if not any(map(str.isalpha, run)):
            return False
        value = self.score(run)
        return value + np.log(PRIOR_ODDS) > 0 and value > PER_CHARACTER * len(run) and repetition(run) + np.log(PRIOR_ODDS) <= 0


def from_counts(random: np.ndarray, ordinary: np.ndarray) -> Model:
    """Both tables of transitions, smoothed towards the counts of single characters and these towards even draws."""

    def table_of(counts: np.ndarray) -> np.ndarray:
        single = (counts.sum(0) + SMOOTHING) / (counts.sum() + SMOOTHING * _N)
        lean = 0.9 * single + 0.1 / _N
        return np.log(counts + SMOOTHING * _N * lean) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * _N)

    usual = table_of(ordinary)
    return Model(np.stack([table_of(random) - usual, -np.log(_N) - usual]))


class Covered:
    """Disjoint stretches of text that spans cover."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in spans:  # in order of start
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > start


def transition_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the two labelled samples, (random or ordinary, character before, character)."""
    total = np.zeros((2, (_N + 1) * _N), np.int64)
    for text in texts:
        if not text:
            continue
        covered = Covered(fixed_spans(text))
        streams: list[list[np.ndarray]] = [[], []]
        for run in _RUN.finditer(text):
            inside = covered.meets(*run.span())
            # An assignment's name is no secret; of the runs inside, the key itself is the long one with a digit.
            if inside and not (len(run[0]) >= MIN_LENGTH and any(c.isdigit() for c in run[0])):
                continue
            streams[0 if inside else 1].append(codes(run[0]))
        for kind, runs in enumerate(streams):
            if runs:
                flat = np.concatenate(runs)
                follows = flat[1:] < _N  # the next run's beginning follows nothing
                total[kind] += np.bincount((flat[:-1] * _N + flat[1:])[follows], minlength=(_N + 1) * _N)
    return total


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_TEXTS) -> Model:
    def run(source):
        total = np.zeros((2, (_N + 1) * _N), np.int64)
        for batch in batches(BATCH_BYTES)(source):
            total += transition_counts(batch.column(1).to_pylist())
        kind, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total[kind, cell])], names=["kind", "cell", "n"]
        )

    sample = bounded_sample(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), ["id", "text"], most)
    summed = sample.mapInArrow(run, "kind int, cell int, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((2, (_N + 1) * _N))
    total[summed.column(0).to_numpy(), summed.column(1).to_numpy()] = summed.column(2).to_numpy()
    return from_counts(*total.reshape(2, _N + 1, _N))


def scan_text(text: str, model: Model) -> tuple[list, list]:
    """Fixed spans, and random ones that overlap none of them."""
    fixed = fixed_spans(text)
    covered = Covered(fixed)
    runs = (run for run in _LONG_RUN.finditer(text) if not covered.meets(*run.span()))
    return fixed, [(run.start(), 3, run.end()) for run in runs if model.is_secret(run[0])]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans) of each row."""

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            counts, base, spans = [], [], []
            for value in batch.column(1).to_pylist():
                fixed, extra = scan_text(value, model) if value else ([], [])
                counts.append(np.bincount(np.array([k for _, k, _ in fixed + extra], np.int64), minlength=4))
                base.append(_joined(fixed))
                spans.append(_joined(sorted(fixed + extra)))
            table_ = np.array(counts, np.int64).reshape(-1, 4)
            columns = [*(pa.array(table_[:, k]) for k in range(4)), pa.array(base, pa.string()), pa.array(spans, pa.string())]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string"
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, fit(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_random"
    )
