"""Packing against the tokenizer's own library, and the plan against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tidemark.llm import packing, queries
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def check(rows, texts, library, capacity=2048):
    """Every document is there whole, cut as it should be, and sequences are gapless and not too long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for doc, own in by_doc.items():
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        first = len(ids) % capacity or capacity
        assert [r["length"] for r in own] == [first] + [capacity] * ((len(ids) - first) // capacity)
        for r, start in zip(own, itertools.accumulate([0] + [r["length"] for r in own[:-1]]), strict=True):
            assert r["start"] == start and r["ids_crc32"] == zlib.crc32(ids[start : start + r["length"]].tobytes())
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == list(itertools.accumulate([0] + [n for _, n in own[:-1]]))
        assert sum(n for _, n in own) <= capacity
    return len(by_sequence)


def test_query(spark, library):
    texts = dict(map(tuple, spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()))
    rows = queries.QUERIES["op13_best_fit_packing"](spark, SF_DIR).collect()
    used = check(rows, texts, library)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_two_libraries_agree_below_u0100_and_on_stretches(library):
    own = packing.ids_of(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.path(packing.RANKS))
    rng = random.Random(1)
    characters = [chr(c) for c in range(256)] + list("  \n\tas't'll ") * 6
    texts = ["".join(rng.choices(characters, k=rng.randint(1, 60))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "x <|endof", "ﬁ ½ ² 　 日本語 🙂", " " * 3000, "ab " * 60_000, "words, of 12 sorts. " * 20_000]
    texts += ["  x" * 50_000, "é" * 200_000]
    for text in texts:
        assert own.of(text).tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]
    assert "".join(packing.stretches("ab " * 60_000)) == "ab " * 60_000


def test_defined_cases(spark, library):
    long_text = "many words, " * 30_000
    texts = {1: None, 2: "", 3: "one", 4: long_text, 5: "日本 <|endoftext|> x", 6: "word " * 2046 + "w"}
    schema = "doc_id long, text string, piece int, start string, part long, nth long, rank long, ids string, sequence_id long"
    frame = spark.createDataFrame([(i, t, 1, "s", 2, 3, 4, "x", 5) for i, t in texts.items()], schema)
    packed = packing.pack(frame)
    rows = packed.collect()
    check(rows, texts, library)
    # The sequences themselves hold the ids.
    for s in packing.sequences(packed).collect():
        own = sorted((r for r in rows if r["sequence_id"] == s["sequence_id"]), key=lambda r: r["offset"])
        assert bytes(s["ids"]) == b"".join(bytes(r["ids"]) for r in own) and s["doc_ids"] == [r["doc_id"] for r in own]
        assert s["length"] * 4 == len(s["ids"])
    # Repeated rows, and rows without an id, are packed each by itself.
    again = spark.createDataFrame([(7, "same"), (7, "same"), (None, "same"), (None, None)], "doc_id long, text string")
    rows = packing.pack(again, keep_ids=False).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (0, 2), (7, 2), (7, 2)]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 4 and len({r["sequence_id"] for r in rows}) == 1
    assert packing.pack(again.limit(0)).count() == 0


def test_fullest_is_the_best_sum():
    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        taken = packing.fullest(counts, room)
        assert all(0 < k <= counts[length] for length, k in taken.items())
        assert sum(length * k for length, k in taken.items()) == max(s for s in sums if s <= room)


def test_plan_places_all_and_needs_few_sequences():
    rng = random.Random(4)
    for n in (10, 300, 20_000):
        counts = {}
        for _ in range(n):
            length = min(2048, int(rng.lognormvariate(6, 1.2)) + 1)
            counts[length] = counts.get(length, 0) + 1
        made = packing.plan(counts)
        placed = {}
        for own, times in made:
            assert sum(length * k for length, k in own.items()) <= 2048
            for length, k in own.items():
                placed[length] = placed.get(length, 0) + k * times
        assert placed == counts
        needed = -(-sum(length * k for length, k in counts.items()) // 2048)
        assert sum(times for _, times in made) <= needed + max(1, needed // 100)
    # The number of steps depends on the lengths, not on how many pieces there are.
    assert len(packing.plan({length: 10**9 for length in range(1, 2049)})) < 5_000


def test_running_numbers_go_on_between_batches():
    seen = np.zeros(4, np.int64)
    assert packing._numbered(np.array([3, 1, 3, 2]), seen).tolist() == [0, 0, 1, 0]
    assert packing._numbered(np.array([3, 3, 2]), seen).tolist() == [2, 3, 1]
