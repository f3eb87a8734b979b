"""Spelling variants against a plain computation, and their defined cases."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from tidemark.llm import queries, spelling


def plain(rows, spoiled=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % spoiled == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters = sorted({x for w in kept for x in w})
    out = {}
    for word, n in kept.items():
        cut = {word[:i] + word[i + 1 :] for i in range(len(word))}
        put = {word[:i] + x + word[i:] for i in range(len(word) + 1) for x in letters}
        swapped = {word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in letters}
        near = {w for w in cut | put | swapped if w in kept and w != word}
        form = min(near, key=lambda w: (-kept[w], w), default=None)
        if form is not None and kept[form] < 10 * n:
            form = None
        out[word] = (n, len(near), form, kept.get(form))

    def root(word):
        while out[word][2] is not None:
            word = out[word][2]
        return word

    return {w: (*v, root(w)) for w, v in out.items()}


def told(frame):
    rows = frame.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def got(spark, rows):
    schema = "doc_id long, text string, word string, id long, n long, nodes string, form string"
    return told(spelling.variants(spark.createDataFrame([(*r, "w", 1, 2, "x", "y") for r in rows], schema)))


def test_query_matches_plain_computation(spark):
    path = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert told(queries.QUERIES["op12_spelling_variants"](spark, path)) == plain(texts)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_dense_neighbourhoods_in_many_ranges(spark, coalesce):
    # Few letters, so that most words have neighbours of all three kinds; frequencies over several powers of ten.
    rng = random.Random(3)
    rows = []
    for doc in range(60):
        drawn = ["".join(rng.choice("aabé") for _ in range(rng.randint(6, 9))) for _ in range(40)]
        rows.append((doc, " ".join(drawn)))
    base = ["kitchens", "kitchen", "kitchenss", "kitchans", "kitchansx", "xkitchans", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    for doc, (word, n) in enumerate(zip(base, (4000, 390, 3, 38, 3, 2, 500, 49, 4), strict=True), 1000):
        rows.append((doc, f"{word} " * n))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        result = got(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = plain(rows)
    assert result == want
    assert any(v[2] is not None and v[4] != v[2] for v in want.values())  # a chain of forms


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "Nameless nameless"), (None, "Nameless"), (3, "ÀÉÎÕÜabc ÀÉÎÕÜABC àéîõüabc ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷"), (4, "a1b2c3 short shorts")]
    rows += [(5, "repeated row here repeated")] * 2 + [(6, "ſtrangely ſtrangely İstanbul İstanbul")]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == {}


def test_very_long_runs(spark):
    run = "ab" * 60_000
    rows = [(i, run) for i in range(40)] + [(100 + i, run + "c") for i in range(3)]
    rows = [r for r in rows if crc32(f"{r[0]}:{r[1]}".encode()) % 31]
    n = sum(r[0] < 100 for r in rows)
    out = got(spark, rows)
    assert out[run] == (n, 1, None, None, run)
    assert out[run + "c"] == (len(rows) - n, 1, run, n, run)


def test_each_near_pair_meets_once(spark):
    # Several deletions of a word give the same one.
    words = ["aaaabbbb", "aaabbbb", "aaaabbb", "aaaacbbb"]
    texts = [(i, f"{w} {w}") for i, w in enumerate(words)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    out = told(spelling.variants(frame, spoiled=1 << 40))
    assert out == plain(texts, spoiled=1 << 40) and out["aaaabbbb"][1] == 3
