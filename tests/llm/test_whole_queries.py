"""Whole results of the pipeline and of queries without SQL, against plain second computations of every row."""

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain import plain_groups, words
from test_text_operators import plain_hits, plain_lines
from tidemark.llm import byte_bpe, common, hashing, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_pipeline_row_by_row(spark, texts):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    # The classifier's scores are taken as they are; every decision after them is made again here.
    scores = {r["id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    left = {i: t for i, t in texts.items() if scores[i] < 0.5}
    left = plain_lines(left)
    groups = plain_groups(left)
    left = {i: t for i, t in left.items() if groups[i] == i}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    left = {i: t for i, t in left.items() if not plain_hits(t, items)[1]}
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, text in left.items():
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        want[i] = (ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    got = {r["doc_id"]: (bytes(r["ids"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}
    assert len(rows) == len(got) and got == want
    assert 0 < len(want) < len(texts)


def test_licence_places_of_every_document(spark, texts):
    base = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_license_scan"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        own = words(text)
        places = {
            label: [s for s in range(len(own)) if own[s : s + len(p.split())] == p.split()] for p, label in base.items()
        }
        every = sorted(s for found in places.values() for s in found)
        r = rows[i]
        assert (r["n_words"], r["n_base"]) == (len(own), len(every))
        assert (r["first_word"], r["last_word"]) == ((every[0], every[-1]) if every else (None, None))
        labels = sorted(label for label, found in places.items() if found)
        assert r["base_labels"] == ",".join(labels) and set(labels) <= set(r["labels"].split(",") if r["labels"] else [])
        assert 0 <= r["score"] <= 1


def test_toxicity_scores_of_every_document(spark, texts):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_toxicity"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    slots = {int(s): k for k, s in enumerate(model.slots)}
    for i, text in texts.items():
        held = {int(h % np.uint64(toxicity.SLOTS)) for h in hashing.hash_words(common.word_bytes((text or "").encode()))}
        x = np.zeros(len(slots))
        x[[slots[h] for h in held if h in slots]] = 1
        hidden = np.maximum(x @ model.w1 + model.b1, 0)
        want = 1 / (1 + np.exp(-(hidden @ model.w2 + model.b2)))
        assert abs(rows[i]["score"] - want) < 1e-4 and rows[i]["predicted"] == int(rows[i]["score"] >= 0.5)
