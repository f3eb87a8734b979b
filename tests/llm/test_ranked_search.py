"""Ranked search against a plain computation, and its defined cases."""

from collections import Counter
from math import floor, log

import numpy as np
from plain import words
from tidemark.llm import ranked_search as rs


def plain(docs, items, most=10):
    texts = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    rows = []
    for item, text in items:
        scores = []
        for doc, own in texts:
            m = 25 + 75 * sum(own.values()) * n_docs // n_terms
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
                for t in words(text) if t in own
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        ranked = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:most]
        rows += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(ranked, 1)]
    return Counter(rows)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string, number long, n long, rank int, terms string, score long, item_id long")
    i = spark.createDataFrame(items, "item_id long, text string, doc_id long, part int, block long")
    return Counter(tuple(r) for r in rs.search(d, i, **options).collect())


def wide(rows, more):
    return [(*row, *[7] * more) if more == 3 else (*row, 7, 7, 7, "7", 7, 7) for row in rows]


def random_texts(seed, count, vocabulary=60, length=30):
    rng = np.random.default_rng(seed)
    chance = 1 / np.arange(1, vocabulary + 1)
    return [" ".join(f"W{x}" for x in rng.choice(vocabulary, rng.integers(1, length), p=chance / chance.sum())) for _ in range(count)]


def test_matches_plain_search_in_small_trees_and_blocks(spark):
    docs = list(enumerate(random_texts(1, 300)))
    items = list(enumerate(random_texts(2, 25, length=12)))
    want = plain(docs, items)
    assert found(spark, wide(docs, 6), wide(items, 3)) == want
    # Trees of a few documents and blocks of a few terms find the same.
    assert found(spark, wide(docs, 6), wide(items, 3), tree_docs=20, block_terms=50) == want


def test_defined_cases(spark):
    long_text = "rare " + "filler words of all sorts " * 50_000
    docs = [
        (5, "same text here"), (3, "same text here"), (3, "same text here"), (None, "same text here"), (None, None), (1, ""),
        (2, None), (4, "--- \n"), (8, long_text), (9, "ÉCLAIR éclair Éclair"), (10, "under_score a1b2"), (11, "x"),
    ]
    items = [(1, "same"), (2, "same same HERE"), (None, "text"), (4, None), (5, ""), (6, "absent"), (7, "RARE"), (8, "éclair ÉCLAIR"), (1, "score"), (9, "x x")]
    assert found(spark, wide(docs, 6), wide(items, 3)) == plain(docs, items)
    assert found(spark, wide(docs, 6), wide(items, 3), most=2) == plain(docs, items, 2)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert not found(spark, [], wide(items, 3)) and not found(spark, wide(docs, 6), []) and not found(spark, [], [])
    assert not found(spark, wide([(1, None)], 6), wide(items, 3))


def test_equal_scores_at_the_cut(spark):
    docs = [(i, "tie word") for i in range(40, 0, -1)] + [(100 + i, f"other{i} text") for i in range(200)]
    got = found(spark, wide(docs, 6), wide([(1, "tie")], 3))
    assert sorted((rank, doc) for _, rank, doc, _ in got) == [(i, i) for i in range(1, 11)]


def test_bounds_hold_and_cut_branches():
    rng = np.random.default_rng(5)
    docs = []
    for i in range(400):
        ranks = np.sort(rng.choice(80, rng.integers(1, 25), replace=False)).astype(np.int64)
        docs.append((i, int(rng.integers(25, 200)), ranks, rng.integers(1, 9, len(ranks)).astype(np.int32)))
    tree = rs.Tree(docs, leaf_docs=4)
    weight = rng.integers(0, 9000, 80)
    terms = np.sort(rng.choice(80, 9, replace=False))
    scores = {}
    for doc, m, ranks, times in docs:
        scores[doc] = sum(int(weight[r]) * (10**9 * int(t) // (1000 * int(t) + 8 * m)) for r, t in zip(ranks, times, strict=True) if r in terms)
    bounds = tree.bounds(terms, weight[terms])
    for begin, end, bound in zip(tree.begin, tree.end, bounds, strict=True):
        assert bound >= max(scores[d] for d in tree.ids[begin:end])
    best = rs.Best(10, 0)
    seen = []
    offer = best.offer
    best.offer = lambda score, doc: (seen.append(doc), offer(score, doc))
    tree.search(terms, weight[terms], np.zeros(80, np.int64), best)
    assert sorted(s for _, s in best.rows()) == sorted(scores.values())[-10:]
    assert len(seen) < len(docs) and len(tree.begin) > 50
