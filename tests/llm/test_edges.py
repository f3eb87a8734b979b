"""Edge cases of the operators: long texts, null and repeated ids, hot groups."""

import random
import re
import string
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain import words
from pyspark.sql import functions as F
from tidemark.llm import byte_bpe, common, decontaminate, embedding_dedup, html_blocks, html_extract, language, line_dedup
from tidemark.llm import near_dedup, queries, secret_scan, toxicity


def test_line_dedup_is_linear_in_a_texts_lines(spark):
    lines = [f"this is line number {i} of a long text" for i in range(200_000)]
    docs = [(i, "\n".join(lines)) for i in range(3)] + [(5, "\n".join([f"line {i} that nobody else has" for i in range(200_000)] + lines[:1]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    began = time.monotonic()
    rows = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(frame).select("doc_id", "n_lines", "n_dropped").collect()}
    assert time.monotonic() - began < 60  # a quadratic one takes an hour
    assert rows == {0: (200_000, 200_000), 1: (200_000, 200_000), 2: (200_000, 1), 5: (200_001, 0)}


def test_line_dedup_null_ids_and_texts_of_one_id(spark):
    a, b = "the first line that many documents hold", "the second line that many documents hold"
    docs = [(None, a), (None, a), (None, f"{a}\n{b}"), (1, f"{a}\nx"), (1, f"y\n{a}"), (1, f"y\n{a}"), (2, f"{b}\n{a}"), (3, a)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    kept = sorted((r["doc_id"] or 0, r["kept_text"], r["n_dropped"]) for r in got)
    # Three documents hold a, one (2) holds b: rows without an id count for neither and keep theirs.
    assert kept == sorted([(0, a, 0), (0, a, 0), (0, f"{a}\n{b}", 0), (1, "x", 1), (1, "y", 1), (1, "y", 1), (2, b, 1), (3, a, 0)])


def plain_vectors(rows, threshold=0.9):
    """n_links, component and kept of each distinct row, each a vector by itself."""
    rows = list(dict.fromkeys(rows))
    unit = [np.array(v) / np.linalg.norm(v) if v and len(v) and np.linalg.norm(v) else None for _, v in rows]
    near = [
        {b for b, y in enumerate(unit) if b != a and x is not None and y is not None and len(x) == len(y) and x @ y >= threshold}
        for a, x in enumerate(unit)
    ]
    out = []
    for a, (name, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        names = [rows[b][0] for b in seen if rows[b][0] is not None]
        component = min(names) if names else None
        out.append((name, len(near[a]), component, name == component if component is not None else True))
    return Counter(out)


def vector_rows(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, class string, size int")
    return Counter(tuple(r) for r in embedding_dedup.near_vectors(frame, **options).collect())


def test_near_vectors_of_one_id_and_without_an_id(spark):
    rows = [(1, (1.0, 0.0)), (1, (0.0, 1.0)), (2, (1.0, 0.01)), (3, (0.01, 1.0)), (4, (-1.0, 0.0)), (4, (-1.0, 0.0))]
    assert vector_rows(spark, rows) == plain_vectors(rows)
    alike = [(None, (5.0, 5.0)), (2, (5.0, 5.0)), (None, (5.0, 5.1)), (None, (-3.0, 1.0)), (None, (-3.0, 1.01)), (7, None), (None, None), (None, (0.0, 0.0))]
    assert vector_rows(spark, rows + alike) == plain_vectors(rows + alike)


@pytest.mark.parametrize("block", [7, 4096])
def test_near_vectors_with_a_large_group(spark, block):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(12)
    near = centre + rng.standard_normal((60, 12)) * 0.2
    far = rng.standard_normal((40, 12))
    rows = [(int(rng.integers(1, 70)), tuple(map(float, v))) for v in np.concatenate([near, near[:20], far])]
    assert vector_rows(spark, rows, block=block) == plain_vectors(rows)
    # Squares out of a double's range.
    huge = [(100 + i, tuple(map(float, v * 1e200))) for i, v in enumerate(far[:3])]
    told = vector_rows(spark, rows + huge, block=block)
    assert all(n_links >= 1 for name, n_links, _, _ in told if name and name >= 100)
    # What a tile hands on is no more than its vectors, however many links it has.
    frame = spark.createDataFrame([(i, 1, list(v)) for i, (_, v) in enumerate(rows)], "id long, size long, vector array<double>")
    handed = embedding_dedup.tile_links(embedding_dedup.tiles(frame, 4096)).count()
    assert handed < 2 * len(rows)


def test_forest_joins_what_is_linked_with_as_few_links():
    rng = np.random.default_rng(1)
    labels = np.arange(50)
    i, j = rng.integers(0, 50, 400), rng.integers(0, 50, 400)
    kept = 0
    for begin in range(0, 60, 20):
        labels, a, b = embedding_dedup.forest(labels, i[begin : begin + 20], j[begin : begin + 20])
        kept += len(a)
    whole, _, _ = embedding_dedup.forest(np.arange(50), i[:60], j[:60])
    assert (labels == whole).all() and kept == 50 - len(set(labels.tolist()))


def plain_posterior(rows, text):
    """Naive Bayes over hashed 1- to 3-grams, one n-gram at a time."""

    def slots(value):
        points = [ord(c) for c in value.lower()]
        for n in (1, 2, 3):
            for i in range(len(points) - n + 1):
                code = 0
                for k in range(n):
                    code = (code * 0x9E3779B1 + points[i + k] + k + 1) & 0xFFFFFFFF
                yield ((code ^ (code >> 15)) * 0x85EBCA6B & 0xFFFFFFFF) >> 17

    languages = sorted({lang for _, lang in rows})
    counts = {lang: Counter(s for t, own in rows if own == lang for s in slots(t)) for lang in languages}
    asked = list(slots(text))
    value = {}
    for lang in languages:
        total = sum(counts[lang].values()) + 0.5 * (1 << 15)
        evidence = sum(np.log((counts[lang][s] + 0.5) / total) for s in asked) / np.sqrt(max(len(asked), 1))
        value[lang] = evidence + np.log(sum(own == lang for _, own in rows) / len(rows))
    top = max(value.values())
    whole = sum(np.exp(v - top) for v in value.values())
    return {lang: np.exp(v - top) / whole for lang, v in value.items()}


def test_language_posterior_against_a_plain_one(spark, monkeypatch):
    rows = [("der hund und die katze", "de"), ("the dog and the cat", "en"), ("el perro y el gato", "es"), ("das ist ein haus", "de"), ("", "en")]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][: len(rows)]
    docs = spark.createDataFrame([(i, t, lang, 1) for i, (t, lang) in zip(ids, rows, strict=True)], "doc_id long, text string, lang string, slot int")
    model = language.fit(docs)
    asked = ["die maus", "gato", "x", "a", "the Ärger und 123 " * 40, ""]
    for stretch in (language.STRETCH, 7):
        monkeypatch.setattr(language, "STRETCH", stretch)
        for text, got in zip(asked, model.posterior(asked), strict=True):
            want = plain_posterior(rows, text)
            assert model.languages == sorted(want) and np.allclose(got, [want[x] for x in sorted(want)], atol=1e-4)


def test_language_of_texts_without_a_letter(spark):
    docs = spark.createDataFrame([(1, "the cat", "en"), (2, "der hund", "de"), (3, "the dog", "en")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    asked = [(i, t) for i, t in enumerate(["½ ² ① Ⅷ 123", "_", None, "", "日", "ª", "a1", "!?"])] + [(None, "the")]
    rows = language.predict(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    named = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert [named[i] == "und" for i in range(8)] == [True, True, True, True, False, False, False, True] and named[None] != "und"


def test_a_rare_language_is_learned_in_a_large_table(spark):
    ids = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, "the dog and the cat", "en") for i in ids[3:]] + [(i, "õhtu ämber öö", "et") for i in ids[:3]], "doc_id long, text string, lang string")
    model = language.fit(docs, most=50)
    assert model.languages == ["en", "et"]
    assert np.allclose(np.exp(model.prior), [1 - 3 / len(ids), 3 / len(ids)])


def test_samples_stay_bounded_whatever_repeats(spark):
    many = spark.range(30_000).selectExpr("IF(id % 3 = 0, 5, id) AS id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text")
    for keys in (["id", "text"],):
        assert common.bounded_sample(many, keys, 1_000).count() <= 1_300
    one = spark.range(9_000).selectExpr("1L AS id", "'same' AS text")
    assert common.bounded_sample(one, ["id", "text"], 100).count() <= 120
    texts = spark.range(9_000).selectExpr("1L AS id", "concat('t', id) AS text")
    assert 60 <= common.bounded_sample(texts, ["id", "text"], 100).count() <= 140
    assert common.bounded_sample(texts, ["id", "text"], 9_000).count() == 9_000


def test_toxicity_learns_from_one_id_with_many_rows_within_its_bound(spark):
    ids = [i for i in range(4_000) if zlib.crc32(str(i).encode()) % 5]
    hot = ids[0]
    rows = [(hot, "the same words again") for _ in range(3_000)] + [(i, "vile rotten scum" if i % 4 == 0 else "kind words here") for i in ids[1:]]
    rows += [(None, None), (None, "vile rotten scum"), (ids[-1] + 1, "")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, kind int, h string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids[1:]], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, max_positive=100, max_unlabelled=200)
    scores = {r["id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    toxic = [i for i in ids[1:] if i % 4 == 0]
    assert np.mean([scores[i] >= 0.5 for i in toxic]) > 0.9 and np.mean([scores[i] >= 0.5 for i in ids[1:] if i % 4]) < 0.1


def test_near_duplicates_without_an_id_stay_by_themselves(spark):
    text = "one two three four five six seven eight nine ten"
    docs = [(None, text), (None, text), (None, "quite another text of some words here"), (None, None), (3, text), (2, text), (4, None)]
    rows = near_dedup.near_duplicates(spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, n long")).collect()
    assert Counter(tuple(r) for r in rows) == Counter(
        [(None, 6, None, None, True)] * 2 + [(None, 3, None, None, True), (None, 0, None, None, True), (2, 6, 2, 2, True), (3, 6, 2, 2, False), (4, 0, 4, 4, True)]
    )


def test_blocks_of_long_texts_are_cut_by_their_shingles(spark):
    rng = np.random.default_rng(4)
    sets = [(i, sorted({int(x) for x in rng.integers(0, 1 << 40, 300)})) for i in range(12)]
    sets[7] = (7, sorted({*sets[3][1][:290], 5, 6}))
    rows = spark.createDataFrame(sets, "id long, shingles array<long>")
    members = spark.createDataFrame([(1, i, i, 12, 3_600) for i, _ in sets], "key long, id long, component long, members long, total long")
    for shingles in (1, 700, 1 << 20):
        assert [tuple(r) for r in near_dedup.block_links(members, rows, block_shingles=shingles).collect()] == [(3, 7)]


def test_bpe_of_long_words_that_many_documents_hold(spark):
    ruler, cjk = "=" * 5_000, "漢字" * 40
    texts = {i: f"start {ruler} word{i} {cjk} {ruler} end" for i in range(400)} | {1_000: ruler, 1_001: " " * 300}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: np.array(library.encode_ordinary(t), "<u4").tobytes() for i, t in texts.items()}
    rows = byte_bpe.encode(frame, tokens=byte_bpe.token_bytes(spark)).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in rows} == want
    assert all(bytes(r["decoded"]).decode() == texts[r["doc_id"]] for r in rows)
    # One word's rows are dealt to many tasks.
    words = spark.range(4_000).selectExpr("id", "0L AS h", "0 AS place", f"'{ruler}' AS word")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        parts = byte_bpe.encoded(words, public_tokenizers.path(byte_bpe.RANKS)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(coalesce, "true")
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 2_000


def test_decoding_an_unknown_id_is_an_error(spark):
    tokens = spark.createDataFrame([(0, bytearray(b"a")), (3, bytearray(b"bcd")), (4, bytearray(b""))], "token_id int, bytes binary")
    known = byte_bpe.Bytes(tokens)
    packed = lambda *ids: np.array(ids, "<u4").tobytes()
    assert known.of(packed(3, 0, 4, 3)) == b"bcdabcd" and known.of(b"") == b""
    for wrong in (1, 9):
        with pytest.raises(KeyError):
            known.of(packed(0, wrong))
    many = packed(*[3, 0] * 100_000)
    assert known.of(many) == b"bcda" * 100_000


def test_pages_of_many_blocks_are_learned_from_and_read(spark):
    side = "<nav><a href='/'>menu entry</a></nav><div class='ad'>buy this now</div>"
    page = lambda n, k: f"<html><body>{side}<article>" + "".join(f"<p>Sentence {i} of page {k}, with words.</p>" for i in range(n)) + f"</article>{side}</body></html>"
    rows = [(k, page(450, k), 1) for k in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, html string, n_chars int")
    model = html_extract.fit(pages)
    assert model is not None
    # A page without marks, of very many blocks: all of its sentences, none of its sides.
    plain = page(100_000, 9).replace("article", "div")
    got = html_extract.extract(spark.createDataFrame([(1, plain)], "page_id long, html string"), model).first()
    want = " ".join(f"Sentence {i} of page 9, with words." for i in range(100_000))
    assert got["n_chars"] == len(got["text"]) and abs(got["n_chars"] - len(want)) < len(want) / 100
    own = html_extract.extract(pages, model).collect()
    assert all(r["text"].startswith(f"Sentence 0 of page {r['page_id']}") and "menu" not in r["text"] for r in own)


def test_a_long_page_gives_a_bounded_number_of_windows():
    rng = np.random.default_rng(1)
    page = [html_blocks.Block(f"w{i}", [1, 2], 0, i % 2) for i in range(4_000)]
    found = html_extract.windows(page, rng)
    assert len(found) == html_extract.MAX_WINDOWS and all(end - begin == len(labels) == html_extract.WINDOW for _, begin, end, labels in found)
    assert [(a, b) for _, a, b, _ in html_extract.windows(page[:450], rng)] == [(0, 400), (400, 450)]


def test_sparse_rows_are_the_dense_ones():
    page = html_blocks.blocks("<body class='x y'><nav>menu menu</nav><main><p>One two, one.<p>Three <a href='/'>four</a></main>")
    sheet, e = html_extract.Sheet(page), html_extract.fresh()["e"]
    dense = sheet.dense(0, len(page))
    assert np.allclose(dense @ e, sheet.projected(e), atol=1e-5)
    words = dense[:, html_blocks.PATH_SLOTS : html_extract.SPARSE]
    assert np.allclose((words**2).sum(1), 1) and dense[:, : html_blocks.PATH_SLOTS].max() == 1
    x = np.zeros((1, len(page), dense.shape[1]), np.float32)
    x[0] = dense
    p = html_extract.fresh()
    whole, _ = html_extract.forward(p, x, np.array([len(page)]))
    assert np.allclose(html_extract.Model(p).logits([page])[0], whole[0], atol=1e-4)


def test_a_pages_own_marks_do_not_count():
    page = "<body><div data-truth='1'>side</div><article data-truth=\"0\"><p>main</p></article></body>"
    marked = html_extract.variants(page, ["text"], np.random.default_rng(0))[0]
    assert [(b.text, b.truth) for b in html_blocks.blocks(marked)] == [("side", 0), ("main", 1)]


def test_html_query_against_the_marked_text(spark):
    path = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    rows = queries.QUERIES["op7_html_extract"](spark, path).collect()
    assert {r["page_id"] for r in rows} == set(pages)
    scores = []
    for r in rows:
        assert r["n_chars"] == len(r["text"])
        found = html_extract.variants(pages[r["page_id"]] or "", ["text"], np.random.default_rng(0))
        if found:
            want = Counter(" ".join(b.text for b in html_blocks.blocks(found[0]) if b.truth).split())
            got = Counter(r["text"].split())
            both = sum((want & got).values())
            scores.append(2 * both / max(1, sum(want.values()) + sum(got.values())))
    assert len(scores) > len(pages) / 2 and np.mean(scores) > 0.9


def test_random_strings_of_many_forms_are_found_and_ordinary_ones_are_not(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = secret_scan.fit(docs)
    rng = random.Random(1)
    forms = {
        string.ascii_letters + string.digits: (16, 20, 32), "0123456789ABCDEF": (16, 32), "0123456789abcdef": (16, 20),
        string.ascii_letters: (16, 24), string.ascii_lowercase: (20, 24), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567": (20, 26),
    }
    for alphabet, lengths in forms.items():
        for n in lengths:
            keys = ["".join(rng.choices(alphabet, k=n)) for _ in range(300)]
            assert np.mean([model.is_secret(k) for k in keys]) > 0.93, (alphabet, n)
    plain = ["x" * 30, "ab" * 12, "A" * 16, "abcabcabcabcabcabc", "X-X-X-X-X-X-X-X-X-", "1234567890123456", "2024-01-30/10-15-00", "=" * 40]
    assert not any(map(model.is_secret, plain))
    # Whole texts: ordinary runs of this length are left alone.
    texts = [r["text"] for r in docs.select("text").collect() if r["text"]]
    runs = [(text, m) for text in texts for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text)]
    ordinary = [m[0] for text, m in runs if not secret_scan.Covered(secret_scan.fixed_spans(text)).meets(*m.span())]
    found = [r for r in ordinary if model.is_secret(r)]
    assert len(found) <= max(1, len(ordinary) // 50)


def test_decontamination_of_texts_that_repeat_a_word(spark):
    items = [(1, "la " * 1_600), (2, "one two three " * 40), (3, "la la la na na na la la la na na na"), (4, "x " + "la " * 9 + "y")]
    texts = ["la " * 16_000, "la " * 9, "three one two " * 50, "na " * 30 + "la " * 12, "a b " + "la " * 9 + "y z", "x " + "la " * 9 + "y", None, "la la la na na na la la la na"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    began = time.monotonic()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.judge(docs, bench).collect()}
    assert time.monotonic() - began < 60
    from test_text_operators import plain_hits

    assert got == {i: plain_hits(t, items) for i, t in enumerate(texts)}
    # One window of the many equal ones is looked up: two probes.
    words = decontaminate.item_words(bench.where("item_id = 1"))
    none = spark.createDataFrame([], "word string, n long")
    assert decontaminate.probes(words, none).count() == decontaminate.PROBES


def plain_near(text, item, size=10, least=4):
    """Whether some window of the item is within one edit of some stretch of the text."""
    doc, own = words(text), words(item)
    width = min(size, len(own))
    if width < least:
        return False
    for start in range(len(own) - width + 1):
        row = [0] * (len(doc) + 1)  # a stretch may begin anywhere
        for i, word in enumerate(own[start : start + width], 1):
            before, row = row, [i] * (len(doc) + 1)
            for j, other in enumerate(doc, 1):
                row[j] = min(before[j - 1] + (word != other), before[j] + 1, row[j - 1] + 1)
        if min(row) <= 1:
            return True
    return False


def test_near_passages_against_edit_distances(spark):
    from test_text_operators import plain_hits

    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(40)] + ["rare", "x1"]
    draw = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    items = [(i, " ".join(draw(int(rng.integers(2, 26))))) for i in range(30)] + [(90, None), (91, "w1 " * 14), (92, "never seen words of this item that no text has at all")]
    texts = []
    for i in range(120):
        own = words(items[i % 30][1])
        begin = int(rng.integers(0, max(1, len(own) - 9)))
        part = own[begin : begin + int(rng.integers(8, 16))]
        for _ in range(int(rng.integers(0, 3))):
            at = int(rng.integers(0, len(part)))
            part = [[*part[:at], "new", *part[at + 1 :]], [*part[:at], *part[at + 1 :]], [*part[:at], "w3", *part[at:]]][int(rng.integers(3))] or part
        texts.append(" ".join([*draw(int(rng.integers(0, 9))), *part, *draw(int(rng.integers(0, 9)))]))
    texts += [None, "", "w1 " * 9, "w1 " * 8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["near_items"]) for r in decontaminate.judge(docs, bench, near=True).collect()}
    near = 0
    for i, text in enumerate(texts):
        _, n_hit, found = plain_hits(text, items)
        want = sorted(k for k, item in items if k not in found and plain_near(text, item))
        assert got[i] == (n_hit, found, want), (i, text)
        near += len(want)
    assert near > 20
