"""The registered text queries: their SQL twins, plain second computations, held-out accuracy, and the pipeline."""

import hashlib
import zlib

import __spark_entry__ as registry
import corpus_pipeline
import numpy as np
import oracle
import public_tokenizers
import pytest
import tiktoken
from plain import plain_groups, words
from tidemark.llm import byte_bpe, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(SF_DIR)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_one_query_for_each_operator():
    numbers = [name.split("_")[0] for name in queries.QUERIES if name != "pipeline"]
    assert numbers == [f"op{n}" for n in range(1, 14)] and queries.QUERIES.items() <= registry.queries().items()


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    assert oracle.difference(queries.QUERIES[name](spark, SF_DIR), duck, queries.SQL[name]) is None


def test_near_dedup_matches_brute_force(spark, texts):
    rows = queries.QUERIES["op4_minhash_near_dedup"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_groups(texts)


def test_bpe_matches_library(spark, texts):
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.QUERIES["op5_byte_bpe"](spark, SF_DIR).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF_DIR[:-5]}0.01/documents.parquet").select("doc_id", "lang")
    lang = dict(map(tuple, d.collect()))
    rows = queries.QUERIES["op8_language_id"](spark, f"{SF_DIR[:-5]}0.01").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98

    labels = dict(map(tuple, spark.read.parquet(f"{SF_DIR[:-5]}0.01/labels.parquet").select("doc_id", "toxic").collect()))
    rows = queries.QUERIES["op9_toxicity"](spark, f"{SF_DIR[:-5]}0.01").collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.93


def test_pipeline(spark, texts):
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    ids = [r["doc_id"] for r in out]
    assert len(set(ids)) == len(ids) and set(ids) <= set(texts) and len(ids) > len(texts) / 3
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        assert after.count() <= docs.count()


def test_pipeline_takes_empty_tables_and_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0), (2, "", None, None, 0)], docs.schema)
    for n, rows in enumerate((docs.limit(0), odd)):
        path = f"{tmp_path}/{n}"
        rows.write.parquet(f"{path}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
        assert corpus_pipeline.run(spark, path).count() == (0, 3)[n]


def test_words():
    assert words("Ab-c éÉ 12") == ["ab", "c", "éÉ", "12"]
