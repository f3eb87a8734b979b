"""Payloads stored as VARIANT give what the text gives."""

import json

from tidemark.functions import parse, rescued_document, typed_document, with_document, with_rescued
from tidemark.schemas import PAYLOAD_FIELDS


def test_fields_and_rest_equal_those_of_the_text(spark, tmp_path):
    objects = [
        {"symbol": "btc", "current_price": 65000.5, "name": "ñ", "market_cap": 3},
        {"symbol": "a", "current_price": "1.5", "total_volume": None, "surprise": 7},
        {"symbol": None, "current_price": "x", "market_cap": 1e40, "price_change_percentage_24h": 1.25e-3},
        {"name": "only", "current_price": 12345678901.123456789, "more": "text"},
        {},
    ]
    texts = [json.dumps(o, ensure_ascii=False) for o in objects] + ['{"symbol":', "plain words", "", None, '{"symbol":"z","current_price":0.000000014}']
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    path = str(tmp_path / "stored")
    with_document(raw).write.parquet(path)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["document"] == "variant"
    want = sorted(map(str, parse(raw, PAYLOAD_FIELDS, ["id"]).collect()))
    assert sorted(map(str, typed_document(stored, PAYLOAD_FIELDS, ["id"]).collect())) == want
    known = [f.key for f in PAYLOAD_FIELDS]
    rest = lambda df: {r["id"]: r["_rescued_data"] for r in df.select("id", "_rescued_data").collect()}
    assert rest(rescued_document(stored, known)) == rest(with_rescued(raw, "payload", known))
