"""A key's value some time earlier, from ranges of (key, time)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, value_before

SCHEMA = "symbol string, observed_at timestamp, price_usd decimal(18,8), part int, kind string"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def ranges(spark):
    """Ranges stay as many as there are partitions, and batches are short, so keys and facts cross both."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(rows, lag):
    out = {}
    for symbol, moment, price, *_ in rows:
        past = [(t, p) for s, t, p, *_ in rows if s == symbol and t <= moment - lag]
        out[symbol, moment.replace(tzinfo=None)] = max(past)[1] if past else None
    return out


@pytest.mark.parametrize("lag", [60, 3_600, 86_400])
def test_equals_brute_force(spark, ranges, lag):
    random.seed(lag)
    rows = []
    for symbol, n in (("HOT", 260), ("B", 25), ("C", 1), ("a", 60), ("Z", 2)):
        for minute in sorted(random.sample(range(0, 3 * 1440), n)):
            price = None if random.random() < 0.1 else float(random.randint(1, 99))
            rows.append((symbol, START + dt.timedelta(minutes=minute), price, 1, "x"))
    frame = spark.createDataFrame([(s, t, None if p is None else Decimal(p), a, b) for s, t, p, a, b in rows], SCHEMA)
    got = value_before(frame, "before", lag).collect()
    want = plain(rows, dt.timedelta(seconds=lag))
    assert {(r["symbol"], r["observed_at"]): None if r["before"] is None else float(r["before"]) for r in got} == want
    assert len(got) == len(rows)


def test_one_key_in_one_hour_is_cut_into_ranges(spark, ranges, monkeypatch):
    stored = []
    own = asof.settle
    monkeypatch.setattr(asof, "settle", lambda df, label: stored.append(own(df, label)) or stored[-1])
    rows = spark.range(0, 6_000, 1, 8).selectExpr(
        "IF(id % 3 < 1, 'HOT', concat('s', id % 500)) AS symbol",
        "timestamp_micros(1704067200000000 + id * 500000) AS observed_at",
        "CAST(id AS DECIMAL(18, 8)) AS price_usd",
    )
    found = value_before(rows, "before", 60)
    hot = found.where("symbol = 'HOT'").select("price_usd", "before").collect()
    assert len(hot) == 2_000
    # Two rows a second, of which every third is HOT: 120 rows are a minute.
    assert all(r["before"] == (r["price_usd"] - 120 if r["price_usd"] >= 120 else None) for r in hot)
    parts = stored[0].where(F.col("kind") == asof.PROBE).groupBy("part").agg(F.count_if(F.col("key") == "HOT").alias("hot"), F.count("*").alias("n")).collect()
    assert sum(r["hot"] > 0 for r in parts) >= 3 and max(r["n"] for r in parts) < 2_000


def test_a_key_without_facts_in_many_ranges_and_empty_tables(spark, ranges):
    # The only fact lies far before; the ranges between hold probes and facts of later times alone.
    rows = [("K", START, Decimal(5), 1, "x")]
    rows += [("K", START + dt.timedelta(days=10, seconds=i), None, 1, "x") for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = value_before(frame, "before", 86_400).where(F.col("observed_at") > F.lit(START)).select("before").distinct().collect()
    assert [float(r["before"]) for r in got] == [5.0]
    assert value_before(frame.limit(0), "before").count() == 0
