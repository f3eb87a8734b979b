"""Operators on small hand-made rows: edge values, ties, skew, agreement with brute force."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import as_of_column, slot, with_rescued, within
from tidemark.operators import (
    Expectation,
    dedup_batch,
    drop_rate,
    enforce,
    latest_per_key,
    price_before,
    rank_descending,
    report,
)
from tidemark.plans import bronze, gold, monitors, reports, silver

UTC = dt.timezone.utc
AS_OF = "2024-01-31 00:00:00"


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def raw(spark, *payloads, moment="2024-01-30 12:00:00"):
    rows = [(at(moment), p if p is None or isinstance(p, str) else json.dumps(p), "t") for p in payloads]
    return spark.createDataFrame(rows, "snapshot_id timestamp, payload string, source string")


def prices(spark, *rows):
    """(symbol, time, price, change) rows as typed prices."""
    typed = [
        (s, "n", p, p, p, c, c, c, at(t) if isinstance(t, str) else t) for s, t, p, c in rows
    ]
    df = spark.createDataFrame(
        typed,
        "symbol string, name string, p double, v double, m double,"
        "pct_change_1h double, pct_change_24h double, pct_change_7d double, observed_at timestamp",
    )
    df = df.withColumns(
        {
            "price_usd": F.col("p").cast(schemas.PRICE),
            "volume_24h_usd": F.col("v").cast(schemas.MONEY),
            "market_cap_usd": F.col("m").cast(schemas.MONEY),
        }
    )
    return schemas.conform(df, schemas.SILVER)


# Parsing


def test_every_typed_column(spark):
    doc = {
        "symbol": "quartz-9",
        "name": "Quartz Nine",
        "current_price": 12.34567891,
        "total_volume": 987_654.325,
        "market_cap": 4_321_000_000.1,
        "price_change_percentage_1h_in_currency": -0.25,
        "price_change_percentage_24h": 7,
        "price_change_percentage_7d_in_currency": None,
    }
    df = silver.typed(raw(spark, doc))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.SILVER]
    row = df.first().asDict()
    assert {k: str(v) for k, v in row.items() if k != "observed_at"} == {
        "symbol": "QUARTZ-9",
        "name": "Quartz Nine",
        "price_usd": "12.34567891",
        "volume_24h_usd": "987654.33",
        "market_cap_usd": "4321000000.10",
        "pct_change_1h": "-0.25",
        "pct_change_24h": "7.0",
        "pct_change_7d": "None",
    }
    bare = silver.typed(raw(spark, {"symbol": "x"})).first().asDict()
    assert bare["symbol"] == "X" and bare["price_usd"] is bare["pct_change_24h"] is bare["name"] is None


@pytest.mark.parametrize(
    "text, symbol, price",
    [
        ('{"symbol":"a","current_price":"x"}', "A", None),
        ('{"symbol":"a","current_price":"1.5"}', "A", 1.5),
        ('{"symbol":"a","current_price":1e-8}', "A", 1e-8),
        ('{"symbol":"a","current_price":123456789012345}', "A", None),
        ('{"symbol":"a","current_price":0.123456785}', "A", 0.12345679),
        ('{"symbol":null,"current_price":1}', None, 1),
        ('{"current_price":1}', None, 1),
        ('{"symbol":', None, None),
        ("[1, 2]", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_parse_bad_fields_leave_the_rest(spark, text, symbol, price):
    rows = silver.typed(raw(spark, text)).collect()
    assert len(rows) == 1
    assert rows[0]["symbol"] == symbol
    got = rows[0]["price_usd"]
    assert (None if got is None else float(got)) == price


def test_wide_decimals_keep_all_digits(spark):
    row = silver.typed(raw(spark, '{"symbol":"a","market_cap":123456789012345678.91}')).first()
    assert str(row["market_cap_usd"]) == "123456789012345678.91"


def test_extra_field_is_one_schema_entry(spark):
    df = silver.typed(
        raw(spark, {"symbol": "a", "circulating_supply": 21}),
        (*schemas.PAYLOAD_FIELDS, schemas.CIRCULATING_SUPPLY),
    )
    assert float(df.first()["circulating_supply"]) == 21.0


def test_parse_happens_once_under_a_symbol_filter(spark, capsys):
    silver.build_batch(raw(spark, {"symbol": "a"})).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("from_json(") == 1


def test_rescued_fields(spark):
    df = raw(spark, '{"symbol":"a","new":{"x":1},"b":"t"}', '{"symbol":"a"}', "broken{")
    got = [r[0] for r in with_rescued(df, "payload", ["symbol"]).select("_rescued_data").collect()]
    assert json.loads(got[0]) == {"new": '{"x":1}', "b": "t"}
    assert got[1:] == [None, None]


# Expectations and quarantine


def test_payload_rule_is_more_than_ten_characters(spark):
    df = enforce(raw(spark, "x" * 10, "x" * 11, "ñ" * 11, "", None), bronze.RULES)
    assert sorted(r["payload"] for r in df.collect()) == sorted(["x" * 11, "ñ" * 11])


def test_warn_keeps_drop_removes_and_null_fails(spark):
    rules = [Expectation("pos", "v > 0"), Expectation("key", "k IS NOT NULL AND k <> 'z'", "drop")]
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), (None, 1), ("z", None)], "k string, v int")
    metrics = Observation()
    kept = enforce(df, rules, metrics)
    assert sorted(r["k"] for r in kept.collect()) == ["a", "b", "c"]
    assert metrics.get == {"rows_in": 5, "rows_dropped": 2, "pos": 3, "key": 2}
    lines = {r["expectation"]: (r["action"], r["checked"], r["failed"]) for r in report(df, rules).collect()}
    assert lines == {"pos": ("warn", 5, 3), "key": ("drop", 5, 2)}
    with pytest.raises(ValueError):
        Expectation("x", "TRUE", "ignore")


def test_drop_rate_alerts_above_the_limit(spark):
    rules = [Expectation("key", "k IS NOT NULL", "drop")]
    some = spark.createDataFrame([("a",)] * 19 + [(None,)], "k string")
    row = drop_rate(some, "t", rules).first()
    assert (row["rows_in"], row["rows_dropped"], row["drop_rate"], row["alert"]) == (20, 1, 0.05, False)
    assert drop_rate(some.limit(0), "t", rules).first()["drop_rate"] == 0.0
    assert drop_rate(some, "t", rules, limit=0.04).first()["alert"] is True


def test_quarantine_reasons(spark):
    good = '{"symbol":"a","current_price":1}'
    df = raw(spark, good, "short", None, '{"symbol":', "[{\"symbol\":\"a\"}]", '{"name":"nobody"}', '{"symbol":null}')
    got = sorted((r["payload"] or "", r["reason"]) for r in bronze.quarantine(df).collect())
    assert got == sorted(
        [
            ("short", "non_empty_payload"),
            ("", "non_empty_payload"),
            ('{"symbol":', "non_empty_payload"),
            ('[{"symbol":"a"}]', "unparseable"),
            ('{"name":"nobody"}', "symbol_not_null"),
            ('{"symbol":null}', "symbol_not_null"),
        ]
    )


# Dedup and latest


def test_dedup_keeps_the_first_by_order(spark):
    df = spark.createDataFrame(
        [("a", 1, 3), ("a", 1, 2), ("a", 2, 9), (None, 1, 5), (None, 1, 4)], "symbol string, observed_at int, id int"
    )
    got = {(r[0], r[1], r[2]) for r in dedup_batch(df, ["id"]).collect()}
    assert got == {("a", 1, 2), ("a", 2, 9), (None, 1, 4)}


def test_dedup_and_latest_cut_rows_before_the_shuffle(spark, capsys):
    df = spark.range(10).selectExpr("id % 2 AS symbol", "hash(id) AS observed_at", "id + 1 AS id")
    for result in (dedup_batch(df, ["id"]), latest_per_key(df)):
        result.explain("simple")
        plan = capsys.readouterr().out
        assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_latest_takes_ties_in_order(spark):
    df = spark.createDataFrame([("a", 5, 2), ("a", 5, 1), ("a", 4, 0)], "symbol string, observed_at int, x int")
    assert [r["x"] for r in latest_per_key(df, ties=["x"]).collect()] == [1]


# Rank


def brute_rank(values):
    key = lambda v: (v is not None, v if v is not None else 0)
    return {v: 1 + sum(key(w) > key(v) for w in values) for v in set(values)}


@pytest.mark.parametrize("slices, nulls", [(4, 30), (4, 500), (1, 30), (300, 30)])
def test_rank_with_ties_nulls_and_a_heavy_value(spark, slices, nulls):
    random.seed(7)
    values = [float(random.randint(-40, 40)) for _ in range(600)] + [2.5] * 300 + [None] * nulls + [0.0, -0.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)
    got = rank_descending(df, "v", "r", slices=slices).collect()
    want = brute_rank(values)
    assert sorted(r["id"] for r in got) == list(range(len(values)))
    assert all(r["r"] == want[r["v"]] for r in got)


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert rank_descending(df, "v", "r", slices=4).count() == 0


# Views


def test_momentum_ranks_with_gaps_and_nulls_last(spark):
    df = prices(
        spark,
        ("A", "2024-01-30 10:00:00", 1.0, 5.0),
        ("A", "2024-01-30 11:00:00", 2.0, 3.0),
        ("B", "2024-01-30 11:00:00", 2.0, 3.0),
        ("C", "2024-01-30 11:00:00", 2.0, 1.0),
        ("D", "2024-01-30 11:00:00", 2.0, None),
        ("EDGE", "2024-01-30 00:00:00", 2.0, 9.0),
        ("OLD", "2024-01-29 23:59:59", 2.0, 99.0),
        ("LATER", "2024-01-31 00:00:01", 2.0, 99.0),
    )
    for slices in (1, 3):
        view = gold.momentum(df, AS_OF, slices=slices)
        assert view.schema["momentum_rank"].dataType == T.IntegerType()
        got = {r["symbol"]: (r["momentum_rank"], float(r["price_usd"])) for r in view.collect()}
        assert got == {"EDGE": (1, 2.0), "A": (2, 2.0), "B": (2, 2.0), "C": (4, 2.0), "D": (5, 2.0)}


def test_volatility_days_zero_price_and_minimum(spark):
    df = prices(
        spark,
        *[("A", f"2024-01-{d} {h}:00:00", p, 0.0) for d, h, p in
          [(28, 10, 1.0), (28, 11, 2.0), (29, 10, 1.0), (29, 23, 1.5), (30, 10, 4.0), (30, 11, 5.0)]],
        *[("Z", f"2024-01-{d} 10:00:00", 0.0, 0.0) for d in (27, 28, 29, 30)],
        *[("TWO", f"2024-01-{d} 10:00:00", 1.0, 0.0) for d in (29, 30)],
        ("A", "2024-01-23 23:59:59", 100.0, 0.0),
    )
    got = {r["symbol"]: r for r in gold.volatility(df, AS_OF).collect()}
    assert set(got) == {"A", "Z"}
    returns = [1.0, 0.5, 0.25]
    mean = sum(returns) / 3
    want = (sum((r - mean) ** 2 for r in returns) / 2) ** 0.5 * 365**0.5
    assert abs(got["A"]["realized_volatility_7d"] - want) < 1e-9
    assert got["A"]["n_observations"] == 3 and got["A"]["last_observed_at"] == dt.date(2024, 1, 30)
    assert got["Z"]["realized_volatility_7d"] is None and got["Z"]["n_observations"] == 4


def test_days_follow_utc(spark):
    df = prices(spark, ("A", "2024-01-29 23:59:59", 1.0, 0.0), ("A", "2024-01-30 00:00:00", 3.0, 0.0))
    assert gold.daily_range(df, AS_OF).count() == 2


@pytest.mark.parametrize("slot_seconds", [3_600, 86_400])
def test_price_before_equals_brute_force(spark, slot_seconds):
    random.seed(3)
    start = at("2024-01-01 00:00:00")
    rows = []
    for symbol, n in (("HOT", 300), ("B", 25), ("C", 1)):
        for minute in sorted(random.sample(range(0, 14 * 1440, 5), n)):
            price = None if random.random() < 0.1 else float(random.randint(1, 99))
            rows.append((symbol, start + dt.timedelta(minutes=minute), price, 0.0))
    got = price_before(prices(spark, *rows), "before", slot_seconds=slot_seconds).collect()
    assert len(got) == len(rows)
    history = {}
    for symbol, moment, price, _ in rows:
        history.setdefault(symbol, []).append((moment.replace(tzinfo=None), price))
    for r in got:
        past = [p for t, p in history[r["symbol"]] if t <= r["observed_at"] - dt.timedelta(days=1)]
        want = past[-1] if past else None
        assert (None if r["before"] is None else float(r["before"])) == want


def test_correlation_uses_common_slots(spark):
    rows = []
    for hour, a, b in ((1, 1.0, 2.0), (2, 2.0, 4.0), (3, 3.0, 6.5), (4, 9.0, None)):
        rows.append(("A", f"2024-01-30 0{hour}:10:00", a, 0.0))
        if b is not None:
            rows.append(("B", f"2024-01-30 0{hour}:20:00", b, 0.0))
    row = gold.correlation(prices(spark, *rows), AS_OF, "A", "B").first()
    assert row["n_slots"] == 3 and abs(row["correlation"] - 0.9979) < 1e-4


# Reports, monitors, time


def test_reports(spark):
    df = prices(spark, *[(f"S{i:02d}", "2024-01-30 10:00:00", float(i), float(i % 5) - 2 + 0.123456) for i in range(30)])
    view = gold.momentum(df, AS_OF)
    assert [r["symbol"] for r in reports.top_gainers(view).collect()] == ["S04", "S09", "S14", "S19", "S24"]
    assert [r["symbol"] for r in reports.top_market_cap(view, 2).collect()] == ["S29", "S28"]
    assert {r["momentum_rank"] for r in reports.top_momentum(view).collect()} == {1, 7}
    assert reports.change_distribution(view).count() == 24
    assert [r["symbol"] for r in reports.price_lookup(view, "s07").collect()] == ["S07"]
    assert reports.price_lookup(view, "' OR '1'='1").count() == 0
    counts = reports.movers(view).first().asDict()
    assert counts == {"gainers": 18, "losers": 12, "unchanged": 0, "unknown": 0}
    assert {r["pct_change_24h"] for r in reports.presented(view).collect()} == {-1.8765, -0.8765, 0.1235, 1.1235, 2.1235}
    assert reports.most_volatile(gold.volatility(df, AS_OF)).count() == 0


def test_gaps_and_growth(spark):
    times = ["2024-01-30 00:05:00", "2024-01-30 00:05:01", "2024-01-30 00:50:00", "2024-01-30 01:00:00"]
    df = spark.createDataFrame([(at(t),) for t in times], "snapshot_id timestamp")
    later = "2024-01-30 01:40:00"
    gaps = sorted(r["slot"] for r in monitors.capture_gaps(df, later, days=1).collect())
    day_before = dt.datetime(2024, 1, 29, 1, 30)
    assert gaps[:90] == [day_before + dt.timedelta(minutes=15 * i) for i in range(90)]
    # Within the captures, and from the last one up to the slot that is not over yet.
    assert gaps[90:] == [dt.datetime(2024, 1, 30, 0, 15), dt.datetime(2024, 1, 30, 0, 30), dt.datetime(2024, 1, 30, 1, 15)]
    rows = {r["day"].day: (r["captures"], r["row_count"], r["missing"]) for r in monitors.capture_growth(df, "2024-02-01 00:00:00", days=3).collect()}
    assert rows == {29: (0, 0, 96), 30: (3, 4, 93), 31: (0, 0, 96)}


def test_one_absurd_stamp_does_not_stretch_the_monitors(spark):
    df = spark.createDataFrame([(at(t),) for t in ("0001-01-02 00:00:00", "9999-01-01 00:00:00")], "snapshot_id timestamp")
    assert monitors.capture_gaps(df, AS_OF, days=2).count() == 192


def test_freshness_and_coverage(spark):
    silver_rows = (("A", "2024-01-30 23:45:00", 1.0, 0.0), ("B", "2024-01-30 23:00:00", 1.0, 0.0), ("GONE", "2024-01-20 23:00:00", 1.0, 0.0))
    df = gold.momentum(prices(spark, *silver_rows), AS_OF)
    assert not monitors.freshness_coverage(df, AS_OF, min_symbols=3).first()["covered"]
    row = monitors.freshness_coverage(df, AS_OF, min_symbols=2).first()
    assert (row["age_seconds"], row["fresh"], row["covered"]) == (900.0, True, True)
    late = monitors.freshness_coverage(df, "2024-01-31 00:00:01", min_symbols=3).first()
    assert (late["fresh"], late["covered"]) == (False, False)
    ahead = prices(spark, ("A", "2099-01-30 23:45:00", 1.0, 0.0))
    assert not monitors.freshness_coverage(ahead, AS_OF).first()["fresh"]
    empty = monitors.freshness_coverage(df.limit(0), AS_OF).first()
    assert (empty["fresh"], empty["covered"]) == (False, False)


def test_slots_and_as_of(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.cast("string")).first()[0]
    assert pick(slot(F.lit("2024-01-30 10:44:59.5").cast("timestamp"), 15)) == "2024-01-30 10:30:00"
    assert pick(slot(F.lit("1969-12-31 23:59:59").cast("timestamp"), 15)) == "1969-12-31 23:45:00"
    for moment in ("2024-01-30T10:00:00Z", "2024-01-30 05:00:00-05:00", dt.datetime(2024, 1, 30, 10), at("2024-01-30 10:00:00")):
        assert pick(as_of_column(moment)) == "2024-01-30 10:00:00"


def test_conform_refuses_other_types(spark):
    with pytest.raises(TypeError, match="momentum_rank"):
        schemas.conform(spark.range(1).withColumnRenamed("id", "momentum_rank"), schemas.MOMENTUM)


def test_time_cut_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    df = prices(spark, ("A", "2024-01-30 10:00:00", 1.0, 0.0), ("A", "2024-01-20 10:00:00", 1.0, 0.0))
    from tidemark.sources import write_clustered

    write_clustered(df, path)
    recent = within(spark.read.parquet(path), "observed_at", AS_OF, "24 HOURS").select("symbol")
    recent.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(observed_at" in plan and "dt" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<symbol:string,observed_at:timestamp>" in plan
    assert recent.count() == 1
