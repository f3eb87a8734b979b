"""Sources, stored tables, streams, and whole updates."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import medallion, session
from tidemark.operators import dedup_stream
from tidemark.plans import bronze, gold, reports, silver
from tidemark.sources import (
    current_version,
    read_current,
    read_landing,
    read_table,
    refresh,
    register,
    save_clustered_table,
    stream_landing,
    write_clustered,
    write_landing,
)
from tidemark.sources import snapshot_files
from tidemark.sources.tables import drop_old_versions
from tidemark.streaming import bronze_stream, finish, quarantine_stream, silver_stream


def land(root, name, rows, day="2024-01-30", hour="10"):
    """Write one landed file by hand."""
    folder = os.path.join(root, f"dt={day}", f"hh={hour}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        for row in rows:
            file.write((row if isinstance(row, str) else json.dumps(row, ensure_ascii=False)) + "\n")


def capture(moment, *symbols, price=1.0, **more):
    return [
        {"symbol": s, "name": s, "current_price": price, "market_cap": 5, "_ingestion_ts": moment, **more}
        for s in symbols
    ]


def typed_keys(spark, layout):
    rows = medallion.silver_table(spark, layout).collect()
    return sorted((r["symbol"], str(r["observed_at"])) for r in rows)


# Landing area and the data source by short name


def test_landing_roundtrip_keeps_rows_text_and_hours(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = spark.sql(
        "SELECT TIMESTAMP '2024-01-30 23:59:59.123456' AS at, 'ñandú' AS symbol, 1.50BD AS price, NULL AS x "
        "UNION ALL SELECT TIMESTAMP '2024-01-31 07:00:00', 'b', 2, NULL"
    )
    write_landing(rows, path, "at")
    back = bronze.from_landing(read_landing(spark, path), "s").orderBy("snapshot_id").collect()
    assert back[0]["payload"] == '{"symbol":"ñandú","price":1.50,"_ingestion_ts":"2024-01-30T23:59:59.123456Z"}'
    assert back[0]["snapshot_id"] == dt.datetime(2024, 1, 30, 23, 59, 59, 123456)
    lines = read_landing(spark, path)
    assert {(str(r["dt"]), r["hh"]) for r in lines.collect()} == {("2024-01-30", "23"), ("2024-01-31", "07")}
    assert len(lines.where("dt = DATE '2024-01-31'").inputFiles()) >= 1


def test_hot_hour_is_shared_out(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = spark.range(0, 4000, 1, 8).selectExpr("TIMESTAMP '2024-01-30 10:00:00' AS at", "id")
    write_landing(rows, path, "at")
    files = read_landing(spark, path).select("source_file").distinct().count()
    assert files > 1
    assert read_landing(spark, path).count() == 4000


def test_capture_time_falls_back_to_the_directory(spark, tmp_path):
    land(tmp_path, "a.jsonl", ['{"symbol":"a"}', "not json at all", '{"symbol":"b","_ingestion_ts":"bad"}'])
    times = {str(r["snapshot_id"]) for r in bronze.from_landing(read_landing(spark, str(tmp_path)), "s").collect()}
    assert times == {"2024-01-30 10:00:00"}


def test_slots_join_reruns_of_a_capture(spark, tmp_path):
    land(tmp_path, "a.jsonl", capture("2024-01-30T10:00:03Z", "a") + capture("2024-01-30T10:07:41Z", "a"))
    rows = bronze.from_landing(read_landing(spark, str(tmp_path)), "s", slot_minutes=15)
    assert silver.build_batch(rows).count() == 1


def test_lineage_and_rescued(spark, tmp_path):
    land(tmp_path, "a.jsonl", capture("2024-01-30T10:00:00Z", "a", surprise=7) + capture("2024-01-30T10:00:00Z", "b"))
    rows = bronze.with_lineage(read_landing(spark, str(tmp_path))).orderBy("payload").collect()
    assert [r["_rescued_data"] for r in rows] == ['{"surprise":"7"}', None]
    assert all(r["_source_file"].endswith("dt=2024-01-30/hh=10/a.jsonl") for r in rows)


@pytest.mark.parametrize("split_bytes", [1, 50, 1 << 20])
def test_snapshot_files_batch_equals_text_source(spark, tmp_path, split_bytes):
    root = str(tmp_path)
    land(root, "a.jsonl", capture("2024-01-30T10:00:00Z", *"abcdefgh"))
    land(root, "b.jsonl", ["broken {", "", *capture("2024-01-30T11:30:00.5Z", "ñ")], hour="11")
    land(root, "_hidden.jsonl", ["no"])
    register(spark)
    reader = spark.read.format("snapshot_files").option("source", "s").option("splitBytes", split_bytes)
    ours = reader.load(root)
    assert [f.nullable for f in ours.schema] == [False] * 3
    builtin = bronze.from_landing(read_landing(spark, root), "s").where("payload <> ''").select(ours.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, builtin.collect()))
    if split_bytes == 50:
        assert ours.rdd.getNumPartitions() > 5


def test_snapshot_files_reads_whole_responses(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-30" / "hh=09"
    folder.mkdir(parents=True)
    (folder / "r.json").write_text(json.dumps([{"symbol": "a", "x": 1.50}, {"symbol": "ñ"}]), encoding="utf-8")
    register(spark)
    rows = spark.read.format("snapshot_files").option("slotMinutes", 15).load(str(tmp_path)).collect()
    assert sorted(r["payload"] for r in rows) == ['{"symbol": "a", "x": 1.5}', '{"symbol": "ñ"}']
    assert {str(r["snapshot_id"]) for r in rows} == {"2024-01-30 09:00:00"}


def test_snapshot_files_offsets_bound_and_replay(tmp_path):
    root = str(tmp_path)
    reader = snapshot_files._StreamReader({"path": root})
    first = reader.initialOffset()
    assert reader.latestOffset() == first
    land(root, "a.jsonl", capture("2024-01-30T10:00:00Z", "a"))
    one = reader.latestOffset()
    land(root, "b.jsonl", capture("2024-01-30T10:15:00Z", "b"))
    two = reader.latestOffset()
    names = lambda start, end: [
        os.path.basename(r[0]) for p in reader.partitions(start, end) for r in p.ranges
    ]
    assert names(first, one) == ["a.jsonl"] and names(one, two) == ["b.jsonl"]
    land(root, "c.jsonl", capture("2024-01-30T10:30:00Z", "c"))
    assert names(first, two) == ["a.jsonl", "b.jsonl"]
    young = snapshot_files._StreamReader({"path": root, "settleSeconds": "3600"})
    assert young.latestOffset() == first


def test_snapshot_files_stream_takes_each_file_once(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    register(spark)

    def update():
        raw = spark.readStream.format("snapshot_files").option("source", "s").load(landing)
        return finish(bronze_stream(raw, out, checkpoint))

    land(landing, "a.jsonl", capture("2024-01-30T10:00:00Z", "a", "b"))
    update()
    land(landing, "b.jsonl", [*capture("2024-01-30T10:15:00Z", "a"), "short"])
    update()
    update()
    stored = read_table(spark, out)
    assert stored.count() == 4 and bronze.kept(stored).count() == 3
    assert stored.where("verdict = 'rejected'").first()["payload"] == "short"


# Stored tables


def test_views_switch_only_to_complete_versions(spark, tmp_path):
    root = str(tmp_path / "view")
    with pytest.raises(FileNotFoundError):
        read_current(spark, root)
    assert refresh(spark.range(3), root) == 1
    old = read_current(spark, root)
    assert refresh(spark.range(5), root) == 2
    os.makedirs(f"{root}/v=000000000003")  # a refresh that died
    assert current_version(spark, root) == 2
    assert read_current(spark, root).count() == 5 and old.count() == 3
    assert refresh(spark.range(7), root) == 4


def test_clustered_files_are_narrow_and_split_a_hot_symbol(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 9000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'HOT', concat('s', id % 97)) AS symbol",
        "timestamp_seconds(1706572800 + id) AS observed_at",
        "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_clustered(df, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert back.count() == 9000
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(
        F.count_if(F.col("symbol") == "HOT").alias("hot"), F.count_distinct("symbol").alias("symbols")
    ).collect()
    assert sum(r["hot"] > 0 for r in per_file) >= 2
    assert max(r["symbols"] for r in per_file) < 60


class Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, named, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext, self.master, self.folder = self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_named_one_and_never_local_on_a_cluster():
    assert session.shared_dir(Session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        session.shared_dir(Session(None, "yarn"))
    with pytest.raises(RuntimeError):
        session.shared_dir(Session(None, "local[2]"))


def test_settled_tables_are_read_back_unchanged(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS DECIMAL(18, 8)) AS b, TIMESTAMP '2024-01-30 10:00:00' AS c")
    settled = session.settle(df, "x")
    assert settled.collect() == df.collect()
    assert settled.inputFiles()[0].removeprefix("file://").startswith(session.shared_dir(spark).removeprefix("file:"))


# Streams


def waves(spark, tmp_path, *groups):
    """Typed keys delivered in order, one file per micro-batch."""
    path = str(tmp_path / "waves")
    for group in groups:
        rows = [(s, dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc)) for s, t in group]
        df = spark.createDataFrame(rows, "symbol string, observed_at timestamp")
        df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("symbol string, observed_at timestamp").option("maxFilesPerTrigger", 1).parquet(path)


def drain(df, tmp_path, name="out"):
    query = (
        df.writeStream.format("parquet")
        .option("path", str(tmp_path / name))
        .option("checkpointLocation", str(tmp_path / f"{name}-ck"))
        .trigger(availableNow=True)
        .start()
    )
    return finish(query)


@pytest.mark.parametrize("split", [True, False])
def test_stream_dedup_copies_across_batches_and_late_rows(spark, tmp_path, split):
    source = waves(
        spark,
        tmp_path,
        [("a", "2024-01-30 10:00:00")] * 3 + [("b", "2024-01-30 10:00:00")],
        [("a", "2024-01-30 10:00:00"), ("a", "2024-01-30 12:00:00")],
        [("c", "2024-01-30 08:00:00"), ("d", "2024-01-30 11:30:00"), (None, "2024-01-30 12:00:00")],
    )
    summary = drain(dedup_stream(source, split_hot_keys=split), tmp_path)
    kept = sorted((r["symbol"] or "", str(r["observed_at"])[11:16]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert kept == [("", "12:00"), ("a", "10:00"), ("a", "12:00"), ("b", "10:00"), ("d", "11:30")]
    assert summary.rows_in == 9 and summary.late_rows == 1


def test_stream_equals_batch_with_one_key_of_many_copies(spark, tmp_path):
    landing = str(tmp_path / "in")
    for part in range(6):
        rows = [r for h in range(3) for r in capture(f"2024-01-30T1{h}:00:00Z", "hot", *"xyz")]
        land(landing, f"{part}.jsonl", rows * 40)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    finish(bronze_stream(bronze.from_landing(stream_landing(spark, landing), "s"), raw, str(tmp_path / "c1")))
    summary = finish(silver_stream(spark, raw, out, str(tmp_path / "c2")))
    batch = silver.build_batch(bronze.from_landing(read_landing(spark, landing), "s"))
    stream = read_table(spark, out, medallion.SILVER_STORED).drop("dt")
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))
    assert summary.metrics["silver"]["rows_in"] == 12 and summary.rows_in == 2880


def test_stream_metrics_count_after_dedup_and_add_up(spark, tmp_path):
    landing = str(tmp_path / "in")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")

    def update():
        taken = finish(bronze_stream(bronze.from_landing(stream_landing(spark, landing), "s"), raw, str(tmp_path / "c1")))
        return taken, finish(silver_stream(spark, raw, out, str(tmp_path / "c2"), max_files=1))

    land(landing, "a.jsonl", [*capture("2024-01-30T10:00:00Z", "a", "a", "b", None, None, price=0), "tiny"])
    taken, typed = update()
    assert taken.metrics["bronze"] == {"rows_in": 6, "rows_dropped": 1, "non_empty_payload": 1}
    want = {"rows_in": 3, "rows_dropped": 1, "price_positive": 3, "symbol_not_null": 1, "valid_market_cap": 0}
    assert typed.metrics["silver"] == want
    assert sorted(r["symbol"] for r in read_table(spark, out).collect()) == ["A", "B"]


def test_quarantine_stream_keeps_rejects_whole(spark, tmp_path):
    landing, raw, out = (str(tmp_path / n) for n in ("in", "raw", "q"))
    long_text = "no json here " * 500
    land(landing, "a.jsonl", [*capture("2024-01-30T10:00:00Z", "a", None), "tiny", long_text.strip()])
    finish(bronze_stream(bronze.from_landing(stream_landing(spark, landing), "s"), raw, str(tmp_path / "c1")))
    finish(quarantine_stream(spark, raw, out, str(tmp_path / "c2")))
    got = {r["reason"]: r["payload"] for r in spark.read.json(out).collect()}
    assert set(got) == {"symbol_not_null", "non_empty_payload", "unparseable"}
    assert got["unparseable"] == long_text.strip() and got["non_empty_payload"] == "tiny"


def test_failed_batch_is_replayed_without_new_rows(spark, tmp_path):
    """The commit record of a finished batch is lost: the batch runs again."""
    landing, raw, out, ck = (str(tmp_path / n) for n in ("in", "raw", "out", "ck"))
    land(landing, "a.jsonl", capture("2024-01-30T10:00:00Z", "a", "b"))
    rows = lambda: bronze.from_landing(stream_landing(spark, landing), "s")
    finish(bronze_stream(rows(), raw, ck))
    os.remove(os.path.join(ck, "commits", "0"))
    crc = os.path.join(ck, "commits", ".0.crc")
    if os.path.exists(crc):
        os.remove(crc)
    land(landing, "b.jsonl", capture("2024-01-30T10:15:00Z", "c"))
    finish(bronze_stream(rows(), raw, ck))
    assert sorted(json.loads(r["payload"])["symbol"] for r in read_table(spark, raw).collect()) == ["a", "b", "c"]


# Whole updates


def test_first_capture_of_a_hundred_symbols(spark, tmp_path):
    landing = str(tmp_path / "in")
    symbols = [f"s{i:03d}" for i in range(100)]
    rows = [
        {**capture("2024-01-30T10:00:00Z", s)[0], "price_change_percentage_24h": i / 7}
        for i, s in enumerate(symbols)
    ]
    land(landing, "a.jsonl", rows)
    layout = medallion.Layout(str(tmp_path / "tables"))
    update = medallion.run(spark, landing, layout, "s", "2024-01-30 10:05:00")
    assert read_table(spark, layout.table("bronze")).count() == 100
    assert medallion.silver_table(spark, layout).count() == 100
    ranks = [r["momentum_rank"] for r in medallion.momentum_view(spark, layout).collect()]
    assert sorted(ranks) == list(range(1, 101))
    assert medallion.volatility_view(spark, layout).count() == 0
    assert update.on_time and update.bronze.rows_in == 100
    assert (update.drop_rate, update.drop_alert) == (0.0, False)


def test_updates_step_by_step_equal_a_full_refresh(spark, tmp_path):
    landing = str(tmp_path / "in")
    step, full = (medallion.Layout(str(tmp_path / n)) for n in ("step", "full"))
    as_of = "2024-01-30 13:00:00"
    land(landing, "a.jsonl", capture("2024-01-30T10:00:00Z", "a", "b"))
    medallion.run(spark, landing, step, "s", as_of)
    land(landing, "b.jsonl", capture("2024-01-30T10:00:00Z", "a", "c") + capture("2024-01-30T11:00:00Z", "a"), hour="11")
    medallion.run(spark, landing, step, "s", as_of)
    medallion.run(spark, landing, step, "s", as_of)
    medallion.run(spark, landing, full, "s", as_of)
    assert typed_keys(spark, step) == typed_keys(spark, full) == [
        ("A", "2024-01-30 10:00:00"),
        ("A", "2024-01-30 11:00:00"),
        ("B", "2024-01-30 10:00:00"),
        ("C", "2024-01-30 10:00:00"),
    ]
    assert current_version(spark, step.table("momentum")) == 3
    views = [sorted(map(str, medallion.momentum_view(spark, x).collect())) for x in (step, full)]
    assert views[0] == views[1] and len(views[0]) == 3
    silver_rows = medallion.silver_table(spark, step)
    assert gold.momentum(silver_rows, as_of).count() == 3


def test_views_serve_sql_and_old_versions_go(spark, tmp_path):
    landing = str(tmp_path / "in")
    layout = medallion.Layout(str(tmp_path / "tables"))
    for day in (28, 29, 30):
        for hour, price in (("10", 1.0), ("11", 2.0)):
            rows = capture(f"2024-01-{day}T{hour}:00:00Z", "btc", "eth", price=price, price_change_percentage_24h=day - 29)
            land(landing, "a.jsonl", rows, f"2024-01-{day}", hour)
    register(spark)
    raw = spark.readStream.format("snapshot_files").option("source", "s").load(landing)
    medallion.run(spark, landing, layout, "s", "2024-01-30 12:00:00", raw=raw)
    for _ in range(3):
        medallion.refresh_views(spark, layout, "2024-01-30 12:00:00", keep_versions=2)
    assert sorted(os.listdir(layout.table("momentum"))) == ["v=000000000003", "v=000000000004"]
    medallion.create_views(spark, layout, prefix="md_")
    one = lambda text, **args: [tuple(r) for r in spark.sql(text, args=args).collect()]
    assert one(
        "SELECT symbol, momentum_rank FROM md_momentum WHERE momentum_rank <= 10 ORDER BY momentum_rank, symbol"
    ) == [("BTC", 1), ("ETH", 1)]
    assert one("SELECT symbol, n_observations FROM md_volatility ORDER BY realized_volatility_7d DESC, symbol LIMIT 1") == [("BTC", 3)]
    assert one("SELECT pct_change_24h FROM md_momentum WHERE UPPER(symbol) = UPPER(:coin)", coin="btc") == [(1.0,)]
    assert one("SELECT COUNT(*), MAX(observed_at) FROM md_silver") == [(12, dt.datetime(2024, 1, 30, 11))]
    assert one("SELECT COUNT(*) FROM md_bronze") == [(12,)]


def test_clustered_catalogue_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS clustered_check LOCATION '{tmp_path}/db'")
    df = spark.sql("SELECT 'a' AS symbol, TIMESTAMP '2024-01-30 10:00:00' AS observed_at, 1 AS x")
    save_clustered_table(df, "clustered_check.prices")
    assert spark.table("clustered_check.prices").select("symbol", "x").collect() == df.select("symbol", "x").collect()
    detail = spark.sql("DESCRIBE EXTENDED clustered_check.prices").collect()
    assert any("symbol" in str(r) and "luster" in str(r) for r in detail)


def test_rescued_sample_looks_only_at_rescued_rows(spark, tmp_path):
    land(tmp_path, "a.jsonl", capture("2024-01-30T10:00:00Z", *"abcdefgh") + capture("2024-01-30T10:00:00Z", *"stuvwxyz", new=1))
    sample = reports.rescued_sample(bronze.with_lineage(read_landing(spark, str(tmp_path))))
    assert [r[0] for r in sample.collect()] == ['{"new":"1"}'] * 5


def test_whole_json_files(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-30" / "hh=10"
    folder.mkdir(parents=True)
    for name, text in (("list", '[{"symbol":"a"},{"symbol":"b"}]'), ("one", '{"symbol":"c","status":1}'), ("broken", '{"symbol":')):
        (folder / f"{name}.json").write_text(text)
    register(spark)
    rows = spark.read.format("snapshot_files").load(str(tmp_path))
    assert sorted(r["payload"] for r in rows.collect()) == ['{"symbol":', '{"symbol": "a"}', '{"symbol": "b"}', '{"symbol": "c", "status": 1}']
    assert [r["reason"] for r in bronze.quarantine(rows).collect()] == ["non_empty_payload"]


def aged(path, days):
    moment = dt.datetime.now().timestamp() - days * 86_400
    os.utime(path, (moment, moment))


def test_no_capture_is_lost_whatever_the_order_and_age_of_files(spark, tmp_path):
    """Files are older the later their capture is, and taken one at a time; one is older than Spark's week."""
    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    for i, hour in enumerate(("10", "13", "16", "19")):
        land(landing, "a.jsonl", capture(f"2024-01-30T{hour}:00:00Z", "a", "b"), hour=hour)
        aged(f"{landing}/dt=2024-01-30/hh={hour}/a.jsonl", i)
    first = medallion.run(spark, landing, layout, "s", "2024-01-30 20:00:00", max_files=1)
    land(landing, "b.jsonl", capture("2024-01-30T11:00:00Z", "a"), hour="11")
    aged(f"{landing}/dt=2024-01-30/hh=11/b.jsonl", 9)
    second = medallion.run(spark, landing, layout, "s", "2024-01-30 20:00:00", max_files=1)
    want = [(s, f"2024-01-30 {h}:00:00") for s in "AB" for h in (10, 13, 16, 19)] + [("A", "2024-01-30 11:00:00")]
    assert typed_keys(spark, layout) == sorted(want)
    assert (first.audit.rows, second.audit.rows, second.audit.repaired) == (8, 1, 1)


def test_a_stamp_from_the_future_is_put_aside(spark, tmp_path):
    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    land(landing, "a.jsonl", capture("2099-01-30T10:00:00Z", "x") + capture("2024-01-30T10:00:00Z", "a"))
    medallion.run(spark, landing, layout, "s", "2024-01-30 11:00:00")
    land(landing, "b.jsonl", capture("2024-01-30T11:00:00Z", "a", "b"), hour="11")
    update = medallion.run(spark, landing, layout, "s", "2024-01-30 11:10:00")
    assert typed_keys(spark, layout) == [("A", "2024-01-30 10:00:00"), ("A", "2024-01-30 11:00:00"), ("B", "2024-01-30 11:00:00")]
    letters = spark.read.json(layout.table("quarantine")).collect()
    assert [r["reason"] for r in letters] == ["capture_time_implausible"] and update.drop_rate == 0
    stored = read_table(spark, layout.table("bronze")).where("verdict = 'implausible'").first()
    assert stored["_source_file"].endswith("a.jsonl") and stored["landed_at"] is not None
    view = read_current(spark, layout.table("freshness")).first()
    assert view["fresh"] and not view["covered"]
    assert read_current(spark, layout.table("capture_gaps")).count() > 600


def test_drop_rate_of_an_update_counts_rows_without_a_symbol_and_needs_no_progress(spark, tmp_path):
    landing, layout = str(tmp_path / "in"), medallion.Layout(str(tmp_path / "tables"))
    land(landing, "a.jsonl", [{"current_price": i, "_ingestion_ts": "2024-01-30T10:00:00Z"} for i in range(50)])
    land(landing, "b.jsonl", capture("2024-01-30T10:00:00Z", *(f"s{i}" for i in range(50))))
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        update = medallion.run(spark, landing, layout, "s", "2024-01-30 10:05:00", max_files=1)
    finally:
        spark.conf.set(name, before)
    assert (update.drop_rate, update.drop_alert, update.audit.rows) == (0.5, True, 100)
    totals = spark.read.parquet(layout.table("metrics")).agg(F.sum("rows"), F.sum("quarantined"), F.sum("repaired")).first()
    assert tuple(totals) == (100, 50, 0)


def test_died_versions_go(spark, tmp_path):
    root = str(tmp_path / "view")
    for _ in range(2):
        refresh(spark.range(1), root)
    os.remove(f"{root}/v=000000000001/_SUCCESS")
    drop_old_versions(spark, root, 5)
    assert os.listdir(root) == ["v=000000000002"]


def test_summary_tells_when_progress_was_cut(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        source = waves(spark, tmp_path, *[[("a", f"2024-01-30 1{h}:00:00")] for h in range(4)])
        assert drain(source, tmp_path, "cut").complete is False
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert drain(source, tmp_path, "whole").complete is True
