"""

Every query reads the whole given tables; only their time filters cut rows.
Decimals are shown as doubles, so both engines hand over the same type.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Observation, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tidemark import medallion  # noqa: E402
from tidemark.functions import rescued_document, typed_document, with_document, within  # noqa: E402
from tidemark.operators import (  # noqa: E402
    drop_rate,
    keep,
    latest_per_key,
    observed_report,
    value_before,
)
from tidemark.plans import bronze, gold, monitors, reports, silver  # noqa: E402
from tidemark.schemas import CIRCULATING_SUPPLY, PAYLOAD_FIELDS, PayloadField  # noqa: E402
from tidemark.session import fresh_path, settle  # noqa: E402
from tidemark.sources import (  # noqa: E402
    read_current,
    read_landing,
    read_snapshots,
    read_table,
    refresh,
    register,
    stream_landing,
    stream_snapshots,
    write_clustered,
    write_dead_letters,
    write_landing,
)
from tidemark.sources import event_feed as feed  # noqa: E402
from tidemark.sources.landing import capture_time  # noqa: E402
from tidemark.sources.tables import stream_table  # noqa: E402
from tidemark.streaming import bronze_stream, finish, silver_stream  # noqa: E402
from tidemark.streaming.alarms import ALARM, alarm_stream  # noqa: E402
from tidemark.streaming.runs import BRONZE_STORED  # noqa: E402

# The text operators can be taken out with their folders; everything else works without them.
try:
    from tidemark.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("tidemark.llm", "corpus_pipeline")):
        raise
    llm_queries = None

AS_OF = "2024-01-31 00:00:00"
# The feed ends before this: its last day has no capture.
A_DAY_ON = "2024-02-01 00:00:00"
DAY_AGO = "2024-01-30 00:00:00"
WEEK_AGO = "2024-01-24 00:00:00"
HALFWAY = "2024-01-16 00:00:00"
# Cuts both its own day and that of a week ago.
MIDDAY = "2024-01-29 12:00:00"

# The event's number decides between copies, so results repeat exactly.
EVENT_ID = PayloadField("event_id", "event_id", T.LongType())
FIELDS = (*PAYLOAD_FIELDS, EVENT_ID)


def _plain(df: DataFrame) -> DataFrame:
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def _silver(spark: SparkSession, sf: str, **options) -> DataFrame:
    raw = feed.bronze(spark, sf, **options)
    return silver.build_batch(raw, FIELDS, order=["event_id"]).drop("event_id")


def _momentum(spark: SparkSession, sf: str, **options) -> DataFrame:
    return gold.momentum(_silver(spark, sf, since=DAY_AGO), AS_OF, **options)


def _volatility(spark: SparkSession, sf: str) -> DataFrame:
    return gold.volatility(_silver(spark, sf, since=WEEK_AGO), AS_OF)


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _landed(spark: SparkSession, sf: str, **options) -> str:
    path = fresh_path(spark, "landing")
    write_landing(feed.rows(spark, sf, **options), path, "snapshot_id")
    return path


# Raw captures


def bronze_batch(spark, sf):
    raw = bronze.from_landing(read_snapshots(spark, _landed(spark, sf)), "landed")
    event_id = F.get_json_object("payload", "$.event_id").cast("bigint")
    return raw.select("snapshot_id", "source", event_id.alias("event_id"), "payload")


def bronze_batch_24h(spark, sf):
    # The condition chooses the hour folders that the source lists and reads.
    register(spark)
    reader = spark.read.format("snapshot_files").option("source", "landed").option("hourFolders", "true")
    raw = reader.load(_landed(spark, sf)).where(F.col("snapshot_id") >= F.lit(DAY_AGO).cast("timestamp"))
    return raw.select("snapshot_id", "source", "payload")


def bronze_from_manifest(spark, sf):
    # Three captures are committed one after the other; each update reads the commits since the last.
    rows, landing = feed.rows(spark, sf), fresh_path(spark, "landing")
    out, checkpoint = fresh_path(spark, "bronze"), fresh_path(spark, "checkpoint")
    for number in range(3):
        write_landing(rows.where(F.col("event_id") % 3 == number), landing, "snapshot_id", commit=True)
        raw = bronze.from_landing(stream_snapshots(spark, landing, commits="true"), "landed")
        finish(bronze_stream(raw, out, checkpoint))
    return bronze.kept(read_table(spark, out)).select("snapshot_id", "source", "payload")


def bronze_stream_files(spark, sf):
    register(spark)
    out = fresh_path(spark, "bronze")
    raw = spark.readStream.format("snapshot_files").option("source", "landed").load(_landed(spark, sf))
    finish(bronze_stream(raw, out, fresh_path(spark, "checkpoint")))
    return bronze.kept(read_table(spark, out)).select("snapshot_id", "source", "payload")


def bronze_explode(spark, sf):
    # One response holds a page of at most 100 objects of one capture.
    rows = feed.rows(spark, sf)
    page = F.floor(F.col("event_id") / 100).alias("page")
    pages = (
        rows.select("snapshot_id", page, feed.payload(rows).alias("p"))
        .groupBy("snapshot_id", "page")
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("p"), ","), F.lit("]")).alias("response"))
    )
    raw = bronze.explode_responses(pages, "response", "snapshot_id", "responses")
    return _plain(silver.typed(raw, FIELDS, keep=["source"]))


def landing_roundtrip(spark, sf):
    lines = read_landing(spark, _landed(spark, sf, slot_minutes=None))
    return lines.select(
        capture_time().alias("snapshot_id"),
        F.col("dt").cast("string").alias("dt"),
        "hh",
        F.col("value").alias("payload"),
    )


def bronze_expect_drop(spark, sf):
    kept = keep(feed.mixed_bronze(spark, sf), bronze.RULES)
    return kept.select("source", F.length("payload").alias("n_chars"), F.md5("payload").alias("digest"))


def rescued_fields(spark, sf):
    lineage = bronze.with_lineage(read_landing(spark, _landed(spark, sf)))
    return lineage.where("_rescued_data IS NOT NULL").select(
        "_ingestion_ts",
        F.col("_source_file").contains("/dt=").alias("has_source_file"),
        "_rescued_data",
    )


def quarantine(spark, sf):
    path = fresh_path(spark, "quarantine")
    write_dead_letters(bronze.quarantine(feed.mixed_bronze(spark, sf)), path)
    letters = spark.read.schema("snapshot_id timestamp, source string, reason string, payload string").json(path)
    return letters.select(
        "snapshot_id", "source", "reason", F.length("payload").alias("n_chars"), F.md5("payload").alias("digest")
    )


# Typed rows


def silver_typed(spark, sf):
    return _plain(silver.typed(feed.bronze(spark, sf), FIELDS))


def silver_from_variant(spark, sf):
    # Parsed once, stored as VARIANT beside the text; known fields and the rest come from the stored value.
    stored = settle(with_document(feed.bronze(spark, sf)), "documents")
    known = [f.key for f in PAYLOAD_FIELDS]
    rows = rescued_document(stored, known)
    return _plain(typed_document(rows, FIELDS, [F.col("snapshot_id").alias("observed_at"), "_rescued_data"]))


def silver_extra_field(spark, sf):
    raw = feed.bronze(spark, sf)
    supplied = raw.withColumn("payload", F.regexp_replace("payload", r"^\{", '{"circulating_supply":21000000,'))
    fields = (*FIELDS, CIRCULATING_SUPPLY)
    return _plain(silver.typed(supplied, fields).select("event_id", "symbol", "price_usd", "circulating_supply"))


def silver_dedup(spark, sf):
    return _plain(_silver(spark, sf))


def silver_dedup_heavy(spark, sf):
    return _plain(_silver(spark, sf, symbol="event_type"))


def _streamed(spark, sf, **options):
    raw = fresh_path(spark, "bronze")
    finish(
        bronze_stream(
            bronze.from_landing(stream_landing(spark, _landed(spark, sf, **options)), "landed"),
            raw,
            fresh_path(spark, "checkpoint"),
        )
    )
    out = fresh_path(spark, "silver")
    finish(silver_stream(spark, raw, out, fresh_path(spark, "checkpoint"), state_partitions=_cores(spark)))
    return read_table(spark, out, medallion.SILVER_STORED)


def silver_stream_dedup(spark, sf):
    # Which copy survives is free in a stream, so only the key is compared.
    return _streamed(spark, sf, symbol="event_type").select("symbol", "observed_at", "dt")


def late_data(spark, sf):
    # Three runs: two halves in time order, then every error event, most of it long overdue.
    raw = bronze.verdict(feed.bronze(spark, sf))
    late = F.get_json_object("payload", "$.name") == "error"
    first = F.col("snapshot_id") < F.lit(HALFWAY).cast("timestamp")
    path, out = fresh_path(spark, "bronze"), fresh_path(spark, "silver")
    checkpoint = fresh_path(spark, "checkpoint")
    rows_in = late_rows = 0
    for wave in (~late & first, ~late & ~first, late):
        raw.where(wave).write.mode("append").partitionBy("verdict").parquet(path)
        run = finish(silver_stream(spark, path, out, checkpoint, state_partitions=_cores(spark)))
        rows_in, late_rows = rows_in + run.rows_in, late_rows + run.late_rows
    return read_table(spark, out, medallion.SILVER_STORED).agg(
        F.count(F.lit(1)).alias("kept_rows"),
        F.min("observed_at").alias("first_at"),
        F.max("observed_at").alias("last_at"),
        F.lit(rows_in).cast("bigint").alias("rows_in"),
        F.lit(late_rows).cast("bigint").alias("late_rows"),
    )


def silver_expect_metrics(spark, sf):
    metrics = Observation()
    rows = silver.build_batch(feed.mixed_bronze(spark, sf), metrics=metrics)
    rows.write.format("noop").mode("overwrite").save()
    return observed_report(spark, silver.RULES, metrics.get)


def drop_rates(spark, sf):
    raw = feed.mixed_bronze(spark, sf)
    typed = silver.dedup_batch(silver.typed(keep(raw, bronze.RULES)), ["name", "price_usd"])
    both = drop_rate(raw, "bronze", bronze.RULES).unionAll(drop_rate(typed, "silver", silver.RULES))
    return _rounded(both, "drop_rate")


# Views


def recent_24h(spark, sf):
    return _plain(within(_silver(spark, sf, since=DAY_AGO), "observed_at", AS_OF, "24 HOURS"))


def latest(spark, sf):
    return _plain(latest_per_key(_silver(spark, sf), ties=gold.TIES))


def momentum_24h(spark, sf):
    return _plain(_momentum(spark, sf))


def momentum_24h_distributed(spark, sf):
    return _plain(_momentum(spark, sf, slices=5))


def momentum_presented(spark, sf):
    return _plain(reports.presented(_momentum(spark, sf), digits=2))


def daily_range(spark, sf):
    return _rounded(gold.daily_range(_silver(spark, sf, since=WEEK_AGO), AS_OF), "daily_return")


def volatility_7d(spark, sf):
    return _rounded(_volatility(spark, sf), "realized_volatility_7d")


def volatility_close(spark, sf):
    return _rounded(
        gold.volatility_close(_silver(spark, sf, since=WEEK_AGO), AS_OF), "realized_volatility_7d"
    )


def corr_7d(spark, sf):
    rows = _silver(spark, sf, symbol="event_type", since=WEEK_AGO)
    return _rounded(gold.correlation(rows, AS_OF, "CLICK", "VIEW"), "correlation")


def pct_change_hist(spark, sf):
    prices = settle(_silver(spark, sf).select("symbol", "observed_at", "price_usd"), "prices")
    rows = value_before(prices, "price_24h_ago")
    now, then = F.col("price_usd").cast("double"), F.col("price_24h_ago").cast("double")
    change = (now - then) / F.nullif(then, F.lit(0.0)) * 100
    return _rounded(_plain(rows.withColumn("pct_change", change)), "pct_change")


def mv_refresh(spark, sf):
    root = fresh_path(spark, "momentum")
    rows = settle(_silver(spark, sf), "silver")
    for moment in (DAY_AGO, AS_OF):
        refresh(gold.momentum(rows, moment), root)
    return _plain(read_current(spark, root))


def clustered_write(spark, sf):
    path = fresh_path(spark, "silver")
    write_clustered(_silver(spark, sf), path)
    table = read_table(spark, path, medallion.SILVER_STORED)
    return _plain(within(table, "observed_at", AS_OF, "7 DAYS"))


def incremental_equals_full(spark, sf):
    # The second wave takes the last hour of the first wave once more.
    rows = feed.rows(spark, sf)
    at, half = F.col("snapshot_id"), F.lit(HALFWAY).cast("timestamp")
    root, landing = fresh_path(spark, "tables"), fresh_path(spark, "landing")
    waves = (rows.where(at < half), rows.where(at >= half - F.expr("INTERVAL 1 HOUR")))

    def update(name):
        raw = bronze.from_landing(stream_landing(spark, landing), "landed")
        finish(bronze_stream(raw, f"{root}/{name}_raw", f"{root}/_checkpoints/{name}_raw"))
        finish(
            silver_stream(
                spark,
                f"{root}/{name}_raw",
                f"{root}/{name}",
                f"{root}/_checkpoints/{name}",
                state_partitions=_cores(spark),
            )
        )

    for wave in waves:
        write_landing(wave, landing, "snapshot_id")
        update("stepwise")
    update("full")
    tagged = [
        read_table(spark, f"{root}/{name}", medallion.SILVER_STORED).select(
            "symbol", "observed_at", F.lit(name == "full").alias("is_full")
        )
        for name in ("stepwise", "full")
    ]
    per_key = tagged[0].unionAll(tagged[1]).groupBy("symbol", "observed_at").agg(
        F.count_if(~F.col("is_full")).alias("stepwise"), F.count_if("is_full").alias("full")
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.expr("stepwise = 1 AND full = 1")).alias("equal_keys"),
        F.count_if(F.expr("stepwise <> full")).alias("different_keys"),
    )


def backfill_any_order(spark, sf):
    # Captures come in three waves that are not in time order, few files at a time.
    rows = feed.rows(spark, sf)
    wave = F.pmod(F.xxhash64(F.to_date("snapshot_id")), F.lit(3))
    layout, landing = medallion.Layout(fresh_path(spark, "tables")), fresh_path(spark, "landing")
    for number in range(3):
        write_landing(rows.where(wave == number), landing, "snapshot_id")
        medallion.take_in(spark, landing, layout, "landed", max_files=200, state_partitions=_cores(spark))
    return medallion.silver_table(spark, layout).select("symbol", "observed_at")


def _packed_waves(spark, sf):
    # Captures come in three waves that are not in time order; closed days are packed after each.
    rows = feed.rows(spark, sf, slot_minutes=None)
    wave = F.pmod(F.xxhash64(F.to_date("snapshot_id")), F.lit(3))
    layout, landing = medallion.Layout(fresh_path(spark, "tables")), fresh_path(spark, "landing")
    for number in range(3):
        write_landing(rows.where(wave == number), landing, "snapshot_id")
        _, typed, _ = medallion.take_in(spark, landing, layout, "landed", state_partitions=_cores(spark))
        medallion.pack(spark, layout, typed)
        yield layout


def compacted_silver(spark, sf):
    *_, layout = _packed_waves(spark, sf)
    return _plain(medallion.silver_table(spark, layout).drop("dt"))


def volatility_incremental(spark, sf):
    # Refreshed after each wave: from the states of packed days, and rows of the others alone.
    for layout in _packed_waves(spark, sf):
        medallion.refresh_views(spark, layout, MIDDAY)
    return _rounded(medallion.volatility_view(spark, layout), "realized_volatility_7d")


def _with_stamps_ahead(spark, sf, stream):
    # Every tenth event is stamped twenty years on, long after its file.
    rows = feed.rows(spark, sf)
    ahead = F.when(F.col("event_id") % 10 == 0, F.col("snapshot_id") + F.expr("INTERVAL 20 YEARS"))
    landing = fresh_path(spark, "landing")
    write_landing(rows.withColumn("snapshot_id", F.coalesce(ahead, "snapshot_id")), landing, "snapshot_id")
    layout = medallion.Layout(fresh_path(spark, "tables"))
    raw = bronze.from_landing(stream(spark, landing), "landed")
    medallion.take_in(spark, landing, layout, "landed", raw=raw, state_partitions=_cores(spark))
    letters = spark.read.schema("snapshot_id timestamp, source string, reason string, payload string")
    typed = medallion.silver_table(spark, layout)
    bad = letters.json(layout.table("quarantine"))
    return typed.select("symbol", "observed_at", F.lit(None).cast("string").alias("reason")).unionAll(
        bad.select(F.upper(F.get_json_object("payload", "$.symbol")), "snapshot_id", "reason")
    )


def implausible_stamps(spark, sf):
    return _with_stamps_ahead(spark, sf, stream_landing)


def implausible_stamps_by_name(spark, sf):
    return _with_stamps_ahead(spark, sf, stream_snapshots)


def medallion_update(spark, sf):
    layout = medallion.Layout(fresh_path(spark, "medallion"))
    landing = _landed(spark, sf, slot_minutes=None)
    medallion.run(spark, landing, layout, "landed", AS_OF, state_partitions=_cores(spark))
    return _plain(medallion.momentum_view(spark, layout))


# Reports and monitors


def top_momentum(spark, sf):
    return reports.top_momentum(_momentum(spark, sf))


def change_distribution(spark, sf):
    return reports.change_distribution(_momentum(spark, sf))


def top_market_cap(spark, sf):
    return _plain(reports.top_market_cap(_momentum(spark, sf)))


def top_gainers(spark, sf):
    return reports.top_gainers(_momentum(spark, sf))


def most_volatile(spark, sf):
    return _rounded(reports.most_volatile(_volatility(spark, sf)), "realized_volatility_7d")


def price_lookup(spark, sf):
    return _plain(reports.price_lookup(_momentum(spark, sf), "u7"))


def gainers_losers(spark, sf):
    return reports.movers(_momentum(spark, sf))


def layer_stats(spark, sf):
    rows = settle(_silver(spark, sf), "silver")
    return monitors.layer_stats(
        {
            "bronze": (feed.bronze(spark, sf), "snapshot_id"),
            "silver": (rows, "observed_at"),
            "momentum": (gold.latest(rows, AS_OF), "observed_at"),
            "volatility": (gold.volatility(rows, AS_OF), "last_observed_at"),
        }
    )


def freshness_coverage(spark, sf):
    return monitors.freshness_coverage(_momentum(spark, sf), AS_OF)


def capture_gaps(spark, sf):
    return monitors.capture_gaps(feed.bronze(spark, sf, slot_minutes=15), A_DAY_ON, days=30)


def gap_alarms(spark, sf):
    # The stream's rows come in three waves in time order; slots are closed as the watermark passes them.
    raw = bronze.verdict(feed.bronze(spark, sf, slot_minutes=15))
    path, out, checkpoint = (fresh_path(spark, n) for n in ("bronze", "alarms", "checkpoint"))
    at = F.col("snapshot_id")
    third, half = (F.lit(t).cast("timestamp") for t in ("2024-01-11 00:00:00", HALFWAY))
    for wave in (at < third, (at >= third) & (at < half), at >= half):
        raw.where(wave).write.mode("append").partitionBy("verdict").parquet(path)
        rows = bronze.kept(stream_table(spark, path, BRONZE_STORED)).select("source", "snapshot_id")
        alarm_stream(rows, out, checkpoint, state_partitions=_cores(spark)).awaitTermination()
    return spark.read.schema(ALARM).parquet(out).select("source", "slot")


def capture_growth(spark, sf):
    return monitors.capture_growth(feed.bronze(spark, sf, slot_minutes=15), A_DAY_ON, days=30)


_QUERIES = {
    "bronze_batch": bronze_batch,
    "bronze_batch_24h": bronze_batch_24h,
    "bronze_from_manifest": bronze_from_manifest,
    "bronze_stream": bronze_stream_files,
    "bronze_explode": bronze_explode,
    "landing_roundtrip": landing_roundtrip,
    "bronze_expect_drop": bronze_expect_drop,
    "rescued_fields": rescued_fields,
    "quarantine": quarantine,
    "silver_typed": silver_typed,
    "silver_extra_field": silver_extra_field,
    "silver_from_variant": silver_from_variant,
    "silver_dedup": silver_dedup,
    "silver_dedup_heavy": silver_dedup_heavy,
    "silver_stream": silver_stream_dedup,
    "late_data": late_data,
    "silver_expect_metrics": silver_expect_metrics,
    "drop_rate": drop_rates,
    "recent_24h": recent_24h,
    "latest_per_key": latest,
    "momentum_24h": momentum_24h,
    "momentum_24h_distributed": momentum_24h_distributed,
    "momentum_presented": momentum_presented,
    "daily_range": daily_range,
    "volatility_7d": volatility_7d,
    "volatility_incremental": volatility_incremental,
    "volatility_close": volatility_close,
    "corr_7d": corr_7d,
    "pct_change_hist": pct_change_hist,
    "mv_refresh": mv_refresh,
    "clustered_write": clustered_write,
    "incremental_equals_full": incremental_equals_full,
    "backfill_any_order": backfill_any_order,
    "compacted_silver": compacted_silver,
    "implausible_stamps": implausible_stamps,
    "implausible_stamps_by_name": implausible_stamps_by_name,
    "medallion_update": medallion_update,
    "top_momentum": top_momentum,
    "change_distribution": change_distribution,
    "top_market_cap": top_market_cap,
    "top_gainers": top_gainers,
    "most_volatile": most_volatile,
    "price_lookup": price_lookup,
    "gainers_losers": gainers_losers,
    "layer_stats": layer_stats,
    "freshness_coverage": freshness_coverage,
    "capture_gaps": capture_gaps,
    "gap_alarms": gap_alarms,
    "capture_growth": capture_growth,
}


def entry(spark: SparkSession) -> DataFrame:
    return momentum_24h(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **(llm_queries.QUERIES | llm_queries.FURTHER if llm_queries else {})}


# SQL twins


def _feed_sql(symbol: str = "user", at: str = "date_trunc('hour', ts)") -> str:
    name = {
        "user": "'u' || user_id",
        "event_type": "event_type",
        "partial": "CASE WHEN event_type <> 'error' THEN 'u' || user_id END",
    }[symbol]
    return f"""
      SELECT {at} AS snapshot_id, {name} AS symbol, event_type AS name, event_id,
             CAST(value AS DECIMAL(18,2)) AS current_price,
             CAST(round(value * 1000) AS BIGINT) AS total_volume,
             CAST(round(value * 1000000) AS BIGINT) AS market_cap,
             CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS k
      FROM events"""


_TYPED = """
      SELECT upper(symbol) AS symbol, name, CAST(current_price AS DOUBLE) AS price_usd,
             CAST(total_volume AS DOUBLE) AS volume_24h_usd, CAST(market_cap AS DOUBLE) AS market_cap_usd,
             CAST(CAST(k / 100.0 AS DECIMAL(5,2)) AS DOUBLE) AS pct_change_1h,
             CAST(CAST(k / 10.0 AS DECIMAL(5,1)) AS DOUBLE) AS pct_change_24h,
             CAST(CAST(k / 5.0 AS DECIMAL(6,1)) AS DOUBLE) AS pct_change_7d,
             snapshot_id AS observed_at, event_id
      FROM feed"""

_PAYLOAD = """'{' || CASE WHEN symbol IS NULL THEN '' ELSE '"symbol":"' || symbol || '",' END
             || '"name":"' || name || '","current_price":' || current_price
             || ',"total_volume":' || total_volume || ',"market_cap":' || market_cap
             || ',"price_change_percentage_1h_in_currency":' || CAST(k / 100.0 AS DECIMAL(5,2))
             || ',"price_change_percentage_24h":' || CAST(k / 10.0 AS DECIMAL(5,1))
             || ',"price_change_percentage_7d_in_currency":' || CAST(k / 5.0 AS DECIMAL(6,1))
             || ',"event_id":' || event_id"""

_STAMP = """',"_ingestion_ts":"' || strftime(snapshot_id, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}'"""


def _with_silver(body: str, symbol: str = "user", at: str = "date_trunc('hour', ts)") -> str:
    return f"""
    WITH feed AS ({_feed_sql(symbol, at)}), typed AS ({_TYPED}),
    silver AS (
      SELECT * EXCLUDE (event_id, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol, observed_at ORDER BY event_id) AS rn FROM typed
      ) WHERE rn = 1 AND symbol IS NOT NULL
    ),
    latest AS (
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY observed_at DESC) AS rn FROM silver
        WHERE observed_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND TIMESTAMP '{AS_OF}'
      ) WHERE rn = 1
    ),
    momentum AS (
      SELECT symbol, name, price_usd, pct_change_24h, volume_24h_usd, market_cap_usd,
             CAST(rank() OVER (ORDER BY pct_change_24h DESC NULLS LAST) AS INTEGER) AS momentum_rank, observed_at
      FROM latest
    ),
    daily AS (
      SELECT symbol, CAST(observed_at AS DATE) AS day,
             (max(price_usd) - min(price_usd)) / nullif(min(price_usd), 0) AS daily_return
      FROM silver
      WHERE observed_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND TIMESTAMP '{AS_OF}'
      GROUP BY ALL
    ),
    volatility AS (
      SELECT symbol, round(stddev_samp(daily_return) * sqrt(365), 6) AS realized_volatility_7d,
             count(*) AS n_observations, max(day) AS last_observed_at
      FROM daily GROUP BY symbol HAVING count(*) >= 3
    )
    {body}"""


_MIXED = f"""
    WITH feed AS ({_feed_sql("partial")}),
    mixed AS (
      SELECT snapshot_id, {_PAYLOAD} || '}}' AS payload, 'events' AS source FROM feed
      UNION ALL
      SELECT TIMESTAMP '2024-01-30 00:00:00', text, 'documents' FROM documents
    ),
    -- No symbol comes out of prose, so its rows of one capture count as copies.
    unique_rows AS (
      SELECT DISTINCT upper(symbol) AS symbol, snapshot_id FROM feed WHERE symbol IS NOT NULL
      UNION ALL
      SELECT DISTINCT NULL, snapshot_id FROM (
        SELECT snapshot_id FROM feed WHERE symbol IS NULL
        UNION ALL SELECT snapshot_id FROM mixed WHERE source = 'documents' AND length(payload) > 10)
    )"""

# As _MIXED, with the surviving row's price and size: the first by the typed columns.
_MIXED_SURVIVORS = f"""
    WITH feed AS ({_feed_sql("partial")}), typed AS ({_TYPED}),
    all_rows AS (
      SELECT * EXCLUDE (event_id) FROM typed
      UNION ALL BY NAME
      SELECT TIMESTAMP '2024-01-30 00:00:00' AS observed_at FROM documents
    ),
    survivors AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol, observed_at ORDER BY
            name NULLS FIRST, price_usd NULLS FIRST, volume_24h_usd NULLS FIRST, market_cap_usd NULLS FIRST,
            pct_change_1h NULLS FIRST, pct_change_24h NULLS FIRST, pct_change_7d NULLS FIRST) AS rn
        FROM all_rows) WHERE rn = 1
    )"""


def oracle_sql() -> dict[str, str]:
    hourly = "date_trunc('hour', ts)"
    quarter = "time_bucket(INTERVAL 15 MINUTE, ts)"
    feed_only = lambda body, symbol="user", at=hourly: f"WITH feed AS ({_feed_sql(symbol, at)}) {body}"
    whole_payload = f"{_PAYLOAD} || {_STAMP}"
    expected_slots = f"""
        SELECT unnest(generate_series(TIMESTAMP '{A_DAY_ON}' - INTERVAL 30 DAY,
                                      TIMESTAMP '{A_DAY_ON}' - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS slot"""
    movers = """
        SELECT count(*) FILTER (pct_change_24h > 0) AS gainers, count(*) FILTER (pct_change_24h < 0) AS losers,
               count(*) FILTER (pct_change_24h = 0) AS unchanged,
               count(*) FILTER (pct_change_24h IS NULL) AS unknown FROM momentum"""
    landed = f"SELECT snapshot_id, 'landed' AS source, {whole_payload} AS payload FROM feed"
    stamped_ahead = """
        SELECT DISTINCT upper(symbol) AS symbol, snapshot_id AS observed_at, CAST(NULL AS VARCHAR) AS reason
        FROM feed WHERE event_id % 10 <> 0
        UNION ALL SELECT upper(symbol), snapshot_id + INTERVAL 20 YEAR, 'capture_time_implausible'
        FROM feed WHERE event_id % 10 = 0"""
    return {
        **(llm_queries.SQL if llm_queries else {}),
        "bronze_batch": feed_only(
            f"SELECT snapshot_id, 'landed' AS source, event_id, {whole_payload} AS payload FROM feed"
        ),
        "bronze_batch_24h": feed_only(f"{landed} WHERE snapshot_id >= TIMESTAMP '{DAY_AGO}'"),
        "bronze_from_manifest": feed_only(landed),
        "bronze_stream": feed_only(landed),
        "bronze_explode": f"""
            WITH feed AS ({_feed_sql()}), typed AS ({_TYPED})
            SELECT *, 'responses' AS source FROM typed""",
        "landing_roundtrip": feed_only(
            f"""SELECT snapshot_id, strftime(snapshot_id, '%Y-%m-%d') AS dt,
                       strftime(snapshot_id, '%H') AS hh, {whole_payload} AS payload FROM feed""",
            at="ts",
        ),
        "bronze_expect_drop": f"""{_MIXED}
            SELECT source, length(payload) AS n_chars, md5(payload) AS digest
            FROM mixed WHERE length(payload) > 10""",
        "rescued_fields": feed_only(
            """SELECT snapshot_id AS _ingestion_ts, TRUE AS has_source_file,
                      '{"event_id":"' || event_id || '"}' AS _rescued_data FROM feed"""
        ),
        "quarantine": f"""{_MIXED}
            SELECT snapshot_id, source,
                   CASE WHEN payload IS NULL OR length(payload) <= 10 THEN 'non_empty_payload'
                        WHEN NOT json_valid(payload) THEN 'unparseable'
                        ELSE 'symbol_not_null' END AS reason,
                   length(payload) AS n_chars, md5(payload) AS digest
            FROM mixed
            WHERE payload IS NULL OR length(payload) <= 10 OR NOT json_valid(payload)
               OR json_extract_string(payload, '$.symbol') IS NULL""",
        "silver_typed": f"WITH feed AS ({_feed_sql()}), typed AS ({_TYPED}) SELECT * FROM typed",
        "silver_from_variant": f"""
            WITH feed AS ({_feed_sql()}), typed AS ({_TYPED})
            SELECT *, '{{"event_id":"' || event_id || '"}}' AS _rescued_data FROM typed""",
        "silver_extra_field": f"""
            WITH feed AS ({_feed_sql()}), typed AS ({_TYPED})
            SELECT event_id, symbol, price_usd, CAST(21000000 AS DOUBLE) AS circulating_supply FROM typed""",
        "silver_dedup": _with_silver("SELECT * FROM silver"),
        "silver_dedup_heavy": _with_silver("SELECT * FROM silver", "event_type"),
        "backfill_any_order": _with_silver("SELECT symbol, observed_at FROM silver"),
        "compacted_silver": _with_silver("SELECT * FROM silver", at="ts"),
        "implausible_stamps": feed_only(stamped_ahead),
        "implausible_stamps_by_name": feed_only(stamped_ahead),
        "silver_stream": _with_silver(
            "SELECT symbol, observed_at, CAST(observed_at AS DATE) AS dt FROM silver", "event_type"
        ),
        # The third run starts with the watermark that the first two have left.
        "late_data": f"""
            WITH feed AS ({_feed_sql()}),
            waves AS (SELECT *, CASE WHEN name = 'error' THEN 3
                                     WHEN snapshot_id < TIMESTAMP '{HALFWAY}' THEN 1 ELSE 2 END AS wave FROM feed),
            mark AS (SELECT max(snapshot_id) - INTERVAL 1 HOUR AS late_until FROM waves WHERE wave < 3),
            judged AS (SELECT waves.*, wave = 3 AND snapshot_id <= late_until AS late FROM waves, mark),
            kept AS (SELECT DISTINCT symbol, snapshot_id FROM judged WHERE NOT late)
            SELECT (SELECT count(*) FROM kept) AS kept_rows, (SELECT min(snapshot_id) FROM kept) AS first_at,
                   (SELECT max(snapshot_id) FROM kept) AS last_at, count(*) AS rows_in,
                   count(*) FILTER (late) AS late_rows FROM judged""",
        "silver_expect_metrics": f"""{_MIXED_SURVIVORS},
            n AS (SELECT count(*) AS checked,
                         count(*) FILTER (NOT coalesce(price_usd > 0, FALSE)) AS p,
                         count(*) FILTER (symbol IS NULL) AS s,
                         count(*) FILTER (NOT coalesce(market_cap_usd >= 0, FALSE)) AS m FROM survivors)
            SELECT 'price_positive' AS expectation, 'warn' AS action, checked, p AS failed FROM n
            UNION ALL SELECT 'symbol_not_null', 'drop', checked, s FROM n
            UNION ALL SELECT 'valid_market_cap', 'warn', checked, m FROM n""",
        "drop_rate": f"""{_MIXED},
            n AS (SELECT 'bronze' AS table_name, count(*) AS rows_in,
                         count(*) FILTER (NOT coalesce(length(payload) > 10, FALSE)) AS rows_dropped FROM mixed
                  UNION ALL
                  SELECT 'silver', count(*), count(*) FILTER (symbol IS NULL) FROM unique_rows)
            SELECT *, round(rows_dropped / rows_in, 6) AS drop_rate, rows_dropped / rows_in > 0.05 AS alert FROM n""",
        "recent_24h": _with_silver(
            f"SELECT * FROM silver WHERE observed_at BETWEEN TIMESTAMP '{DAY_AGO}' AND TIMESTAMP '{AS_OF}'"
        ),
        "latest_per_key": _with_silver(
            """SELECT * EXCLUDE (rn) FROM (
                 SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY observed_at DESC) AS rn FROM silver
               ) WHERE rn = 1"""
        ),
        "momentum_24h": _with_silver("SELECT * FROM momentum"),
        "momentum_24h_distributed": _with_silver("SELECT * FROM momentum"),
        "momentum_presented": _with_silver(
            "SELECT * REPLACE (round(pct_change_24h, 2) AS pct_change_24h) FROM momentum"
        ),
        "daily_range": _with_silver("SELECT symbol, day, round(daily_return, 6) AS daily_return FROM daily"),
        "volatility_7d": _with_silver("SELECT * FROM volatility"),
        "volatility_incremental": _with_silver("SELECT * FROM volatility", at="ts").replace(AS_OF, MIDDAY),
        "volatility_close": _with_silver(
            f"""SELECT symbol, round(stddev_samp(r) * sqrt(365), 6) AS realized_volatility_7d,
                       count(*) AS n_observations, max(day) AS last_observed_at
                FROM (SELECT symbol, day, price / nullif(lag(price) OVER (PARTITION BY symbol ORDER BY day), 0) - 1 AS r
                      FROM (SELECT symbol, CAST(observed_at AS DATE) AS day, arg_max(price_usd, observed_at) AS price
                            FROM silver WHERE observed_at BETWEEN TIMESTAMP '{WEEK_AGO}' AND TIMESTAMP '{AS_OF}'
                            GROUP BY ALL))
                WHERE r IS NOT NULL GROUP BY symbol HAVING count(*) >= 3"""
        ),
        "corr_7d": _with_silver(
            f"""SELECT 'CLICK' AS first_symbol, 'VIEW' AS second_symbol, count(*) AS n_slots,
                       round(corr(a.price_usd, b.price_usd), 6) AS correlation
                FROM silver a JOIN silver b USING (observed_at)
                WHERE a.symbol = 'CLICK' AND b.symbol = 'VIEW'
                  AND observed_at BETWEEN TIMESTAMP '{WEEK_AGO}' AND TIMESTAMP '{AS_OF}'""",
            "event_type",
        ),
        "pct_change_hist": _with_silver(
            """SELECT symbol, observed_at, price_usd, price_24h_ago,
                      round((price_usd - price_24h_ago) / nullif(price_24h_ago, 0) * 100, 6) AS pct_change
               FROM (SELECT *, last_value(price_usd) OVER (PARTITION BY symbol ORDER BY observed_at
                       RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 24 HOUR PRECEDING) AS price_24h_ago
                     FROM silver)"""
        ),
        "mv_refresh": _with_silver("SELECT * FROM momentum"),
        "clustered_write": _with_silver(
            f"""SELECT *, CAST(observed_at AS DATE) AS dt FROM silver
                WHERE observed_at BETWEEN TIMESTAMP '{WEEK_AGO}' AND TIMESTAMP '{AS_OF}'"""
        ),
        "incremental_equals_full": _with_silver(
            "SELECT count(*) AS keys, count(*) AS equal_keys, CAST(0 AS BIGINT) AS different_keys FROM silver"
        ),
        "medallion_update": _with_silver("SELECT * FROM momentum", at="ts"),
        "top_momentum": _with_silver(
            "SELECT symbol, name, pct_change_24h, momentum_rank FROM momentum WHERE momentum_rank <= 10"
        ),
        "change_distribution": _with_silver(
            "SELECT symbol, pct_change_24h FROM momentum WHERE momentum_rank <= 20"
        ),
        "top_market_cap": _with_silver(
            "SELECT symbol, name, market_cap_usd FROM momentum ORDER BY market_cap_usd DESC, symbol LIMIT 20"
        ),
        "top_gainers": _with_silver(
            "SELECT symbol, name, pct_change_24h FROM momentum ORDER BY pct_change_24h DESC, symbol LIMIT 5"
        ),
        "most_volatile": _with_silver(
            """SELECT symbol, realized_volatility_7d, n_observations FROM volatility
               ORDER BY realized_volatility_7d DESC NULLS LAST, symbol LIMIT 10"""
        ),
        "price_lookup": _with_silver(
            "SELECT symbol, price_usd, pct_change_24h, observed_at FROM momentum WHERE upper(symbol) = upper('u7')"
        ),
        "gainers_losers": _with_silver(movers),
        "layer_stats": _with_silver(
            """SELECT 'bronze' AS layer, count(*) AS row_count, min(snapshot_id) AS first_at, max(snapshot_id) AS last_at FROM feed
               UNION ALL SELECT 'silver', count(*), min(observed_at), max(observed_at) FROM silver
               UNION ALL SELECT 'momentum', count(*), min(observed_at), max(observed_at) FROM momentum
               UNION ALL SELECT 'volatility', count(*), CAST(min(last_observed_at) AS TIMESTAMP),
                                CAST(max(last_observed_at) AS TIMESTAMP) FROM volatility"""
        ),
        "freshness_coverage": _with_silver(
            f"""SELECT max(observed_at) AS last_observed_at, count(DISTINCT symbol) AS symbols,
                       CAST(epoch(TIMESTAMP '{AS_OF}') - epoch(max(observed_at)) AS DOUBLE) AS age_seconds,
                       epoch(TIMESTAMP '{AS_OF}') - epoch(max(observed_at)) <= 900 AS fresh,
                       count(DISTINCT symbol) >= 100 AS covered FROM silver
                WHERE observed_at BETWEEN TIMESTAMP '{DAY_AGO}' AND TIMESTAMP '{AS_OF}'"""
        ),
        "capture_gaps": feed_only(
            f""", captured AS (SELECT DISTINCT snapshot_id AS slot FROM feed), expected AS ({expected_slots})
               SELECT slot FROM expected ANTI JOIN captured USING (slot)""",
            at=quarter,
        ),
        # Slots whose end the watermark has passed: an hour behind the newest capture.
        "gap_alarms": feed_only(
            """, captured AS (SELECT DISTINCT snapshot_id AS slot FROM feed),
               span AS (SELECT min(slot) AS first, max(slot) AS newest FROM captured),
               expected AS (SELECT unnest(generate_series(first, newest, INTERVAL 15 MINUTE)) AS slot FROM span)
               SELECT 'events' AS source, e.slot FROM expected e ANTI JOIN captured c ON e.slot = c.slot, span
               WHERE e.slot + INTERVAL 15 MINUTE <= newest - INTERVAL 1 HOUR""",
            at=quarter,
        ),
        "capture_growth": feed_only(
            f""", captured AS (SELECT snapshot_id AS slot, count(*) AS n FROM feed GROUP BY slot), expected AS ({expected_slots})
               SELECT CAST(e.slot AS DATE) AS day, count(n) AS captures, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count,
                      count(*) - count(n) AS missing FROM expected e LEFT JOIN captured c ON e.slot = c.slot GROUP BY day""",
            at=quarter,
        ),
    }
