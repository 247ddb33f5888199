"""Queries over ticks and candles."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.scalars import period_width, relative_age
from tickframe.operators import market, ohlc, quality, stats, tables, windows
from tickframe.plans.base import ALERTS, DIMENSION, EPOCH, LAST, LINE_TICKS, RECORDS, TICKS, TYPICAL, VALID, candles, pct, query, sql
from tickframe.sources.ticks import (
    decode_alerts,
    decode_ticks,
    event_ticks,
    lineitem_ticks,
    message_id,
    symbol_dimension,
    symbol_list,
    table,
)

COLUMNS = ["symbol", "window_start", "window_end", "open", "high", "low", "close", "volume_sum", "event_count"]
C = ", ".join(COLUMNS)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.ohlc(event_ticks(spark, sf_dir), "1 hour")


def alerts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.price_alerts(hourly(spark, sf_dir))


def _candle_query(name: str, width: str) -> None:
    @query(name, sql(TICKS, VALID, candles(width), select=f"SELECT {C} FROM c"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ohlc.ohlc(event_ticks(spark, sf_dir), width).select(*COLUMNS)


for _name, _width in (("ohlc_1m", "1 minute"), ("ohlc_5m", "5 minutes"), ("ohlc_15m", "15 minutes"), ("ohlc_1h", "1 hour")):
    _candle_query(_name, _width)


@query("ohlc_supplier_1d", sql(LINE_TICKS, candles("1 day"), select=f"SELECT {C} FROM c"))
def ohlc_supplier_1d(spark, sf_dir):
    return ohlc.ohlc(lineitem_ticks(spark, sf_dir), "1 day").select(*COLUMNS)


@query("ohlc_rollup", sql(TICKS, VALID, candles("15 minutes"), select=f"SELECT {C} FROM c"))
def ohlc_rollup(spark, sf_dir):
    return ohlc.rollup(ohlc.ohlc(event_ticks(spark, sf_dir), "1 minute"), "15 minutes").select(*COLUMNS)


@query("ohlc_period", sql(TICKS, VALID, "w AS (SELECT * FROM v WHERE ts > (SELECT max(ts) FROM v) - INTERVAL '7 days')", candles("4 hours", source="w"), select=f"SELECT {C} FROM c"))
def ohlc_period(spark, sf_dir, days: int = 7):
    ticks = event_ticks(spark, sf_dir)
    since = market.as_of(ohlc.valid_ticks(ticks)) - timedelta(days=days)
    return ohlc.ohlc(ticks.where(F.col("ts") > market.timestamp(since)), period_width(days)).select(*COLUMNS)


@query("window_avg", sql(TICKS, VALID, select=f"SELECT symbol, time_bucket(INTERVAL '1 hour', ts, {EPOCH}) AS window_start, round(avg(CAST(price AS DOUBLE)), 6) AS avg_price FROM v GROUP BY ALL"))
def window_avg(spark, sf_dir):
    return stats.window_avg(ohlc.valid_ticks(event_ticks(spark, sf_dir)), "1 hour")


@query("valid_ticks", sql(TICKS, VALID, select="SELECT symbol, price AS price_usd, vol AS volume_24h, ts, id AS tick_id FROM v"))
def valid_ticks(spark, sf_dir):
    return ohlc.valid_ticks(event_ticks(spark, sf_dir)).select("symbol", "price_usd", "volume_24h", "ts", "tick_id")


@query("tick_reject_reasons", sql(TICKS, "s AS (SELECT symbol, ts, CAST(CASE WHEN price < 1 THEN price / 100000 ELSE price * 100000 END AS DECIMAL(20,8)) AS price FROM t)", select="SELECT CASE WHEN coalesce(symbol, '') = '' THEN 'missing_symbol' WHEN price IS NULL THEN 'missing_price' WHEN ts IS NULL THEN 'missing_timestamp' WHEN price < 0.0001 THEN 'price_too_low' WHEN price > 1000000 THEN 'price_too_high' ELSE 'ok' END AS reason, count(*) AS n FROM s GROUP BY 1"))
def tick_reject_reasons(spark, sf_dir):
    # Prices are spread to both sides of the accepted range.
    price = F.col("price_usd")
    spread = F.when(price < 1, price / 100_000).otherwise(price * 100_000).cast("decimal(20,8)")
    return quality.reject_reasons(event_ticks(spark, sf_dir).withColumn("price_usd", spread))


@query("tick_lenient", sql(TICKS, DIMENSION, select="SELECT symbol, id AS tick_id, price AS price_usd, CASE WHEN id % 3 = 0 THEN CAST(0 AS DECIMAL(20,2)) ELSE vol END AS volume_24h FROM t WHERE id % 7 <> 0 AND symbol IN (SELECT symbol FROM d)"))
def tick_lenient(spark, sf_dir):
    # Text fields of which some cannot be read.
    ticks = event_ticks(spark, sf_dir)
    raw = ticks.select("symbol", "tick_id", F.when(F.col("tick_id") % 7 == 0, "n/a").otherwise(F.col("price_usd").cast("string")).alias("price"), F.when(F.col("tick_id") % 3 == 0, "?").otherwise(F.col("volume_24h").cast("string")).alias("volume"))
    return quality.lenient_ticks(raw, symbol_dimension(spark, sf_dir)).select("symbol", "tick_id", "price_usd", "volume_24h")


def _tick_json(spark, sf_dir) -> DataFrame:
    ticks = event_ticks(spark, sf_dir)
    body = F.to_json(F.struct("symbol", "price_usd", "volume_24h", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), F.lit(1).alias("unknown_field")))
    return ticks.select("tick_id", F.when(F.col("tick_id") % 10 == 0, F.lit("{bad")).otherwise(body).alias("value"))


@query("tick_decode", sql(TICKS, select="SELECT id AS tick_id, CASE WHEN id % 10 <> 0 THEN symbol END AS symbol, CASE WHEN id % 10 <> 0 THEN price END AS price_usd, CASE WHEN id % 10 <> 0 THEN vol END AS volume_24h FROM t"))
def tick_decode(spark, sf_dir):
    return decode_ticks(_tick_json(spark, sf_dir)).select("tick_id", "symbol", "price_usd", "volume_24h")


@query("tick_event_time", sql(TICKS, select="SELECT id AS tick_id, CASE WHEN id % 5 = 0 THEN CASE WHEN id % 2 = 0 THEN epoch(date_trunc('second', ts)) END ELSE epoch(date_trunc('second', ts)) END::BIGINT AS seconds FROM t"))
def tick_event_time(spark, sf_dir):
    # A fifth of the times is unreadable; half of those fall back to the feed's epoch seconds.
    ticks = event_ticks(spark, sf_dir)
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    raw = ticks.select("tick_id", F.when(F.col("tick_id") % 5 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"), F.when(F.col("tick_id") % 2 == 0, epoch).alias("last_updated"))
    good, bad = quality.with_event_time(raw)
    return good.select("tick_id", F.unix_seconds("ts").alias("seconds")).unionByName(bad.select("tick_id", F.lit(None).cast("long").alias("seconds")))


@query("known_symbols", sql(TICKS, DIMENSION, select="SELECT symbol, count(*) AS n FROM t WHERE upper(symbol) IN ('CLICK', 'VIEW', 'ZZZ') AND upper(symbol) IN (SELECT upper(symbol) FROM d) GROUP BY 1"))
def known_symbols(spark, sf_dir):
    return quality.known_symbols(event_ticks(spark, sf_dir), symbol_dimension(spark, sf_dir), ["click", "View", "zzz"]).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("symbol_list", sql(DIMENSION, select="SELECT crypto_id, symbol, coalesce(name, symbol) AS name, coalesce(slug, lower(symbol)) AS slug, is_active FROM d"))
def symbols(spark, sf_dir):
    return symbol_list(symbol_dimension(spark, sf_dir))


@query("candle_records", sql(TICKS, VALID, candles("1 hour"), DIMENSION, RECORDS, select="SELECT * FROM r"))
def candle_records(spark, sf_dir):
    return ohlc.candle_records(hourly(spark, sf_dir), symbol_dimension(spark, sf_dir))


_HISTORY = "h AS (SELECT r.*, symbol FROM r JOIN d USING (crypto_id) WHERE window_start BETWEEN (SELECT max(window_start) FROM r) - INTERVAL '1 day' AND (SELECT max(window_start) FROM r))"


@query("candle_history", sql(TICKS, VALID, candles("1 hour"), DIMENSION, RECORDS, _HISTORY, select="SELECT *, (SELECT count(*) FROM h) AS total, least(30, greatest((SELECT count(*) FROM h) - 10, 0)) AS returned, (SELECT count(*) FROM h) > 40 AS has_more FROM h ORDER BY window_start DESC, symbol LIMIT 30 OFFSET 10"))
def candle_history(spark, sf_dir):
    dimension = symbol_dimension(spark, sf_dir)
    return market.candle_history(ohlc.candle_records(hourly(spark, sf_dir), dimension), dimension, limit=30, offset=10)


@query("price_alerts", sql(TICKS, VALID, candles("1 hour"), ALERTS, select="SELECT * FROM a"))
def price_alerts(spark, sf_dir):
    return alerts_of(spark, sf_dir)


@query("recent_alerts", sql(TICKS, VALID, candles("1 hour"), ALERTS, DIMENSION, select="SELECT a.*, crypto_id FROM a JOIN d USING (symbol) WHERE window_start >= (SELECT max(window_start) FROM a) - INTERVAL '24 hours' ORDER BY window_start DESC, symbol LIMIT 20"))
def recent_alerts(spark, sf_dir):
    return market.recent_alerts(alerts_of(spark, sf_dir), symbol_dimension(spark, sf_dir))


@query("alert_summary", sql(TICKS, VALID, candles("1 hour"), ALERTS, select="SELECT symbol, count(*) AS alerts, count(*) FILTER (alert_type = 'PRICE_SPIKE') AS spikes, count(*) FILTER (alert_type = 'PRICE_DROP') AS drops FROM a GROUP BY 1"))
def alert_summary(spark, sf_dir):
    return stats.alert_summary(alerts_of(spark, sf_dir), ["symbol"])


@query("dq_violations", sql(TICKS, VALID, candles("1 hour"), ALERTS, DIMENSION, select="SELECT 'candle_null' AS \"check\", count(*) FILTER (close IS NULL) AS n FROM c UNION ALL SELECT 'candle_orphan', count(*) FILTER (event_count = 1) FROM c JOIN d USING (symbol) UNION ALL SELECT 'candle_duplicate', count(*) FILTER (k > 1) FROM (SELECT CASE WHEN event_count = 1 THEN -1 ELSE crypto_id END AS cid, window_start, sum(CASE WHEN event_count = 2 THEN 2 ELSE 1 END) AS k FROM c JOIN d USING (symbol) GROUP BY 1, 2) UNION ALL SELECT 'alert_type', count(*) FILTER (severity = 'LOW') FROM a"))
def dq_violations(spark, sf_dir):
    # One-tick candles get an unknown id, two-tick ones are doubled, low alerts get an unknown type.
    dimension = symbol_dimension(spark, sf_dir)
    records = ohlc.candle_records(hourly(spark, sf_dir), dimension)
    broken = records.withColumn("crypto_id", F.when(F.col("trade_count") == 1, -1).otherwise(F.col("crypto_id")))
    doubled = broken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("trade_count") == 2, 2).otherwise(1)))).drop("copy")
    odd = alerts_of(spark, sf_dir).withColumn("alert_type", F.when(F.col("severity") == "LOW", "PRICE_BLIP").otherwise(F.col("alert_type")))
    return quality.violations(doubled, odd, dimension)


@query("candle_change", sql(TICKS, VALID, candles("1 hour"), f"x AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY window_start) AS previous_close FROM c), y AS (SELECT *, CASE WHEN previous_close IS NOT NULL THEN round({pct('close', 'previous_close')}, 6) END AS change_pct FROM x)", select="SELECT symbol, window_start, close, previous_close, change_pct, CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction, CASE WHEN change_pct > 2 THEN 'strong_up' WHEN change_pct > 0 THEN 'up' WHEN change_pct < -2 THEN 'strong_down' WHEN change_pct < 0 THEN 'down' ELSE 'flat' END AS trend FROM y"))
def candle_change(spark, sf_dir):
    return ohlc.candle_change(hourly(spark, sf_dir))


def two(column: str) -> str:
    return f"CAST(CAST(round({column}, 2) AS DECIMAL(36,2)) AS VARCHAR)"


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%SZ')"


@query("candle_lines", sql(TICKS, VALID, candles("1 hour"), select=f"""
SELECT symbol, window_start, '[' || {iso("window_start")} || '] ' || symbol || ' OHLC | Open: ' || {two("open")} || ' | High: ' || {two("high")} || ' | Low: ' || {two("low")} || ' | Close: ' || {two("close")}
       || ' | Volume: ' || {two("volume_sum")} || ' | Events: ' || event_count AS line FROM c"""))
def candle_lines(spark, sf_dir):
    return ohlc.candle_lines(hourly(spark, sf_dir))


@query("record_lines", sql(TICKS, VALID, candles("1 hour"), DIMENSION, RECORDS, select=f"""
SELECT crypto_id, window_start, 'DB Record[crypto_id=' || crypto_id || ', window=' || {iso("window_start")} || ', OHLC=(' || {two("open")} || '/' || {two("high")} || '/' || {two("low")} || '/' || {two("close")}
       || '), avg=' || {two("avg_price")} || ', vol=' || {two("volume_sum")} || ', trades=' || trade_count || ']' AS line FROM r"""))
def record_lines(spark, sf_dir):
    return ohlc.record_lines(ohlc.candle_records(hourly(spark, sf_dir), symbol_dimension(spark, sf_dir)))


@query("alert_lines", sql(TICKS, VALID, candles("1 hour"), ALERTS, select=f"""
SELECT symbol, window_start, '🚨 ALERT [' || severity || '] ' || symbol || ' | Type: ' || alert_type || ' | Change: ' || {two("price_change_pct")} || '% | Open: ' || {two("old_price")} || ' → Close: ' || {two("new_price")}
       || ' | Window: ' || {iso("window_start")} AS line FROM a"""))
def alert_lines(spark, sf_dir):
    return ohlc.alert_lines(alerts_of(spark, sf_dir))


_ALERT_JSON = f"""'{{"symbol":"' || symbol || '","alert_type":"' || alert_type || '","price_change_percent":' || price_change_pct || ',"open_price":' || old_price || ',"close_price":' || new_price
       || ',"window_start":"' || {iso("window_start")} || '","window_end":"' || {iso("window_end")} || '","timestamp":"' || {iso("window_end")} || '","severity":"' || severity || '"}}'"""


@query("alert_json", sql(TICKS, VALID, candles("1 hour"), ALERTS, select=f"SELECT symbol AS key, {_ALERT_JSON} AS value FROM a"))
def alert_json(spark, sf_dir):
    return ohlc.alert_json(alerts_of(spark, sf_dir))


@query("alert_decode", sql(TICKS, VALID, candles("1 hour"), ALERTS, select=f"""
SELECT symbol, alert_type, CAST(price_change_pct AS DECIMAL(10,4)) AS price_change_percent, old_price AS open_price, new_price AS close_price, {iso("window_start")} AS window_start, {iso("window_end")} AS window_end,
       {iso("window_end")} AS "timestamp", severity FROM a WHERE severity <> 'HIGH'"""))
def alert_decode(spark, sf_dir):
    # High alerts arrive broken, or without their symbol.
    messages = ohlc.alert_json(alerts_of(spark, sf_dir))
    high = F.col("value").contains('"severity":"HIGH"')
    broken = F.when(high & (F.length("value") % 2 == 0), F.lit("{oops")).when(high, F.replace("value", F.lit('"symbol"'), F.lit('"name"'))).otherwise(F.col("value"))
    return decode_alerts(messages.select(broken.alias("value")))


@query("candle_json", sql(TICKS, VALID, candles("1 hour"), select="SELECT symbol AS key, '{\"symbol\":\"' || symbol || '\",\"windowStart\":' || CAST(epoch(window_start) AS BIGINT) || ',\"windowEnd\":' || CAST(epoch(window_end) AS BIGINT) || ',\"open\":' || open || ',\"high\":' || high || ',\"low\":' || low || ',\"close\":' || close || ',\"volumeSum\":' || volume_sum || ',\"eventCount\":' || event_count || '}' AS value FROM c"))
def candle_json(spark, sf_dir):
    return ohlc.candle_json(hourly(spark, sf_dir))


def _stats_sql(keys: str) -> str:
    k, g = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return sql(
        TICKS, VALID, candles("1 hour"), f"s AS (SELECT {k}min(low) AS lo, max(high) AS hi, avg(CAST({TYPICAL} AS DOUBLE)) AS mean, CAST(sum(volume_sum) AS DECIMAL(38,2)) AS total_volume, count(*) AS candles FROM c {g})",
        select=f"SELECT {k}lo AS min_low, hi AS max_high, round(mean, 6) AS avg_price, total_volume, candles, CAST(hi - lo AS DECIMAL(20,8)) AS price_range, round(CASE WHEN lo > 0 THEN CAST(hi - lo AS DOUBLE) / CAST(lo AS DOUBLE) * 100 ELSE 0 END, 6) AS price_change_pct, round(CASE WHEN mean > 0 THEN CAST(hi - lo AS DOUBLE) / mean * 100 ELSE 0 END, 6) AS volatility_pct FROM s",
    )


@query("range_stats", _stats_sql("symbol"))
def range_stats(spark, sf_dir):
    return stats.range_stats(hourly(spark, sf_dir), ["symbol"])


@query("range_stats_all", _stats_sql(""))
def range_stats_all(spark, sf_dir):
    return stats.range_stats(hourly(spark, sf_dir))


@query("price_stats_24h", sql(TICKS, DIMENSION, select="SELECT crypto_id, symbol, count(*) AS n, min(price) AS min_price, max(price) AS max_price, round(avg(CAST(price AS DOUBLE)), 6) AS avg_price, round(quantile_cont(CAST(price AS DOUBLE), 0.5), 6) AS median_price, round(stddev_samp(CAST(price AS DOUBLE)), 6) AS stddev_price FROM t JOIN d USING (symbol) WHERE is_active AND ts >= (SELECT max(ts) FROM t) - INTERVAL '24 hours' GROUP BY 1, 2"))
def price_stats_24h(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    return stats.price_stats(ticks, symbol_dimension(spark, sf_dir), market.timestamp(market.as_of(ticks) - timedelta(hours=24)))


@query("table_counts", "SELECT 'events' AS table_name, count(*) AS n FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'customer', count(*) FROM customer")
def table_counts(spark, sf_dir):
    return stats.table_counts({n: table(spark, sf_dir, n) for n in ("events", "lineitem", "part", "customer")})


@query("ingest_progress", "SELECT 'crypto-prices' AS topic_name, CAST(event_id % 4 AS INTEGER) AS partition_id, max(event_id) AS last_offset, max(ts) AS last_timestamp, 'candles' AS consumer_group FROM events GROUP BY 2")
def ingest_progress(spark, sf_dir):
    return stats.ingest_progress(event_ticks(spark, sf_dir), "crypto-prices", "candles")


@query("moving_avg_5", sql(TICKS, VALID, candles("1 hour"), select="SELECT symbol, window_start, round(avg(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS ma_5 FROM c"))
def moving_avg_5(spark, sf_dir):
    return windows.moving_average(hourly(spark, sf_dir), "close", 5, ["window_start"], "ma_5").select("symbol", "window_start", "ma_5")


@query("moving_avg_10", sql(TICKS, VALID, select="SELECT symbol, id AS tick_id, round(avg(CAST(price AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY ts, id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS ma_10 FROM v"))
def moving_avg_10(spark, sf_dir):
    return windows.moving_average(ohlc.valid_ticks(event_ticks(spark, sf_dir)), "price_usd", 10, ["ts", "tick_id"], "ma_10").select("symbol", "tick_id", "ma_10")


def _sma(n: int) -> str:
    return f"CASE WHEN row_number() OVER w >= {n} THEN round(avg(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) END AS sma_{n}"


@query("candle_sma", sql(TICKS, VALID, candles("1 hour"), select=f"SELECT symbol, window_start, close, {_sma(20)}, {_sma(50)} FROM c WINDOW w AS (PARTITION BY symbol ORDER BY window_start)"))
def candle_sma(spark, sf_dir):
    return windows.candle_sma(hourly(spark, sf_dir))


_TREND = f"p AS (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ts, id) AS previous FROM v), q AS (SELECT *, CASE WHEN previous IS NOT NULL THEN round({pct('price', 'previous')}, 6) END AS change_pct FROM p)"


@query("trend_detect", sql(TICKS, VALID, _TREND, select="SELECT symbol, id AS tick_id, ts, price AS price_usd, previous, change_pct, CASE WHEN change_pct > 5 THEN 'up' WHEN change_pct < -5 THEN 'down' ELSE 'flat' END AS trend FROM q"))
def trend_detect(spark, sf_dir):
    return windows.trend_detect(ohlc.valid_ticks(event_ticks(spark, sf_dir)))


@query("tick_jumps", sql(TICKS, VALID, _TREND, select="SELECT symbol, id AS tick_id, ts, price AS price_usd, previous, change_pct FROM q WHERE abs(change_pct) > 50"))
def tick_jumps(spark, sf_dir):
    return windows.tick_jumps(ohlc.valid_ticks(event_ticks(spark, sf_dir)))


_SPANS = {"1h": "1 hour", "24h": "24 hours", "7d": "7 days", "30d": "30 days"}


def _over(k: str) -> str:
    return f"(PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL '{_SPANS[k]}' PRECEDING AND CURRENT ROW)"


@query("multi_change", sql(TICKS, VALID, "m AS (SELECT *, " + ", ".join(f"first_value(price) OVER {_over(k)} AS b_{k}" for k in _SPANS) + f", max(price) OVER {_over('24h')} AS high_24h, min(price) OVER {_over('24h')} AS low_24h FROM v)", select="SELECT symbol, id AS tick_id, ts, price AS price_usd, " + ", ".join(f"round({pct('price', f'b_{k}')}, 6) AS change_{k}" for k in _SPANS) + ", CAST(price - b_24h AS DECIMAL(20,8)) AS change_abs_24h, high_24h, low_24h FROM m"))
def multi_change(spark, sf_dir):
    return windows.multi_change(ohlc.valid_ticks(event_ticks(spark, sf_dir)))


@query("latest_candle", sql(TICKS, VALID, candles("1 hour"), LAST, select=f"SELECT {C} FROM l"))
def latest_candle(spark, sf_dir):
    return windows.latest_by(hourly(spark, sf_dir).select(*COLUMNS), "symbol", ["window_start"])


@query("latest_tick", sql(TICKS, DIMENSION, select="SELECT symbol, crypto_id, price AS price_usd, ts, id AS tick_id FROM t JOIN d USING (symbol) WHERE is_active QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, id DESC) = 1"))
def latest_tick(spark, sf_dir):
    return market.latest_ticks(event_ticks(spark, sf_dir), symbol_dimension(spark, sf_dir)).select("symbol", "crypto_id", "price_usd", "ts", "tick_id")


@query("latest_prices", sql(TICKS, VALID, candles("1 hour"), LAST, select=f"SELECT symbol, close AS price, round({pct('close', 'open')}, 6) AS change_pct, volume_sum AS volume, window_end, greatest(date_diff('second', window_end, (SELECT max(window_end) FROM c) + INTERVAL '90 seconds'), 0) AS age_seconds FROM l"))
def latest_prices(spark, sf_dir):
    candles_ = hourly(spark, sf_dir)
    return market.latest_prices(candles_, market.as_of(candles_, "window_end") + timedelta(seconds=90))


@query("relative_age", sql(TICKS, VALID, "g AS (SELECT id, date_diff('second', date_trunc('second', ts), date_trunc('second', (SELECT max(ts) FROM v))) AS s FROM v)", select="SELECT id AS tick_id, CASE WHEN s < 60 THEN 'just now' WHEN s < 3600 THEN (s // 60) || ' min' WHEN s < 86400 THEN (s // 3600) || CASE WHEN s // 3600 = 1 THEN ' hour' ELSE ' hours' END WHEN s < 604800 THEN (s // 86400) || CASE WHEN s // 86400 = 1 THEN ' day' ELSE ' days' END WHEN s < 2419200 THEN (s // 604800) || CASE WHEN s // 604800 = 1 THEN ' week' ELSE ' weeks' END END AS age FROM g"))
def relative_ages(spark, sf_dir):
    ticks = ohlc.valid_ticks(event_ticks(spark, sf_dir))
    end = market.as_of(ticks).replace(microsecond=0)
    seconds = F.expr("timestampdiff(SECOND, date_trunc('second', ts), end)")
    return ticks.withColumn("end", market.timestamp(end)).select("tick_id", relative_age(seconds).alias("age"))


@query("recent_ticks", sql(TICKS, select="SELECT symbol, id AS tick_id, price AS price_usd, ts FROM t WHERE symbol = 'click' ORDER BY ts DESC, id DESC LIMIT 10"))
def recent_ticks(spark, sf_dir):
    return event_ticks(spark, sf_dir).where("symbol = 'click'").orderBy(F.desc("ts"), F.desc("tick_id")).limit(10).select("symbol", "tick_id", "price_usd", "ts")


@query("chart_series", sql(TICKS, VALID, candles("1 minute"), select="SELECT symbol, window_start AS time, CAST(open AS DOUBLE) AS o, CAST(high AS DOUBLE) AS h, CAST(low AS DOUBLE) AS l, CAST(close AS DOUBLE) AS c, CAST(volume_sum AS DOUBLE) AS v FROM c WHERE window_start > (SELECT max(window_start) FROM c) - INTERVAL '1440 minutes'"))
def chart_series(spark, sf_dir):
    candles_ = ohlc.ohlc(event_ticks(spark, sf_dir), "1 minute")
    return market.last_minutes(candles_, 1440, market.as_of(candles_, "window_start"))


@query("retention_keep", "SELECT event_id AS tick_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL '7 days'")
def retention_keep(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    return tables.retention_keep(ticks, "ts", tables.TICK_DAYS, market.as_of(ticks)).select("tick_id", "ts")


@query("seed_symbols", sql(DIMENSION, select="SELECT crypto_id, symbol, name, slug, is_active FROM d WHERE symbol NOT IN (SELECT event_type FROM events WHERE event_type IS NOT NULL)"))
def seed_symbols(spark, sf_dir):
    existing = event_ticks(spark, sf_dir).select("symbol").distinct()
    return tables.seed_symbols(existing, symbol_dimension(spark, sf_dir))


@query("combined_export", sql(TICKS, VALID, candles("1 hour"), select="SELECT symbol, window_start, open, high, low, close, volume_sum FROM c WHERE symbol IN ('click', 'view')"))
def combined_export(spark, sf_dir):
    return tables.combined_export(hourly(spark, sf_dir), ["click", "view"])


@query("live_tail_merge", sql(TICKS, VALID, candles("1 hour"), select="SELECT symbol, window_start, CASE WHEN window_start >= m THEN close + 1 ELSE close END AS close, window_start >= m AS is_live FROM c, (SELECT max(window_start) - INTERVAL '3 hours' AS m FROM c) WHERE event_count > 0"))
def live_tail_merge(spark, sf_dir):
    # The last hours arrive live with other closes; history overlaps them for a while.
    candles_ = hourly(spark, sf_dir).select("symbol", "window_start", "close")
    start = market.as_of(candles_, "window_start") - timedelta(hours=3)
    live = candles_.where(F.col("window_start") >= market.timestamp(start)).withColumn("close", (F.col("close") + 1).cast("decimal(20,8)"))
    history = candles_.where(F.col("window_start") < market.timestamp(start + timedelta(hours=2)))
    return market.live_tail_merge(history, live)


@query("compare_symbols", sql(TICKS, VALID, candles("1 hour"), select="SELECT window_start, max(close) FILTER (symbol = 'click') AS click, max(close) FILTER (symbol = 'view') AS \"view\" FROM c WHERE symbol IN ('click', 'view') GROUP BY 1"))
def compare_symbols(spark, sf_dir):
    return market.compare_symbols(hourly(spark, sf_dir), ["click", "view"])


@query("snapshot_ids", sql(TICKS, select="SELECT id AS tick_id, symbol || '-' || CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS message_id FROM t"))
def snapshot_ids(spark, sf_dir):
    return event_ticks(spark, sf_dir).select("tick_id", message_id(F.col("symbol"), "ts").alias("message_id"))


@query("run_counters", sql(TICKS, VALID, DIMENSION, "s AS (SELECT symbol IN (SELECT symbol FROM v) AS hit FROM d)", select="""
SELECT count(*) FILTER (id % 10 <> 0 AND symbol <> '' AND price > 0) AS produced, count(*) FILTER (NOT (id % 10 <> 0 AND coalesce(symbol <> '' AND price > 0, false))) AS errors,
       (SELECT count(*) FROM s WHERE hit) AS hits, (SELECT count(*) FROM s WHERE NOT hit) AS misses, (SELECT round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) * 100, 1) FROM s) AS hit_rate_pct FROM t"""))
def run_counters(spark, sf_dir):
    latest = windows.latest_by(ohlc.valid_ticks(event_ticks(spark, sf_dir)).select("symbol", "ts", "tick_id"), "symbol", ["ts", "tick_id"])
    return stats.run_counters(decode_ticks(_tick_json(spark, sf_dir)), stats.symbol_coverage(symbol_dimension(spark, sf_dir), latest))
