"""Queries over ticks with many keys, deep pages, texts beside latest rows, repeated messages and observed counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators import market, ohlc, stats, windows
from tickframe.plans.base import ALERTS, LINE_TICKS, TICKS, VALID, candles, pct, query, sql
from tickframe.plans.candles import COLUMNS, C, _tick_json, alerts_of
from tickframe.sources.ticks import decode_alerts, decode_ticks, event_ticks, lineitem_ticks, table


@query("median_supplier", sql(LINE_TICKS, select="SELECT symbol, round(quantile_cont(CAST(price AS DOUBLE), 0.5), 6) AS median_price FROM v GROUP BY symbol"))
def median_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.exact_median(lineitem_ticks(spark, sf_dir), ["symbol"], "price_usd").select("symbol", F.round("median", 6).alias("median_price"))


@query("median_tick", sql(TICKS, VALID, select="SELECT symbol, round(quantile_cont(CAST(price AS DOUBLE), 0.5), 6) AS median_price FROM v GROUP BY symbol"))
def median_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.exact_median(ohlc.valid_ticks(event_ticks(spark, sf_dir)), ["symbol"], "price_usd").select("symbol", F.round("median", 6).alias("median_price"))


@query("latest_shipment", "SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts, l_orderkey * 100 + l_linenumber AS tick_id, l_returnflag AS flag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey * 100 + l_linenumber DESC) = 1")
def latest_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(F.col("l_suppkey").cast("string").alias("symbol"), F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("tick_id"), F.col("l_returnflag").alias("flag"))
    return windows.latest_by(rows, "symbol", ["ts", "tick_id"])


_PREVIOUS = f"p AS (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ts, id) AS previous FROM v), q AS (SELECT *, CASE WHEN previous IS NOT NULL THEN round({pct('price', 'previous')}, 6) END AS change_pct FROM p)"


@query("trend_supplier", sql(LINE_TICKS, _PREVIOUS, select="SELECT symbol, id AS tick_id, ts, price AS price_usd, previous, change_pct, CASE WHEN change_pct > 5 THEN 'up' WHEN change_pct < -5 THEN 'down' ELSE 'flat' END AS trend FROM q"))
def trend_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trend_detect(lineitem_ticks(spark, sf_dir))


_PAGE = "SELECT *, (SELECT count(*) FROM c) AS total, greatest(least(500, (SELECT count(*) FROM c) - 2000), 0) AS returned, (SELECT count(*) FROM c) > 2500 AS has_more FROM c ORDER BY window_start DESC, symbol LIMIT 500 OFFSET 2000"


@query("candle_page_deep", sql(LINE_TICKS, candles("1 day"), select=_PAGE.replace("*, (", f"{C}, (", 1)))
def candle_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ohlc.ohlc(lineitem_ticks(spark, sf_dir), "1 day").select(*COLUMNS)
    return market.page(days, [F.desc("window_start"), F.asc("symbol")], 500, 2000)


@query("alert_dedupe", sql(TICKS, VALID, candles("1 hour"), ALERTS, select="SELECT symbol, alert_type, severity, symbol || '|' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '|' || alert_type AS dedupe_key FROM a"))
def alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every message arrives twice, as after a restart of its sender.
    sent = ohlc.alert_messages(alerts_of(spark, sf_dir))
    twice = decode_alerts(sent.unionByName(sent).select("value"))
    return ohlc.alerts_once(twice).select("symbol", "alert_type", "severity", "dedupe_key")


@query("observed_counters", sql(TICKS, select="SELECT count(*) FILTER (id % 10 <> 0 AND symbol <> '' AND price > 0) AS produced, count(*) FILTER (NOT (id % 10 <> 0 AND coalesce(symbol <> '' AND price > 0, false))) AS errors FROM t"))
def observed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The counters are taken while the messages are decoded and written; here nothing keeps what is written.
    decoded, watch = stats.observed(decode_ticks(_tick_json(spark, sf_dir)))
    decoded.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(watch.get["produced"], watch.get["errors"])], "produced long, errors long")
