"""Candles: aggregation, rollup, records, and what is derived from one candle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions.scalars import (
    alert_type,
    anomaly_percent,
    direction,
    iso_text,
    percent_change,
    severity,
    tick_order,
    trend_class,
    two_digits,
    typical_price,
)
from tickframe.operators.windows import with_previous

#: An alert needs more than so many percent.
ALERT_PERCENT = 5


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with a symbol, a positive price and a time."""
    return ticks.where("symbol <> '' AND price_usd > 0 AND ts IS NOT NULL")


def ohlc(ticks: DataFrame, width: str) -> DataFrame:
    """Candles of ``width`` per symbol from valid ticks (symbol, price_usd, volume_24h, ts, tick_id).

    Open and close go by event time, then tick_id. One hash aggregation with partial sums on each side of one shuffle by
    symbol and window. ``first_order`` and ``last_order`` let candles be rolled up.
    """
    ordered = valid_ticks(ticks).withColumn("order", tick_order("ts", "tick_id"))
    candles = ordered.groupBy("symbol", F.window("ts", width).alias("w")).agg(
        F.min_by("price_usd", "order").alias("open"), F.max("price_usd").alias("high"), F.min("price_usd").alias("low"), F.max_by("price_usd", "order").alias("close"),
        F.coalesce(F.sum("volume_24h"), F.lit(0)).cast("decimal(38,2)").alias("volume_sum"), F.count(F.lit(1)).alias("event_count"), F.min("order").alias("first_order"), F.max("order").alias("last_order"),
    )
    return candles.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "open", "high", "low", "close", "volume_sum", "event_count", "first_order", "last_order")


def rollup(candles: DataFrame, width: str) -> DataFrame:
    """Wider candles from candles: the merge of partial results."""
    wide = candles.groupBy("symbol", F.window("window_start", width).alias("w")).agg(
        F.min_by("open", "first_order").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last_order").alias("close"),
        F.sum("volume_sum").cast("decimal(38,2)").alias("volume_sum"), F.sum("event_count").alias("event_count"), F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"),
    )
    return wide.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "open", "high", "low", "close", "volume_sum", "event_count", "first_order", "last_order")


def candle_records(candles: DataFrame, dimension: DataFrame) -> DataFrame:
    """Candles as table records: crypto_id (-1 for an unknown symbol, which is dropped), typical price, trade count."""
    ids = dimension.select("symbol", "crypto_id")
    records = candles.join(ids, "symbol", "left").withColumn("crypto_id", F.coalesce("crypto_id", F.lit(-1)))
    records = records.withColumn("avg_price", typical_price(*(F.col(c) for c in ("open", "high", "low", "close"))))
    valid = F.col("crypto_id") > 0
    for name in ("window_start", "window_end", "open", "high", "low", "close"):
        valid &= F.col(name).isNotNull()
    return records.where(valid).select("crypto_id", "window_start", "window_end", "open", "high", "low", "close", "avg_price", "volume_sum", F.col("event_count").alias("trade_count"))


def price_alerts(candles: DataFrame) -> DataFrame:
    """An alert for every candle that moves more than ALERT_PERCENT from open to close."""
    moving = candles.where("open IS NOT NULL AND close IS NOT NULL AND open <> 0").withColumn("price_change_pct", anomaly_percent(F.col("open"), F.col("close")))
    pct = F.col("price_change_pct")
    return moving.where(F.abs(pct) > ALERT_PERCENT).select("symbol", alert_type(pct).alias("alert_type"), "price_change_pct", F.col("open").alias("old_price"), F.col("close").alias("new_price"), "window_start", "window_end", severity(pct).alias("severity"))


def candle_change(candles: DataFrame) -> DataFrame:
    """Change from the previous candle's close, direction and trend."""
    changed = with_previous(candles.select("symbol", "window_start", "open", "close"), "close", ["window_start"], "previous_close")
    changed = changed.withColumn("change_pct", F.round(percent_change(F.col("close"), F.col("previous_close")), 6))
    return changed.select("symbol", "window_start", "close", "previous_close", "change_pct", direction(F.col("open"), F.col("close")).alias("direction"), trend_class(F.col("change_pct")).alias("trend"))


def candle_lines(candles: DataFrame) -> DataFrame:
    """One readable line per candle."""
    numbers = [two_digits(F.col(c)) for c in ("open", "high", "low", "close", "volume_sum")]
    text = F.format_string("[%s] %s OHLC | Open: %s | High: %s | Low: %s | Close: %s | Volume: %s | Events: %d", iso_text("window_start"), "symbol", *numbers, "event_count")
    return candles.select("symbol", "window_start", text.alias("line"))


def record_lines(records: DataFrame) -> DataFrame:
    """One readable line per candle record."""
    numbers = [two_digits(F.col(c)) for c in ("open", "high", "low", "close", "avg_price", "volume_sum")]
    text = F.format_string("DB Record[crypto_id=%d, window=%s, OHLC=(%s/%s/%s/%s), avg=%s, vol=%s, trades=%d]", "crypto_id", iso_text("window_start"), *numbers, "trade_count")
    return records.select("crypto_id", "window_start", text.alias("line"))


def alert_lines(alerts: DataFrame) -> DataFrame:
    """One readable line per alert; what is missing is UNKNOWN, or 0."""
    known = [F.coalesce(F.col(c), F.lit("UNKNOWN")) for c in ("severity", "symbol", "alert_type")]
    numbers = [two_digits(F.col(c)) for c in ("price_change_pct", "old_price", "new_price")]
    text = F.format_string("🚨 ALERT [%s] %s | Type: %s | Change: %s%% | Open: %s → Close: %s | Window: %s", *known, *numbers, F.coalesce(iso_text("window_start"), F.lit("UNKNOWN")))
    return alerts.select("symbol", "window_start", text.alias("line"))


def candle_json(candles: DataFrame) -> DataFrame:
    """Candles as JSON messages: camel case, epoch seconds, keyed by symbol."""
    epoch = lambda c: F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({c} as timestamp_ntz))")
    body = F.struct("symbol", epoch("window_start").alias("windowStart"), epoch("window_end").alias("windowEnd"), "open", "high", "low", "close", F.col("volume_sum").alias("volumeSum"), F.col("event_count").alias("eventCount"))
    return candles.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))


def alert_json(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON messages: snake case, keyed by symbol; an alert's own time is the end of its window."""
    prices = [F.col("price_change_pct").alias("price_change_percent"), F.col("old_price").alias("open_price"), F.col("new_price").alias("close_price")]
    times = [iso_text("window_start").alias("window_start"), iso_text("window_end").alias("window_end"), iso_text("window_end").alias("timestamp")]
    return alerts.select(F.col("symbol").alias("key"), F.to_json(F.struct("symbol", "alert_type", *prices, *times, "severity")).alias("value"))


def dedupe_key(symbol: str, window_start: str, alert_type: str) -> Column:
    """What makes an alert the same one when it is sent again."""
    return F.concat_ws("|", symbol, window_start, alert_type)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON messages with their dedupe key, also as a message header for topics."""
    sent = alert_json(alerts).withColumn("alert", F.from_json("value", "symbol string, window_start string, alert_type string"))
    told = dedupe_key("alert.symbol", "alert.window_start", "alert.alert_type")
    return sent.select("key", "value", told.alias("dedupe_key"), F.array(F.struct(F.lit("dedupe_key").alias("key"), told.cast("binary").alias("value"))).alias("headers"))


def alerts_once(alerts: DataFrame) -> DataFrame:
    """Decoded alerts with their dedupe key, each once. For a stream see ``jobs.alerts_once``, whose memory is bounded."""
    return alerts.withColumn("dedupe_key", dedupe_key("symbol", "window_start", "alert_type")).dropDuplicates(["dedupe_key"])
