"""Validation of ticks and tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions.scalars import event_time
from tickframe.sources.schemas import ALERT_TYPES

#: Prices that a producer accepts, both ends included, and the jump that is suspicious.
LEAST_PRICE, MOST_PRICE, JUMP_PERCENT = "0.0001", "1000000", 50


def reject_reason(symbol: Column, price: Column, timestamp: Column) -> Column:
    """Why a tick is rejected, or null."""
    missing = [F.when(c.isNull() | (c.cast("string") == ""), f"missing_{n}") for n, c in (("symbol", symbol), ("price", price), ("timestamp", timestamp))]
    low, high = (F.lit(x).cast("decimal(20,8)") for x in (LEAST_PRICE, MOST_PRICE))
    return F.coalesce(*missing, F.when(price < low, "price_too_low"), F.when(price > high, "price_too_high"))


def reject_reasons(ticks: DataFrame) -> DataFrame:
    """Number of ticks by reject reason, accepted ones under ``ok``."""
    return ticks.groupBy(F.coalesce(reject_reason(F.col("symbol"), F.col("price_usd"), F.col("ts").cast("string")), F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def lenient_ticks(raw: DataFrame, symbols: DataFrame) -> DataFrame:
    """Ticks of known symbols with a price that can be read; an unreadable volume is 0. ``raw`` has text columns."""
    known = symbols.select("symbol").distinct()
    read = raw.withColumns({"price_usd": F.expr("try_cast(price AS decimal(20,8))"), "volume_24h": F.coalesce(F.expr("try_cast(volume AS decimal(20,2))"), F.lit(0).cast("decimal(20,2)"))})
    return read.where("price_usd IS NOT NULL").join(known, "symbol", "left_semi")


def known_symbols(df: DataFrame, dimension: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Rows of allowed symbols, compared in upper case; no list, or ALL, means every known symbol."""
    allowed = dimension.select(F.upper("symbol").alias("known"))
    if requested and "ALL" not in (names := [r.upper() for r in requested]):
        allowed = allowed.where(F.col("known").isin(names))
    return df.join(allowed, F.upper("symbol") == F.col("known"), "left_semi")


def with_event_time(ticks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ticks with event time ``ts``, and the rejects without a readable one."""
    timed = ticks.withColumn("ts", event_time(F.col("timestamp"), F.col("last_updated")))
    return timed.where("ts IS NOT NULL"), timed.where("ts IS NULL").drop("ts")


def violations(candles: DataFrame, alerts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Broken table constraints, one row each with how often: not-null, foreign key, uniqueness, allowed values."""
    ids = dimension.select("crypto_id")
    count = F.count(F.lit(1)).alias("n")
    checks = [
        ("candle_null", candles.where("crypto_id IS NULL OR window_start IS NULL OR close IS NULL").agg(count)),
        ("candle_orphan", candles.join(ids, "crypto_id", "left_anti").agg(count)),
        ("candle_duplicate", candles.groupBy("crypto_id", "window_start").agg(F.count(F.lit(1)).alias("k")).where("k > 1").agg(count)),
        ("alert_type", alerts.where(~F.col("alert_type").isin(ALERT_TYPES)).agg(count)),
    ]
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check"), "n") for name, df in checks])
