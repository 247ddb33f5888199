"""Streaming pipelines over decoded ticks. Each is a DataFrame; the sinks module starts queries on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickframe.functions.scalars import event_time, ordinal
from tickframe.operators.ohlc import dedupe_key, price_alerts, valid_ticks
from tickframe.operators.stats import counters
from tickframe.sources.ticks import decode_ticks

#: How far event times may be out of order.
WATERMARK = "10 seconds"
VALUES = ["open", "high", "low", "close", "volume_sum", "event_count"]


def tick_stream(raw: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Valid ticks with event time and watermark from a stream of JSON values; unreadable ones go.

    Ticks of equal time are ordered by their offset, as in batch; a source without offsets has a hash of the message.
    """
    ticks = decode_ticks(raw)
    timed = ticks.withColumn("ts", event_time(F.col("timestamp"), F.col("last_updated")))
    keyed = timed.withColumn("tick_id", F.col("kafka_offset") if "kafka_offset" in raw.columns else F.xxhash64("message_id", "timestamp", "price_usd"))
    return valid_ticks(keyed).withWatermark("ts", watermark)


def without_repeats(ticks: DataFrame) -> DataFrame:
    """Each message once, however often it is sent within the watermark."""
    return ticks.dropDuplicatesWithinWatermark(["message_id"])


def candle_stream(ticks: DataFrame, width: str = "1 minute") -> DataFrame:
    """Candles with their ``window``; in append mode each is emitted once, when the watermark passes its end."""
    ordered = ticks.withColumn("order", ordinal(F.unix_micros("ts"), F.col("tick_id")))
    return ordered.groupBy("symbol", F.window("ts", width)).agg(
        F.min_by("price_usd", "order").alias("open"), F.max("price_usd").alias("high"), F.min("price_usd").alias("low"), F.max_by("price_usd", "order").alias("close"),
        F.coalesce(F.sum("volume_24h"), F.lit(0)).cast("decimal(38,2)").alias("volume_sum"), F.count(F.lit(1)).alias("event_count"), F.min("order").alias("first_order"), F.max("order").alias("last_order"),
    )


def rollup_stream(candles: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Wider candles chained on a candle stream, without reading the ticks again."""
    return candles.groupBy("symbol", F.window(F.window_time("window"), width)).agg(
        F.min_by("open", "first_order").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last_order").alias("close"),
        F.sum("volume_sum").cast("decimal(38,2)").alias("volume_sum"), F.sum("event_count").alias("event_count"), F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"),
    )


def flat(candles: DataFrame) -> DataFrame:
    """Window bounds as columns; for the end of a pipeline."""
    return candles.select("symbol", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *VALUES)


def alert_stream(candles: DataFrame, replayed: bool = False) -> DataFrame:
    """Alerts of a candle stream. A candle is emitted once, so an alert is too; ``replayed`` input is deduplicated."""
    once = candles.dropDuplicates(["symbol", "window"]) if replayed else candles
    return price_alerts(flat(once))


def counted_stream(decoded: DataFrame, name: str = "run_counters") -> DataFrame:
    """Decoded messages whose counters each micro-batch observes under ``name``; a RunCounters listener adds them up."""
    return decoded.observe(name, *counters())


class RunCounters(StreamingQueryListener):
    """Totals of produced messages and errors of each streaming query by id, over its micro-batches and restarts.

    Register with ``spark.streams.addListener``. A micro-batch that is run again after a failure counts once.
    """

    def __init__(self, name: str = "run_counters"):
        self.name, self._batches = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is not None:
            self._batches[str(progress.id), progress.batchId] = (row["produced"], row["errors"])

    def totals(self, query_id: str) -> dict[str, int]:
        rows = [v for (q, _), v in self._batches.items() if q == query_id]
        return {"produced": sum(r[0] for r in rows), "errors": sum(r[1] for r in rows)}


def alerts_once(alerts: DataFrame, within: str = "1 hour") -> DataFrame:
    """Decoded alerts of a topic that delivers at least once, each once: repeats of symbol, window and type go, as long as
    they come within that much event time. What was seen lies in the query's checkpoint, so restarts know it."""
    keyed = alerts.withColumns({"dedupe_key": dedupe_key("symbol", "window_start", "alert_type"), "alert_at": F.to_timestamp("window_start")})
    return keyed.withWatermark("alert_at", within).dropDuplicatesWithinWatermark(["dedupe_key"])


def latest_stream(candles: DataFrame) -> DataFrame:
    """The last candle of each symbol from a stream of finished candles, for update or complete mode."""
    return candles.groupBy("symbol").agg(F.max("window_start").alias("newest"), *[F.max_by(c, "window_start").alias(c) for c in VALUES]).withColumnRenamed("newest", "window_start")
