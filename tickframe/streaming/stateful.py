"""Keyed state with time to live, for what built-in stream operators do not keep. Needs the RocksDB state store."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_EVEN, Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickframe.functions.scalars import epoch_micros

STATE_MS = 3_600_000
ALERTS = "symbol string, price_change_pct decimal(20,4), window_start timestamp"
AVERAGES = "symbol string, ts timestamp, price double, average double"


class AlertProcessor(StatefulProcessor):
    """Alerts once per symbol and window, remembering each symbol's last alerted window for an hour."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_window", "window_start timestamp", STATE_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame.sort_values("window_start").itertuples():
                if row.open is None or row.close is None or not row.open:
                    continue
                percent = ((Decimal(row.close) - Decimal(row.open)) / Decimal(row.open)).quantize(Decimal("0.0001"), ROUND_HALF_EVEN) * 100
                if abs(percent) > 5 and (not self.last.exists() or self.last.get()[0] != row.window_start):
                    self.last.update((row.window_start,))
                    yield pd.DataFrame({"symbol": [key[0]], "price_change_pct": [percent.quantize(Decimal("0.0001"))], "window_start": [row.window_start]})

    def close(self) -> None:
        pass


class MovingAverage(StatefulProcessor):
    """Mean of each symbol's last ten prices, in order of arrival."""

    ROWS = 10

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prices = handle.getListState("prices", "price double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [p[0] for p in self.prices.get()] if self.prices.exists() else []
        for frame in rows:
            ordered = frame.sort_values("ts")
            means = []
            for price in ordered["price"]:
                kept = [*kept, float(price)][-self.ROWS :]
                means.append(sum(kept) / len(kept))
            yield pd.DataFrame({"symbol": key[0], "ts": ordered["ts"], "price": ordered["price"], "average": means})
        self.prices.put([(p,) for p in kept])

    def close(self) -> None:
        pass


#: Fixed value: milliseconds after its end that a window closes by the clock.
CLOSE_AFTER_MS = 5_000
CANDLE_STATE = "open decimal(20,8), high decimal(20,8), low decimal(20,8), close decimal(20,8), volume_sum decimal(38,2), event_count long, first_at long, first_id long, last_at long, last_id long, timer long"
CLOCK_CANDLES = "symbol string, window_start timestamp, window_end timestamp, open decimal(20,8), high decimal(20,8), low decimal(20,8), close decimal(20,8), volume_sum decimal(38,2), event_count long"


class ClockCandles(StatefulProcessor):
    """One window of one symbol: its candle so far, and a processing-time timer that closes it.

    The timer goes off ``CLOSE_AFTER_MS`` after the window's end, or after its last tick came where that is later, as when
    old ticks are read again. No later tick is needed. A closed window is remembered for an hour: ticks that come for it
    then are late, and dropped.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.candle = handle.getValueState("candle", CANDLE_STATE)
        self.closed = handle.getValueState("closed", "at long", STATE_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [frame for frame in rows if len(frame)]
        if not frames or self.closed.exists():
            return
        frame = pd.concat(frames).sort_values(["at", "tick_id"], kind="stable")
        first, last = frame.iloc[0], frame.iloc[-1]
        volumes = [Decimal(v) for v in frame["volume_24h"] if not pd.isna(v)]
        new = [first["price_usd"], frame["price_usd"].max(), frame["price_usd"].min(), last["price_usd"], sum(volumes, Decimal(0)), len(frame), int(first["at"]), int(first["tick_id"]), int(last["at"]), int(last["tick_id"])]
        if self.candle.exists():
            open_, high, low, close, volume, count, first_at, first_id, last_at, last_id, timer = self.candle.get()
            self.handle.deleteTimer(timer)
            new[1], new[2], new[4], new[5] = max(new[1], high), min(new[2], low), new[4] + volume, new[5] + count
            if (first_at, first_id) <= (new[6], new[7]):
                new[0], new[6], new[7] = open_, first_at, first_id
            if (last_at, last_id) > (new[8], new[9]):
                new[3], new[8], new[9] = close, last_at, last_id
        timer = max(int(key[2]) // 1000, timerValues.getCurrentProcessingTimeInMs()) + CLOSE_AFTER_MS
        self.handle.registerTimer(timer)
        self.candle.update((*new, timer))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.candle.exists():
            values = self.candle.get()
            self.candle.clear()
            self.closed.update((timerValues.getCurrentProcessingTimeInMs(),))
            yield pd.DataFrame([(key[0], pd.Timestamp(int(key[1]), unit="us"), pd.Timestamp(int(key[2]), unit="us"), *values[:6])], columns=["symbol", "window_start", "window_end", "open", "high", "low", "close", "volume_sum", "event_count"])

    def close(self) -> None:
        pass


def clock_candles(ticks: DataFrame, width: str = "1 minute") -> DataFrame:
    """Candles of a stream of valid ticks that close by the clock, in update mode and without a watermark.

    Each is emitted once. A candle stream by watermark waits for a later tick; this one serves symbols that fall silent.
    """
    windowed = ticks.select("symbol", F.window("ts", width).alias("w"), "ts", "tick_id", "price_usd", "volume_24h")
    keyed = windowed.select("symbol", epoch_micros("w.start").alias("start"), epoch_micros("w.end").alias("end"), epoch_micros("ts").alias("at"), F.col("tick_id").cast("long").alias("tick_id"), "price_usd", "volume_24h")
    return keyed.groupBy("symbol", "start", "end").transformWithStateInPandas(ClockCandles(), outputStructType=CLOCK_CANDLES, outputMode="Update", timeMode="ProcessingTime")


def open_candles(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Candles that a stopped query of ``clock_candles`` left open, read from its state as any table is."""
    state = spark.read.format("statestore").option("stateVarName", "candle").load(checkpoint)
    time = lambda c: F.timestamp_micros(F.col(f"key.{c}"))
    return state.select("key.symbol", time("start").alias("window_start"), time("end").alias("window_end"), *[f"value.{c}" for c in ("open", "high", "low", "close", "volume_sum", "event_count")])


def stop_and_flush(query: StreamingQuery, checkpoint: str, batch) -> None:
    """Stop a query of ``clock_candles`` and hand the windows still open to its sink ``batch``, numbered -1.

    The sink must merge by key: a restart from the checkpoint goes on with the open windows, and its candle, which then also
    has the ticks that come later, replaces the one written at shutdown.
    """
    query.stop()
    batch(open_candles(query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active(), checkpoint), -1)


def stateful_alerts(candles: DataFrame) -> DataFrame:
    """Alerts of candles (symbol, window_start, open, close) by keyed state, row by row in Python.

    For input in which a window may come again within an hour. ``jobs.alert_stream`` gives the same alerts of candles that
    are emitted once, built in.
    """
    return candles.groupBy("symbol").transformWithStateInPandas(AlertProcessor(), outputStructType=ALERTS, outputMode="Update", timeMode="ProcessingTime")


def moving_average_stream(ticks: DataFrame) -> DataFrame:
    """Running mean of ten prices of ticks (symbol, ts, price)."""
    return ticks.groupBy("symbol").transformWithStateInPandas(MovingAverage(), outputStructType=AVERAGES, outputMode="Update", timeMode="None")
