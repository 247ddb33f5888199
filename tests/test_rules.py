"""Hand-built rows with known answers, plan checks, and invariants."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickframe.functions import scalars
from tickframe.operators import market, ohlc, quality, stats, tables, windows
from tickframe.registry import QUERIES
from tickframe.sources.ticks import decode_ticks, event_ticks, symbol_dimension

SF = "/root/testdata/sf0.001"
CANDLE = "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, open decimal(20,8), high decimal(20,8), low decimal(20,8), close decimal(20,8), volume_sum decimal(38,2), event_count long"
T0 = datetime(2024, 1, 1)


def candle(opened, closed, symbol="x", at=0, volume=0):
    start = T0 + timedelta(minutes=at)
    d = lambda v: None if v is None else Decimal(str(v))
    pair = [v for v in (d(opened), d(closed)) if v is not None]
    return symbol, start, start + timedelta(minutes=1), d(opened), max(pair), min(pair), d(closed), Decimal(volume), 1


def test_alert_edges(spark):
    rows = [candle(100, c, str(c)) for c in ("105.00", "105.005", "105.01", "93.00", "110.00")] + [candle(0, 5, "zero"), candle(100, None, "none")]
    alerts = {r["symbol"]: (r["price_change_pct"], r["alert_type"], r["severity"]) for r in ohlc.price_alerts(spark.createDataFrame(rows, CANDLE)).collect()}
    assert alerts == {"105.01": (Decimal("5.0100"), "PRICE_SPIKE", "LOW"), "93.00": (Decimal("-7.0000"), "PRICE_DROP", "MEDIUM"), "110.00": (Decimal("10.0000"), "PRICE_SPIKE", "HIGH")}


def test_typical_price_and_unknown_symbol(spark):
    rows = [("btc", T0, T0, *(Decimal(x) for x in (95750, 95800, 95700, 95780)), Decimal(1), 12), candle(1, 1, "zzz")]
    dim = spark.createDataFrame([(1, "btc")], "crypto_id int, symbol string")
    found = ohlc.candle_records(spark.createDataFrame(rows, CANDLE), dim).collect()
    assert [(r["crypto_id"], r["avg_price"]) for r in found] == [(1, Decimal("95757.50000000"))]


def test_valid_and_rejected_ticks(spark):
    rows = [(None, 1.0, T0), ("", 1.0, T0), ("a", 0.0, T0), ("a", -1.0, T0), ("a", None, T0), ("a", 1.0, None), ("a", 1.0, T0)]
    ticks = spark.createDataFrame(rows, "symbol string, price_usd double, ts timestamp_ntz")
    assert ohlc.valid_ticks(ticks).count() == 1
    prices = spark.createDataFrame([(p,) for p in ("0.0001", "0.00009", "1000000", "1000000.01")], "p string").select(F.lit("a").alias("symbol"), F.col("p").cast("decimal(20,8)").alias("price_usd"), F.lit("x").alias("ts"))
    assert {r["reason"]: r["n"] for r in quality.reject_reasons(prices).collect()} == {"ok": 2, "price_too_low": 1, "price_too_high": 1}


def test_decoding(spark):
    raw = spark.createDataFrame([("{bad",), ('{"symbol":"A","price_usd":1.5,"z":9}',)], "value string")
    assert [r["symbol"] for r in decode_ticks(raw).collect()] == [None, "A"]


def test_window_edges_order_and_null_volume(spark):
    edge = datetime(2024, 1, 1, 0, 0, 59, 999000)
    rows = [("a", Decimal(5), None, edge, 2), ("a", Decimal(7), None, datetime(2024, 1, 1, 0, 1), 1), ("a", Decimal(9), None, edge, 1), ("a", Decimal(1), None, datetime(2024, 1, 1, 0, 0, 1), 9)]
    found = ohlc.ohlc(spark.createDataFrame(rows, "symbol string, price_usd decimal(20,8), volume_24h decimal(20,2), ts timestamp_ntz, tick_id long"), "1 minute").orderBy("window_start").collect()
    assert [(r["open"], r["close"], r["volume_sum"], r["event_count"]) for r in found] == [(1, 5, 0, 3), (7, 7, 0, 1)]


def test_parameter_checks(spark):
    market.check_range(T0, T0 + timedelta(days=30, hours=23))
    for bad in ((T0, T0 + timedelta(days=31)), (T0, T0)):
        with pytest.raises(ValueError):
            market.check_range(*bad)
    df = spark.createDataFrame([(1,)], "change_pct int")
    for call in (lambda: market.page(df, [], 1001), lambda: market.page(df, [], 1, -1), lambda: market.movers(df, "abs", 51), lambda: market.recent_alerts(df, df, 169)):
        with pytest.raises(ValueError):
            call()


def test_text_forms(spark):
    f = scalars
    row = spark.range(1).select(
        f.amount_text(F.lit(1234.5)), f.amount_text(F.lit(2.5e12), True), f.amount_text(F.lit(2.5e12)), f.amount_text(F.lit(None).cast("double")), f.signed_percent_text(F.lit(1.5)), f.signed_percent_text(F.lit(0.0), False),
        f.adaptive_price_text(F.lit(1234.567)), f.adaptive_price_text(F.lit(0.123456789)), f.adaptive_price_text(F.lit(float("nan"))), f.title_words(F.lit("PRICE_SPIKE")), f.relative_age(F.lit(3600)), f.percent_change(F.lit(5), F.lit(0)),
    ).first()
    assert tuple(row) == ("$1.23K", "$2.50T", "$2500.00B", "$0.00", "+1.50%", "0.00%", "1,234.57", "0.123457", f.DASH, "Price Spike", "1 hour", 0.0)


def test_live_tail(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "symbol string, window_start int, close int")
    merged = market.live_tail_merge(rows(("a", 1, 10), ("a", 2, 11)), rows(("a", 2, 99), ("a", 3, 12)))
    assert sorted((r["window_start"], r["close"], r["is_live"]) for r in merged.collect()) == [(1, 10, False), (2, 99, True), (3, 12, True)]


def test_short_series_has_no_average(spark):
    frame = spark.createDataFrame([candle(i + 1, i + 1, at=i) for i in range(19)], CANDLE)
    assert windows.candle_sma(frame).where("sma_20 IS NOT NULL").count() == 0


def test_exact_median(spark):
    values = {"odd": [3, 1, 2], "even": [4, 1, 3, 2], "ties": [5, 5, 5, 1, 9], "far": [1, 1000000], "sign": [-5, -1, 0, 2], "one": [7], "null": [None], "some": [None, 4, 8]}
    rows = [(k, None if v is None else Decimal(v)) for k, vs in values.items() for v in vs] + [("many", Decimal(i * i % 997) / 8) for i in range(5000)]
    frame = spark.createDataFrame(rows, "symbol string, p decimal(20,8)")
    found = {r["symbol"]: r["median"] for r in stats.exact_median(frame, ["symbol"], "p").collect()}
    want = {r["symbol"]: r["m"] for r in frame.groupBy("symbol").agg(F.percentile("p", 0.5).alias("m")).collect() if r["m"] is not None}
    assert found == want and len(found) == len(values)


def test_rollup_and_invariants(spark):
    ticks = event_ticks(spark, SF)
    direct, rolled = ohlc.ohlc(ticks, "15 minutes"), ohlc.rollup(ohlc.ohlc(ticks, "1 minute"), "15 minutes")
    assert direct.exceptAll(rolled).count() == rolled.exceptAll(direct).count() == 0
    assert direct.where("low > least(open, close) OR high < greatest(open, close)").count() == 0
    assert direct.agg(F.sum("event_count")).first()[0] == ohlc.valid_ticks(ticks).count()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    ticks = event_ticks(spark, SF)
    candles = plan(ohlc.ohlc(ticks, "1 hour"))
    assert "SortAggregate" not in candles and candles.count("Exchange hashpartitioning") == 1 and "partial_min_by" in candles
    # A small dimension is broadcast by Spark when it has seen its size, a large one is not.
    records = ohlc.candle_records(ohlc.ohlc(ticks, "1 hour"), symbol_dimension(spark, SF))
    records.collect()
    assert "BroadcastHashJoin" in plan(records)
    assert "TakeOrderedAndProject" in plan(market.movers(spark.range(500).selectExpr("id AS symbol", "id AS change_pct"), "abs"))
    path = str(tmp_path / "candles")
    tables.write_by_date(ohlc.candle_records(ohlc.ohlc(ticks, "1 hour"), symbol_dimension(spark, SF)), path, "window_start", "crypto_id")
    rows = market.history_rows(spark.read.parquet(path), symbol_dimension(spark, SF), date_column="date")
    assert "PartitionFilters: [isnotnull(date" in plan(rows) and "PushedFilters: [IsNotNull(window_start)" in plan(rows)


def sorted_windows(df) -> list[str]:
    """The keys of the plan's windows that are fed from ticks or candles, not from one row a day."""
    keys = []
    for line in plan(df).splitlines():
        if "Window [" in line and "windowspecdefinition(" in line:
            keys.append(line.split("windowspecdefinition(")[1].split(" ASC")[0].split(" DESC")[0])
    return keys


def test_no_window_sorts_a_whole_symbol(spark):
    """All windows go by symbol and bucket, but for those over one row a bucket."""
    ticks = ohlc.valid_ticks(event_ticks(spark, SF))
    candles = ohlc.ohlc(ticks, "1 hour")
    for df in (windows.multi_change(ticks), windows.candle_sma(candles), windows.moving_average(ticks, "price_usd", 10, ["ts", "tick_id"], "m"), windows.trend_detect(ticks), ohlc.candle_change(candles)):
        by_symbol = [k for k in sorted_windows(df) if "bucket#" not in k.split(",")[1] and "_w" not in k]
        assert all("bucket#" in k or "day#" in k for k in by_symbol) and len(by_symbol) <= 4
        assert sorted_windows(df)


def test_days_are_dealt_apart(spark):
    rows = [("a", 1, "2024-01-01 10:00:00", 1), ("a", 2, "2024-01-01 11:00:00", None), ("a", 3, "2024-01-04 00:00:00", 3), ("a", 5, "2024-01-04 00:00:00", 5), ("a", 6, "2024-01-05 09:00:00", 6), ("b", 4, "2024-01-04 01:00:00", 4), (None, 7, "2024-01-04 02:00:00", 7), (None, 8, "2024-01-06 02:00:00", 8)]
    frame = spark.createDataFrame(rows, "symbol string, tick_id long, ts string, p int").selectExpr("symbol", "tick_id", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "CAST(p AS DECIMAL(20,8)) AS price_usd")
    found = {r["tick_id"]: r["previous"] for r in windows.trend_detect(frame).collect()}
    assert found == {1: None, 2: 1, 3: None, 5: 3, 6: 5, 4: None, 7: None, 8: 7}
    first = plan(QUERIES["trending_slice"](spark, SF))
    assert first.index("collect_list") < first.index("WindowGroupLimit") and first.count("WindowGroupLimit") >= 2


def test_seed_symbols_reads_every_tick(spark, tmp_path):
    rows = [(1, "2024-01-01 10:00:00", "click"), (3, "2024-01-02 10:00:00", "click"), (2, "2024-01-02 11:00:00", "view")]
    events = spark.createDataFrame(rows, "event_id long, ts string, event_type string")
    events.selectExpr("event_id", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "event_id AS user_id", "event_type", "1.5D AS value", "'{}' AS props").write.parquet(str(tmp_path / "events.parquet"))
    missing = {r["symbol"] for r in QUERIES["seed_symbols"](spark, str(tmp_path)).collect()}
    assert missing and not missing & {"click", "view"}


def test_csv(spark, tmp_path):
    path = tables.write_csv(spark.range(3), str(tmp_path), "export", T0)
    assert path.endswith("export_20240101_000000") and spark.read.option("header", True).csv(path).count() == 3
