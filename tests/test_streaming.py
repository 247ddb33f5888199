"""Streams over scripted micro-batches against the batch operators."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from tickframe.operators import ohlc, tables
from tickframe.sources.ticks import decode_alerts, decode_ticks, file_ticks, tick_messages
from tickframe.streaming import jobs, sinks

START = datetime.datetime(2024, 1, 1, 10, 0, 0)


def tick(second, price, symbol="BTC", message=None, volume=1.0):
    at = (START + datetime.timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"symbol": symbol, "price_usd": price, "volume_24h": volume, "timestamp": at, "message_id": message or f"{symbol}-{second}", "z": 9}


@pytest.fixture
def feed(spark, tmp_path):
    """Writes batches of ticks, one file each, and opens a stream of them."""
    folder = tmp_path / "in"
    folder.mkdir()
    number = [0]

    def write(*ticks, raw=()):
        (folder / f"{number[0]:03}.json").write_text("\n".join([*map(json.dumps, ticks), *raw]))
        number[0] += 1
        time.sleep(0.02)

    return write, lambda: jobs.tick_stream(file_ticks(spark, str(folder)))


def collected(spark, stream, tmp_path, mode="append", name="out"):
    rows = []
    query = sinks.start(stream, str(tmp_path / f"check-{name}"), lambda df, n: rows.extend(df.collect()), mode, None)
    query.awaitTermination(120)
    assert query.exception() is None
    return rows, query


BATCHES = [
    [tick(1, 100), tick(30, 103), tick(59, 110)],
    [tick(62, 111), tick(20, 90), tick(61, 111.5), tick(75, 100, "ETH")],
    [tick(119, 100), tick(150, 7, "ETH"), tick(130, 101)],
    [tick(400, 1), tick(400, 1, "ETH")],
    [tick(900, 1), tick(900, 1, "ETH")],
]


def batch_candles(spark, width, upto):
    rows = [t for b in BATCHES for t in b]
    ticks = spark.createDataFrame([(t["symbol"], float(t["price_usd"]), t["volume_24h"], t["timestamp"], i) for i, t in enumerate(rows)], "symbol string, p double, v double, timestamp string, tick_id long")
    ticks = ticks.select("symbol", F.col("p").cast("decimal(20,8)").alias("price_usd"), F.col("v").cast("decimal(20,2)").alias("volume_24h"), F.to_timestamp("timestamp").alias("ts"), "tick_id")
    return ohlc.ohlc(ticks, width).where(F.col("window_end") <= F.lit(START + datetime.timedelta(seconds=upto)))


def test_candles_alerts_and_rollup_equal_batch(spark, feed, tmp_path):
    write, stream = feed
    for b in BATCHES:
        write(*b, raw=["{bad", json.dumps({"symbol": "", "price_usd": 1}), json.dumps({**tick(5, -1)}), json.dumps({**tick(5, 1), "timestamp": "never", "last_updated": None})])
    want = batch_candles(spark, "1 minute", 880)
    names = ["symbol", "window_start", "open", "high", "low", "close", "volume_sum", "event_count"]
    rows, _ = collected(spark, jobs.flat(jobs.candle_stream(stream())), tmp_path)
    assert {tuple(r[n] for n in names) for r in rows} == {tuple(r) for r in want.select(*names).collect()}
    assert len(rows) == want.count()
    alerts, _ = collected(spark, jobs.alert_stream(jobs.candle_stream(stream())), tmp_path, name="alerts")
    assert {(r["symbol"], r["price_change_pct"]) for r in alerts} == {(r["symbol"], r["price_change_pct"]) for r in ohlc.price_alerts(want).collect()}
    assert alerts
    wide, _ = collected(spark, jobs.flat(jobs.rollup_stream(jobs.candle_stream(stream()), "5 minutes")), tmp_path, name="wide")
    five = batch_candles(spark, "5 minutes", 500)
    assert {tuple(r[n] for n in names) for r in wide} >= {tuple(r) for r in five.select(*names).collect()}


def test_late_ticks_are_dropped_and_counted(spark, feed, tmp_path):
    write, stream = feed
    for b in ([tick(1, 100)], [tick(300, 1)], [tick(301, 1)], [tick(2, 50)], [tick(600, 1)], [tick(601, 1)]):
        write(*b)
    rows, query = collected(spark, jobs.flat(jobs.candle_stream(stream())), tmp_path)
    assert [r["event_count"] for r in rows if r["open"] == 100] == [1]
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 1


def test_repeated_messages_count_once(spark, feed, tmp_path):
    write, stream = feed
    for b in ([tick(1, 100, message="m"), tick(1, 100, message="m")], [tick(2, 100, message="m"), tick(3, 1, message="k")]):
        write(*b)
    rows, _ = collected(spark, jobs.without_repeats(stream()), tmp_path)
    assert sorted(r["message_id"] for r in rows) == ["k", "m"]


def test_upsert_is_idempotent_and_restarts(spark, feed, tmp_path):
    write, stream = feed
    path = str(tmp_path / "table")
    merge = sinks.upsert_by_date(path, ["symbol", "window_start"], "window_start")
    run = lambda: sinks.start(jobs.flat(jobs.candle_stream(stream())), str(tmp_path / "check"), merge, every=None).awaitTermination(120)
    for b in BATCHES[:3]:
        write(*b)
    run()
    for b in BATCHES[3:]:
        write(*b)
    run()
    read = lambda: sorted(map(tuple, spark.read.parquet(path).select("symbol", "window_start", "close").collect()))
    want = sorted(map(tuple, batch_candles(spark, "1 minute", 880).select("symbol", "window_start", "close").collect()))
    assert read() == want
    one = spark.read.parquet(path).drop("date", "run_id", "batch_id").limit(1).collect()
    again = spark.createDataFrame(one, spark.read.parquet(path).drop("date", "run_id", "batch_id").schema).withColumn("close", F.lit(5).cast("decimal(20,8)"))
    for _ in range(2):
        merge(again, 99)
    assert len(read()) == len(want) and sum(r[2] == 5 for r in read()) == 1


def test_fresh_checkpoint_loses_nothing(spark, feed, tmp_path):
    """A query that starts anew counts its batches from 0; what earlier ones wrote stays, and so do their files."""
    write, stream = feed
    candles = lambda: jobs.flat(jobs.candle_stream(stream()))
    targets = [sinks.upsert_by_date(str(tmp_path / "table"), ["symbol", "window_start"], "window_start"), sinks.latest_table(str(tmp_path / "latest")), sinks.publish_candles(str(tmp_path / "json"))]

    def run(name):
        for i, batch in enumerate(targets):
            sinks.start(candles(), str(tmp_path / f"{name}-{i}"), batch, every=None).awaitTermination(120)

    for b in BATCHES:
        write(*b)
    run("one")
    rows = lambda: {(r["symbol"], r["window_start"]): r["close"] for r in spark.read.parquet(str(tmp_path / "table")).collect()}
    before, latest = rows(), {r["symbol"]: r["window_start"] for r in sinks.read_latest(spark, str(tmp_path / "latest")).collect()}
    files = spark.read.json(str(tmp_path / "json")).count()
    assert before and files == len(before)
    for path in (tmp_path / "in").iterdir():
        path.unlink()
    write(tick(3, 50, "NEW"))
    write(tick(901, 1, "NEW"))
    write(tick(902, 1, "NEW"))
    run("two")
    after = rows()
    assert {k: v for k, v in after.items() if k[0] != "NEW"} == before and ("NEW", START) in {(k[0], k[1].replace(tzinfo=None)) for k in after}
    now = {r["symbol"]: r["window_start"] for r in sinks.read_latest(spark, str(tmp_path / "latest")).collect()}
    assert {k: v for k, v in now.items() if k != "NEW"} == latest and "NEW" in now
    assert spark.read.json(str(tmp_path / "json")).count() == files + 1
    assert not any((tmp_path / "table__staged").iterdir())
    assert len([x for x in (tmp_path / "latest").iterdir() if x.name.startswith("version=")]) <= 3


def test_early_candles_by_update_mode(spark, feed, tmp_path):
    """Open windows show after every batch, and later ticks change them; the table holds each window once."""
    write, stream = feed
    path, check = str(tmp_path / "table"), str(tmp_path / "check")
    merge = sinks.upsert_by_date(path, ["symbol", "window_start"], "window_start")
    run = lambda: sinks.start(jobs.flat(jobs.candle_stream(stream())), check, merge, "update", None).awaitTermination(120)
    first = lambda: [(float(r["close"]), r["event_count"]) for r in spark.read.parquet(path).where("symbol = 'BTC'").orderBy("window_start").collect()]
    write(tick(1, 100), tick(30, 103))
    run()
    assert first() == [(103.0, 2)]
    write(tick(40, 104), tick(70, 7))
    run()
    assert first() == [(104.0, 3), (7.0, 1)]


def test_alerts_are_published_read_again_and_printed(spark, feed, tmp_path):
    write, stream = feed
    for b in BATCHES:
        write(*b)
    path = tmp_path / "alerts"
    alerts = lambda: jobs.alert_stream(jobs.candle_stream(stream()))
    sinks.start(alerts(), str(tmp_path / "c1"), sinks.publish_alerts(str(path)), every=None).awaitTermination(120)
    want, _ = collected(spark, alerts(), tmp_path)
    published = spark.read.json(str(path))
    assert want and published.count() == len(want)
    published.select("value").unionByName(spark.createDataFrame([("{bad",), ('{"alert_type":"PRICE_DROP"}',)], "value string")).write.text(str(tmp_path / "topic"))
    read, _ = collected(spark, decode_alerts(spark.readStream.text(str(tmp_path / "topic"))), tmp_path, name="read")
    key = lambda r, pct: (r["symbol"], r["alert_type"], float(r[pct]), r["severity"])
    assert sorted(key(r, "price_change_percent") for r in read) == sorted(key(r, "price_change_pct") for r in want)
    printed = sinks.print_lines(ohlc.alert_lines(alerts()), every=None)
    printed.awaitTermination(120)
    assert printed.exception() is None and sum(p["sink"]["numOutputRows"] for p in printed.recentProgress) == len(want)


def test_tick_messages_are_published_by_key(spark, tmp_path):
    ticks = spark.createDataFrame([("BTC", 1.5, 2.0, START), ("ETH", 2.5, None, START)], "symbol string, p double, v double, ts timestamp_ntz")
    ticks = ticks.select("symbol", F.col("p").cast("decimal(20,8)").alias("price_usd"), F.col("v").cast("decimal(20,2)").alias("volume_24h"), "ts")
    tables.publish(tick_messages(ticks), str(tmp_path / "topic"))
    tables.publish(tick_messages(ticks), str(tmp_path / "topic"))
    sent = spark.read.json(str(tmp_path / "topic"))
    assert {r["key"] for r in sent.collect()} == {"BTC", "ETH"} and sent.count() == 4
    back = decode_ticks(sent.select("value")).distinct().orderBy("symbol").collect()
    assert [(r["symbol"], float(r["price_usd"]), r["timestamp"]) for r in back] == [("BTC", 1.5, "2024-01-01T10:00:00Z"), ("ETH", 2.5, "2024-01-01T10:00:00Z")]
    assert back[0]["message_id"] == f"BTC-{int(START.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)}"


def test_ties_go_by_offset(spark, tmp_path):
    """Ticks of one time are in the order of their offsets, as in batch."""
    rows = [(json.dumps(tick(1, p)), n) for n, p in ((7, 10), (9, 30), (8, 20))] + [(json.dumps(tick(s, 1)), s) for s in (600, 1200)]
    spark.createDataFrame(rows, "value string, kafka_offset long").write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema("value string, kafka_offset long").parquet(str(tmp_path / "in"))
    out, _ = collected(spark, jobs.flat(jobs.candle_stream(jobs.tick_stream(raw))), tmp_path, "update")
    assert [(float(r["open"]), float(r["close"])) for r in out if r["event_count"] == 3] == [(10.0, 30.0)]


def test_latest_table_expires(spark, feed, tmp_path):
    write, stream = feed
    for b in BATCHES:
        write(*b)
    path = str(tmp_path / "latest")
    sinks.start(jobs.flat(jobs.candle_stream(stream())), str(tmp_path / "check"), sinks.latest_table(path), every=None).awaitTermination(120)
    latest = {r["symbol"]: r for r in sinks.read_latest(spark, path).collect()}
    assert {k: float(v["close"]) for k, v in latest.items()} == {"BTC": 1.0, "ETH": 1.0}
    end = latest["BTC"]["window_end"]
    assert sinks.read_latest(spark, path, end + datetime.timedelta(seconds=299)).count() == 2
    assert sinks.read_latest(spark, path, end + datetime.timedelta(seconds=301)).count() == 0


def test_sinks_write_files(spark, feed, tmp_path):
    write, stream = feed
    for b in BATCHES:
        write(*b)
    sinks.raw_tick_sink(stream(), str(tmp_path / "raw"), str(tmp_path / "c1"), every=None).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "raw")).count() == sum(map(len, BATCHES))
    sinks.start(jobs.flat(jobs.candle_stream(stream())), str(tmp_path / "c2"), sinks.publish_candles(str(tmp_path / "json"), ["ETH"]), every=None).awaitTermination(120)
    assert {r["key"] for r in spark.read.json(str(tmp_path / "json")).collect()} == {"ETH"}
    alerts = sinks.alert_table(str(tmp_path / "alerts"))
    sinks.start(jobs.alert_stream(jobs.candle_stream(stream())), str(tmp_path / "c3"), alerts, every=None).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "alerts")).where("created_at = window_end").count() > 0
    candles = batch_candles(spark, "1 minute", 880)
    candles.write.parquet(str(tmp_path / "candles"))
    emitted = spark.readStream.schema(candles.schema).parquet(str(tmp_path / "candles"))
    rows, _ = collected(spark, jobs.latest_stream(emitted), tmp_path, "update", "latest")
    assert {r["symbol"]: r["window_start"] for r in rows} == {r["symbol"]: r["m"] for r in candles.groupBy("symbol").agg(F.max("window_start").alias("m")).collect()}


def test_stateful_moving_average(spark, feed, tmp_path):
    from tickframe.streaming.stateful import moving_average_stream

    write, stream = feed
    write(*[tick(i, 10 + i) for i in range(12)])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        ticks = stream().select("symbol", "ts", F.col("price_usd").cast("double").alias("price"))
        rows, _ = collected(spark, moving_average_stream(ticks), tmp_path, "update")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert [r["average"] for r in sorted(rows, key=lambda r: r["ts"])][-1] == sum(range(12, 22)) / 10


def test_stateful_alerts_once_per_window(spark, tmp_path):
    """With time to live the state needs processing time, under which a query only ends by being stopped."""
    from tickframe.streaming.stateful import stateful_alerts

    candles = [("BTC", 0, 100.0, 110.0), ("BTC", 0, 100.0, 110.0), ("BTC", 1, 100.0, 105.0), ("ETH", 1, 100.0, 90.0), ("ETH", 2, 0.0, 5.0)]
    frame = spark.createDataFrame([(s, START + datetime.timedelta(minutes=m), o, c) for s, m, o, c in candles], "symbol string, window_start timestamp, open double, close double")
    frame = frame.withColumns({c: F.col(c).cast("decimal(20,8)") for c in ("open", "close")})
    frame.write.parquet(str(tmp_path / "in"))
    rows = []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    query = None
    try:
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        query = sinks.start(stateful_alerts(stream), str(tmp_path / "check"), lambda df, n: rows.extend(df.collect()), "update", "1 second")
        until = time.time() + 90
        while len(rows) < 2 and time.time() < until and query.isActive:
            time.sleep(0.5)
    finally:
        if query:
            query.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted((r["symbol"], float(r["price_change_pct"])) for r in rows) == [("BTC", 10.0), ("ETH", -10.0)]


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


def until(ready, query, seconds=90):
    end = time.time() + seconds
    while not ready() and time.time() < end and query.isActive:
        time.sleep(0.3)
    assert query.exception() is None


def test_candles_close_by_the_clock_and_at_shutdown(spark, feed, tmp_path, rocksdb):
    """No later tick comes: the candle appears once its window ended 5 s ago. What is open at shutdown is flushed, and a
    restart goes on with it."""
    from tickframe.streaming.stateful import clock_candles, open_candles, stop_and_flush

    write, stream = feed
    path, check, seen = str(tmp_path / "table"), str(tmp_path / "check"), []
    merge = sinks.upsert_by_date(path, ["symbol", "window_start"], "window_start")

    def batch(df, number):
        seen.extend((r["symbol"], r["window_start"], float(r["open"]), float(r["high"]), float(r["low"]), float(r["close"]), float(r["volume_sum"]), r["event_count"]) for r in df.collect())
        merge(df, number)

    run = lambda: sinks.start(clock_candles(stream()), check, batch, "update", "1 second")
    ahead = 365 * 86_400 * 40  # windows that end long after this test
    write(tick(1, 100), tick(30, 103), tick(20, 90, volume=None), tick(59, 110), tick(62, 7, "ETH"), tick(ahead, 5, "SOL"), tick(ahead + 1, 6, "SOL"))
    query, began = run(), time.time()
    until(lambda: len(seen) >= 2, query)
    assert time.time() - began >= 5
    assert sorted(r[0:1] + r[2:] for r in seen) == [("BTC", 100.0, 110.0, 90.0, 110.0, 3.0, 4), ("ETH", 7.0, 7.0, 7.0, 7.0, 1.0, 1)]
    write(tick(40, 500), tick(ahead + 2, 4, "SOL"))  # late for a closed window; and more for an open one
    until(lambda: any(p["numInputRows"] == 2 for p in query.recentProgress), query)
    stop_and_flush(query, check, merge)
    rows = {(r["symbol"]): (float(r["open"]), float(r["close"]), r["event_count"]) for r in spark.read.parquet(path).collect()}
    assert rows == {"BTC": (100.0, 110.0, 4), "ETH": (7.0, 7.0, 1), "SOL": (5.0, 4.0, 3)}
    assert len(seen) == 2 and open_candles(spark, check).count() == 1
    write(tick(ahead + 3, 8, "SOL"))
    query = run()
    until(lambda: any(p["numInputRows"] == 1 for p in query.recentProgress), query)
    stop_and_flush(query, check, merge)
    last = spark.read.parquet(path).where("symbol = 'SOL'").collect()
    assert [(float(r["open"]), float(r["close"]), r["event_count"]) for r in last] == [(5.0, 8.0, 4)] and len(seen) == 2


def test_counters_are_observed_while_data_is_written(spark, feed, tmp_path):
    """One pass writes and counts, in a batch and in a stream, and both give what run_counters gives."""
    from tickframe.operators import stats

    write, _ = feed
    for b in BATCHES:
        write(*b, raw=["{bad", json.dumps({"symbol": "", "price_usd": 1}), json.dumps({**tick(5, -1)})])
    folder = str(tmp_path / "in")
    decoded = decode_ticks(spark.read.text(folder))
    coverage = spark.createDataFrame([("BTC", True, 50.0), ("X", False, 50.0)], "symbol string, hit boolean, hit_rate_pct double")
    want = stats.run_counters(decoded, coverage).first()
    assert want["produced"] == sum(map(len, BATCHES)) and want["errors"] == 3 * len(BATCHES)
    watched, counts = stats.observed(decoded)
    watched.write.parquet(str(tmp_path / "out"))
    assert counts.get == {"produced": want["produced"], "errors": want["errors"]}
    listener = jobs.RunCounters()
    spark.streams.addListener(listener)
    try:
        stream = jobs.counted_stream(decode_ticks(file_ticks(spark, folder)))
        rows, query = collected(spark, stream, tmp_path)
        until(lambda: sum(listener.totals(str(query.id)).values()) >= len(rows), query, 30) if query.isActive else time.sleep(2)
        assert listener.totals(str(query.id)) == counts.get and len(rows) == sum(counts.get.values())
        write(*BATCHES[0])
        collected(spark, jobs.counted_stream(decode_ticks(file_ticks(spark, folder))), tmp_path)  # a restart from the checkpoint
        time.sleep(2)
        assert listener.totals(str(query.id))["produced"] == want["produced"] + len(BATCHES[0])
    finally:
        spark.streams.removeListener(listener)


def test_replayed_alerts_are_read_once(spark, tmp_path):
    """A topic with messages sent twice, within a run and again before a restart."""
    alerts = ohlc.price_alerts(batch_candles(spark, "1 minute", 880))
    messages = ohlc.alert_messages(alerts)
    assert messages.columns == ["key", "value", "dedupe_key", "headers"]
    one = messages.orderBy("dedupe_key").first()
    assert one["dedupe_key"] == bytes(one["headers"][0]["value"]).decode() and one["dedupe_key"].count("|") == 2
    n, topic = alerts.count(), str(tmp_path / "topic")
    assert n and messages.select("dedupe_key").distinct().count() == n
    send = lambda df: df.select("value").coalesce(1).write.mode("append").text(topic)
    send(messages.unionByName(messages))
    read = lambda: collected(spark, jobs.alerts_once(decode_alerts(spark.readStream.text(topic))), tmp_path)[0]
    first = read()
    assert sorted(r["dedupe_key"] for r in first) == sorted(r["dedupe_key"] for r in messages.collect())
    send(messages)
    assert read() == []


def test_raw_ticks_run_on(spark, feed, tmp_path):
    """With a trigger the sink goes on with what comes later."""
    write, stream = feed
    write(tick(1, 100))
    query = sinks.raw_tick_sink(stream(), str(tmp_path / "raw"), str(tmp_path / "check"), every="1 second")
    try:
        count = lambda: sum(p["numInputRows"] for p in query.recentProgress)
        until(lambda: count() == 1, query)
        write(tick(2, 100))
        until(lambda: count() == 2, query)
        assert query.isActive and spark.read.parquet(str(tmp_path / "raw")).count() == 2
    finally:
        query.stop()


def test_latest_ticks_are_kept_as_a_table(spark, feed, tmp_path):
    """The last tick of each symbol, by time and then offset, without reading the history."""
    write, stream = feed
    for b in BATCHES:
        write(*b)
    path = str(tmp_path / "latest")
    ticks = lambda: stream().select("symbol", "ts", "tick_id", "price_usd")
    keep = sinks.latest_table(path, "symbol", ("ts", "tick_id"))
    sinks.start(ticks(), str(tmp_path / "check"), keep, every=None).awaitTermination(120)
    read = lambda: {r["symbol"]: (r["ts"], float(r["price_usd"])) for r in sinks.read_latest(spark, path).collect()}
    assert {k: v[1] for k, v in read().items()} == {"BTC": 1.0, "ETH": 1.0}
    write(tick(800, 50, "BTC"), tick(901, 60, "ETH"))  # one comes too late to be the last
    sinks.start(ticks(), str(tmp_path / "check"), keep, every=None).awaitTermination(120)
    assert {k: v[1] for k, v in read().items()} == {"BTC": 1.0, "ETH": 60.0}
