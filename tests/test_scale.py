"""Bounds on what one task gets, and plans, of the operators that once sorted whole keys."""

import random
import re
from bisect import bisect_left
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
from itertools import takewhile

import pytest
from pyspark.sql import functions as F

from tickframe.operators import market, ohlc, stats, windows
from tickframe.registry import QUERIES
from tickframe.sources.ticks import event_ticks, symbol_dimension

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 2)
TICK = "symbol string, tick_id long, ts timestamp_ntz, price_usd decimal(20,8)"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# median


def test_median_of_near_prices_is_bounded(spark):
    """A million distinct prices within 1 %: no task gets more than the ranges of each task before it."""
    rows = spark.range(1_000_000).select(F.lit("a").alias("symbol"), (F.lit(100) + F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / F.lit(1_000_003)).cast("decimal(20,8)").alias("p"))
    bounds = stats.median_bounds(rows, ["symbol"], "p")
    counted = stats.median_ranges(rows, bounds, ["symbol"], "p", 256)
    assert counted.count() <= 256 and counted.agg(F.sum("n")).first()[0] == 1_000_000
    assert "SortAggregate" not in plan(counted)
    want = rows.agg(F.percentile("p", 0.5)).first()[0]
    assert stats.exact_median(rows, ["symbol"], "p", 256).first()["median"] == want == stats.exact_median(rows, ["symbol"], "p").first()["median"]


def test_median_by_several_keys_with_nulls(spark):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), draw.randrange(2), Decimal(draw.choice([draw.randrange(10**12), 5, -7])) / 10**8) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "s string, k int, p decimal(20,8)")
    for ranges in (2, 3, 4096):
        found = {(r["s"], r["k"]): r["median"] for r in stats.exact_median(frame, ["s", "k"], "p", ranges).collect()}
        want = {(r["s"], r["k"]): r["m"] for r in frame.groupBy("s", "k").agg(F.percentile("p", 0.5).alias("m")).collect()}
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)
    assert stats.exact_median(frame.where("false"), ["s"], "p").count() == 0


# latest rows


@pytest.mark.parametrize("name", ["latest_tick", "latest_candle", "live_tail_merge"])
def test_latest_rows_are_hashed(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "SortAggregate" not in text and "partial_max_by" in text
    lines = text[text.index("partial_max_by") :].splitlines()[1:]
    depth = re.search("[A-Z]", [x for x in text.splitlines() if "partial_max_by" in x][0]).start()
    below = list(takewhile(lambda x: re.search("[A-Z]", x).start() > depth, lines))
    assert below and not any("Sort [" in x for x in below)


def test_latest_stream_is_hashed(spark):
    from tickframe.streaming.jobs import latest_stream

    candles = spark.sql("SELECT 'a' AS symbol, TIMESTAMP'2024-01-01' AS window_start, 1 AS open, 1 AS high, 1 AS low, 1 AS close, 1 AS volume_sum, 1 AS event_count")
    assert "SortAggregate" not in plan(latest_stream(candles))


def test_latest_of_nulls_texts_and_ties(spark):
    rows = [("a", None, 1, "x"), ("a", T0, None, "y"), ("a", T0, -5, "z"), ("b", None, None, "only"), (None, T0, 1, "no key"), (None, T0, 2, None), ("c", T0, 1, "tie"), ("c", T0, 1, "tie")]
    frame = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, id long, text string")
    want = {("a", -5), ("b", None), (None, 2), ("c", 1)}
    assert {(r["symbol"], r["id"]) for r in windows.latest_by(frame, "symbol", ["ts", "id"]).collect()} == want
    found = windows.latest_by(frame.drop("text"), "symbol", ["ts", "id"])
    assert found.columns == ["symbol", "ts", "id"] and {(r["symbol"], r["id"]) for r in found.collect()} == want and found.count() == 4
    with pytest.raises(ValueError):
        windows.latest_by(frame, "symbol", ["text"])


def test_live_tail_with_texts(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "symbol string, window_start int, note string")
    merged = market.live_tail_merge(rows(("a", 1, "h"), ("a", 2, "h"), ("a", 2, "h")), rows(("a", 2, None), ("a", 3, "l")))
    assert sorted((r["window_start"], r["note"], r["is_live"]) for r in merged.collect()) == [(1, "h", False), (2, None, True), (3, "l", True)]


# hot days


def brute_changes(rows):
    """Rows as multi_change gives them, by looking back over a sorted list."""
    by_symbol, out = {}, []
    for r in rows:
        by_symbol.setdefault(r[0], []).append(r)
    for ticks in by_symbol.values():
        ticks.sort(key=lambda r: (r[2], r[1] is not None, r[1] or 0))
        times = [r[2] for r in ticks]
        for symbol, tick, ts, price in ticks:
            bases = [ticks[bisect_left(times, ts - timedelta(seconds=n))][3] for n in windows.SPANS.values()]
            day = [r[3] for r in ticks if ts - timedelta(days=1) <= r[2] <= ts]
            pct = lambda b: 0.0 if b == 0 else (float(price) - float(b)) / float(b) * 100
            out.append((symbol, tick, ts, price, *(round(pct(b), 6) for b in bases), price - bases[1], max(day), min(day)))
    return out


def hot_ticks(seed, n=700):
    draw = random.Random(seed)
    rows = []
    for i in range(n):  # one symbol, one day, in bursts
        at = T0 + timedelta(hours=draw.choice([1, 1, 1, 9, 23]), seconds=draw.choice([0, 0, 1, 1800]), microseconds=draw.choice([0, 5, draw.randrange(10**6)]))
        rows.append(("hot", i, at, Decimal(draw.randrange(1, 9999)) / 8))
    for i in range(80):  # few ticks around it, and another symbol
        rows.append((draw.choice(["hot", "cold"]), 10_000 + i, T0 + timedelta(days=draw.randrange(-33, 5), seconds=draw.randrange(86400)), Decimal(draw.randrange(1, 9999)) / 8))
    return rows


@pytest.mark.parametrize("most", [10**9, 60, 7])
def test_multi_change_of_a_hot_day(spark, most):
    rows = hot_ticks(most)
    rows += [("hot", None, T0 + timedelta(hours=9), Decimal(3)), ("hot", None, T0 + timedelta(hours=9), Decimal(3)), rows[0], rows[0], ("hot", 0, T0 + timedelta(hours=2), Decimal(4))]
    frame = spark.createDataFrame(rows, TICK).repartition(4)
    found = Counter(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in windows.multi_change(frame, most).collect())
    want = Counter(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in brute_changes(rows))
    assert sum(found.values()) == len(rows)
    assert {k[:4] for k in found} == {k[:4] for k in want} and found == want


def test_multi_change_has_tasks_by_rows(spark, monkeypatch):
    """Some 3,900 ticks and look-back points: a task for every 100 of them, and nothing is shuffled once they are sorted."""
    monkeypatch.setattr(windows, "TASK_ROWS", 100, raising=False)
    found = windows.multi_change(spark.createDataFrame(hot_ticks(11), TICK), 20)
    held = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 780 and len(held) > 16 and max(held) < 200
    text = plan(windows.multi_change(spark.createDataFrame(hot_ticks(11), TICK), 20))
    assert "Exchange" not in text[: text.index("Window [")] and "REPARTITION_BY_NUM" in text


def test_buckets_are_bounded(spark):
    frame = spark.createDataFrame(hot_ticks(5), TICK).withColumn("at", windows.epoch_micros("ts"))
    ties = max(r["count"] for r in frame.groupBy("symbol", "at").count().collect())
    hot = windows.hot_cells(frame, 60)
    assert len(hot) > 2
    bucketed = windows.with_bucket(frame, hot)
    assert bucketed.count() == frame.count() and max(r["count"] for r in bucketed.groupBy("symbol", "bucket").count().collect()) <= max(60, ties)
    # Buckets follow one another: no time lies beyond the start of the next one.
    spans = sorted((r["symbol"], r["bucket"], r["a"], r["b"]) for r in bucketed.groupBy("symbol", "bucket").agg(F.min("at").alias("a"), F.max("at").alias("b")).collect())
    assert all(x[1] <= x[2] and (x[0] != y[0] or x[3] < y[1]) for x, y in zip(spans, spans[1:]))
    assert windows.hot_cells(frame) == []


@pytest.mark.parametrize("most", [10**9, 40])
def test_running_means_and_previous_of_a_hot_day(spark, most):
    rows = sorted(set(hot_ticks(9)), key=lambda r: (r[0], r[2], r[1]))
    frame = spark.createDataFrame(rows, TICK).repartition(4)
    means = {(r["symbol"], r["tick_id"]): r["m"] for r in windows.moving_average(frame, "price_usd", 10, ["ts", "tick_id"], "m", most=most).collect()}
    before = {(r["symbol"], r["tick_id"]): r["previous"] for r in windows.with_previous(frame, "price_usd", ["ts", "tick_id"], most=most).collect()}
    for symbol in ("hot", "cold"):
        own = [r for r in rows if r[0] == symbol]
        for i, r in enumerate(own):
            last = [float(x[3]) for x in own[max(0, i - 9) : i + 1]]
            assert abs(means[r[0], r[1]] - sum(last) / len(last)) < 1e-5
            assert before[r[0], r[1]] == (own[i - 1][3] if i else None)
    assert len(means) == len(before) == len(rows)


def test_no_extra_passes_without_hot_days(spark):
    ticks = event_ticks(spark, SF)
    assert plan(windows.with_previous(ticks, "price_usd", ["ts", "tick_id"])).count("LeftSemi") == 0


def test_symbols_with_few_rows_are_shuffled_once(spark):
    """Only a symbol with too many rows is split by days; without one, a table of many symbols is shuffled and sorted once."""
    frame = spark.range(3000).select(F.pmod("id", F.lit(97)).cast("string").alias("symbol"), F.col("id").alias("tick_id"), F.timestamp_seconds(F.col("id") * 86_400).cast("timestamp_ntz").alias("ts"), F.col("id").cast("decimal(20,8)").alias("price_usd"))
    for df in (windows.trend_detect(frame), windows.moving_average(frame, "price_usd", 3, ["ts", "tick_id"], "m")):
        assert len(re.findall("Exchange hashpartitioning", plan(df))) == 1
    for most in (31, 30, 7):  # 92 of the symbols have 31 rows, so none, these or all are split
        found = windows.with_previous(frame, "price_usd", ["ts", "tick_id"], most=most).collect()
        assert len(found) == 3000 and all(r["previous"] == (r["tick_id"] - 97 if r["tick_id"] >= 97 else None) for r in found)


# pages


def test_a_late_page_reads_one_range(spark):
    """Page 10,000 of 100 rows: the ranges' counts give the total, and one range holds the page."""
    rows = spark.range(0, 1_050_000, 1, 16).select((F.pmod(F.col("id") * 7919, F.lit(1_050_000))).alias("k"))
    found = market.page(rows, [F.asc("k")], 100, 999_900)
    assert [r["k"] for r in found.collect()] == list(range(999_900, 1_000_000))
    assert found.select("total", "returned", "has_more").distinct().collect() == [(1_050_000, 100, True)]
    text = plan(found)
    assert "TakeOrderedAndProject" in text and "__range" in text and "Exchange rangepartitioning" not in text
    held = re.search(r"__range#\d+ (?:IN \(([\d,]+)\)|= (\d+))", text)
    assert held and len((held[1] or held[2]).split(",")) <= 2
    last = market.page(rows, [F.desc("k")], 1000, 1_049_500)
    assert [r["k"] for r in last.collect()] == list(range(499, -1, -1)) and last.first()["returned"] == 500 and not last.first()["has_more"]
    assert market.page(rows, [F.asc("k")], 10, 2_000_000).count() == 0
    assert market.page(rows.where("false"), [F.asc("k")]).count() == 0


def test_history_aggregates_the_candles_once(spark):
    ticks = event_ticks(spark, SF)
    dimension = symbol_dimension(spark, SF)
    records = ohlc.candle_records(ohlc.ohlc(ticks, "1 hour"), dimension)
    rows = market.history_rows(records, dimension)
    rows.collect()
    final = plan(rows).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    end = records.agg(F.max("window_start")).first()[0]
    same = market.history_rows(records, dimension, end=end)
    assert rows.exceptAll(same).count() == same.exceptAll(rows).count() == 0
