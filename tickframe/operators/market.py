"""Joins, rankings and merges behind the market views."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.scalars import (
    adaptive_price_text,
    amount_text,
    clock_text,
    count_text,
    percent_change,
    price_text,
    relative_age,
    signed_percent_text,
    title_words,
    trend_class,
)
from tickframe.operators.lineage import checkpointed
from tickframe.operators.nested import recent_series
from tickframe.operators.windows import latest_by

#: Limits of the query parameters.
MOST_ROWS, MOST_DAYS, MOST_MOVERS, MOST_ALERTS, MOST_HOURS = 1000, 30, 50, 100, 168


def timestamp(value: datetime) -> Column:
    """A time without zone as literal, so that comparisons reach the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def as_of(df: DataFrame, column: str = "ts") -> datetime:
    """The latest time of a table; reports look back from it, never from the clock."""
    return df.agg(F.max(column).cast("timestamp_ntz")).first()[0] or datetime(1970, 1, 1)


def check_range(start: datetime, end: datetime) -> None:
    if start >= end:
        raise ValueError("start must be before end")
    if (end - start).days > MOST_DAYS:
        raise ValueError(f"the range may span {MOST_DAYS} days at most")


def page(df: DataFrame, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    """One page in order, each row with the total, the rows returned and whether more follow.

    The rows are dealt into ranges of the order once and kept; the ranges' counts give the total and tell which range, or
    few neighbouring ones, hold the page. Only these are looked into, so a late page costs what the first one does and no
    task sorts all rows.
    """
    if not 1 <= limit <= MOST_ROWS or offset < 0:
        raise ValueError(f"limit must be 1 to {MOST_ROWS} and offset not negative")
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").count().orderBy("__range").collect()  # a row for each range
    held, first, total = [], None, 0
    for r in counts:
        if total < offset + limit and total + r["count"] > offset:
            held, first = [*held, r["__range"]], total if first is None else first
        total += r["count"]
    rows = ranged.where(F.col("__range").isin(held)).drop("__range").orderBy(*order).offset(offset - (first or 0)).limit(limit)
    return rows.withColumns({"total": F.lit(total).cast("long"), "returned": F.lit(min(limit, max(0, total - offset))).cast("long"), "has_more": F.lit(total > offset + limit)})


def history_rows(records: DataFrame, dimension: DataFrame, symbols: list[str] | None = None, start: datetime | None = None, end: datetime | None = None, date_column: str | None = None) -> DataFrame:
    """Candle records of a time range, both ends included, with their symbols.

    ``end`` defaults to the last window, ``start`` to a day before. ``date_column`` names a partition column of dates:
    the range is then also put on it, so that partitions are pruned.
    """
    if end or start or date_column:
        end = end or as_of(records, "window_start")
        start = start or end - timedelta(days=1)
        check_range(start, end)
        rows = records.where(F.col("window_start").between(timestamp(start), timestamp(end)))
    else:
        # The last window comes from the same aggregation as the rows, as one row beside them.
        last = F.broadcast(records.agg(F.max("window_start").alias("__end")))
        rows = records.join(last).where(F.col("window_start").between(F.col("__end") - F.expr("INTERVAL '1' DAY"), F.col("__end"))).drop("__end")
    if date_column:
        rows = rows.where(F.col(date_column).between(F.lit(start.date()), F.lit(end.date())))
    names = dimension.select("crypto_id", "symbol")
    if symbols:
        names = names.where(F.upper("symbol").isin([s.upper() for s in symbols]))
    return rows.join(names, "crypto_id")


def candle_history(records: DataFrame, dimension: DataFrame, symbols: list[str] | None = None, start: datetime | None = None, end: datetime | None = None, descending: bool = True, limit: int = 100, offset: int = 0, date_column: str | None = None) -> DataFrame:
    """One page of the candle records of a time range, as ``history_rows`` gives them, by time and symbol."""
    time = F.desc("window_start") if descending else F.asc("window_start")
    return page(history_rows(records, dimension, symbols, start, end, date_column), [time, F.asc("symbol")], limit, offset)


def recent_alerts(alerts: DataFrame, dimension: DataFrame, hours: int = 24, limit: int = 20, end: datetime | None = None) -> DataFrame:
    """Latest alerts of the last hours, newest first."""
    if not 1 <= hours <= MOST_HOURS or not 1 <= limit <= MOST_ALERTS:
        raise ValueError("hours must be 1 to 168 and limit 1 to 100")
    end = end or as_of(alerts, "window_start")
    rows = alerts.where(F.col("window_start") >= timestamp(end - timedelta(hours=hours))).join(dimension.select("symbol", "crypto_id"), "symbol")
    return rows.orderBy(F.desc("window_start"), "symbol").limit(limit)


def latest_ticks(ticks: DataFrame, dimension: DataFrame) -> DataFrame:
    """Last tick of every active symbol; the dimension meets one row of each symbol, not its ticks."""
    active = dimension.where("is_active").select("symbol", "crypto_id")
    return latest_by(ticks, "symbol", ["ts", "tick_id"]).join(active, "symbol")


def latest_prices(candles: DataFrame, end: datetime) -> DataFrame:
    """Each symbol's last candle as shown: price, change, and the data's age in whole seconds."""
    last = latest_by(candles, "symbol", ["window_start"])
    age = F.expr("timestampdiff(SECOND, window_end, end)")
    change = F.round(percent_change(F.col("close"), F.col("open")), 6)
    return last.withColumn("end", timestamp(end)).select("symbol", F.col("close").alias("price"), change.alias("change_pct"), F.coalesce("volume_sum", F.lit(0)).cast("decimal(38,2)").alias("volume"), "window_end", F.greatest(age, F.lit(0)).cast("long").alias("age_seconds"))


def movers(changes: DataFrame, by: str = "abs", limit: int = 10) -> DataFrame:
    """Symbols with the largest change: ``abs`` by size, ``gainers`` upwards, ``losers`` downwards."""
    if not 1 <= limit <= MOST_MOVERS:
        raise ValueError("limit must be 1 to 50")
    order = {"abs": F.abs("change_pct").desc(), "gainers": F.desc("change_pct"), "losers": F.asc("change_pct")}[by]
    return changes.where("change_pct IS NOT NULL").orderBy(order, "symbol").limit(limit)


def live_ticker(mover_rows: DataFrame, live: DataFrame) -> DataFrame:
    """Movers and live symbols in one strip: the live price where there is one; movers first, then live ones by name."""
    m = mover_rows.select("symbol", F.col("price").alias("mover_price"), "change_pct")
    joined = m.join(live.select("symbol", F.col("close").alias("live_price")), "symbol", "full_outer")
    group = F.when(F.col("mover_price").isNull(), 1).otherwise(0)
    # All in one task: a row for each symbol, as many as the strip shows.
    place = F.row_number().over(Window.orderBy("part", F.desc_nulls_last(F.abs("change_pct")), "symbol"))
    return joined.withColumn("part", group).withColumn("place", place).select("place", "symbol", F.coalesce("live_price", "mover_price").alias("price"), "change_pct", F.col("live_price").isNotNull().alias("is_live"))


def tracked_match(listings: DataFrame, dimension: DataFrame, live: DataFrame) -> DataFrame:
    """Listings with the tracked symbol of their slug, if any, and the live price where there is one."""
    tracked = dimension.where("slug IS NOT NULL").select(F.col("slug").alias("id"), F.col("symbol").alias("tracked"))
    prices = live.select(F.col("symbol").alias("tracked"), F.col("close").alias("live_price"))
    out = listings.join(tracked, "id", "left").join(prices, "tracked", "left")
    return out.select("id", "tracked", F.coalesce("live_price", "current_price").alias("price"), F.col("live_price").isNotNull().alias("is_live"))


def compare_symbols(candles: DataFrame, symbols: list[str]) -> DataFrame:
    """Closes of some symbols side by side on one time axis."""
    return candles.where(F.col("symbol").isin(symbols)).groupBy("window_start").pivot("symbol", symbols).agg(F.max("close"))


def screener(listings: DataFrame, page_number: int = 1, page_size: int = 10) -> DataFrame:
    """A page of listings by capitalisation, with rank and whether a next page may follow."""
    first = (max(1, page_number) - 1) * page_size
    ordered = [F.desc_nulls_last("market_cap"), F.asc("symbol")]
    rows = listings.orderBy(*ordered).limit(first + page_size)  # ranks are needed for these rows only
    ranked = rows.withColumn("rank", F.row_number().over(Window.orderBy(*ordered))).where(F.col("rank") > first)
    return ranked.withColumn("has_next", F.count(F.lit(1)).over(Window.partitionBy()) == page_size)


def screener_table(ticks: DataFrame, candles: DataFrame, page_number: int = 1, page_size: int = 10) -> DataFrame:
    """The screener's page as shown: rank, price, change over 1 h, 24 h and 7 d, capitalisation, volume, and the closes of
    the last 7 days as a line's points. Only ticks and candles of the page's symbols are read for these."""
    latest = latest_by(ticks.select("symbol", "price_usd", "market_cap", "volume_24h", "ts", "tick_id"), "symbol", ["ts", "tick_id"])
    rows = screener(latest, page_number, page_size)
    near = ticks.select("symbol", "price_usd", "ts", "tick_id").join(rows.select("symbol", F.col("ts").alias("end")), "symbol")
    near = near.where(F.col("ts") >= F.col("end") - F.expr("INTERVAL '7' DAY"))
    spans = {"1h": "INTERVAL '1' HOUR", "24h": "INTERVAL '1' DAY", "7d": "INTERVAL '7' DAY"}
    first = {k: F.min_by("price_usd", F.when(F.col("ts") >= F.col("end") - F.expr(v), F.struct("ts", "tick_id"))) for k, v in spans.items()}
    bases = near.groupBy("symbol").agg(*[v.alias(f"base_{k}") for k, v in first.items()])
    series = recent_series(candles.join(rows.select("symbol"), "symbol", "left_semi"), 7 * 24).withColumnRenamed("prices", "sparkline")
    out = rows.join(bases, "symbol", "left").join(series, "symbol", "left")
    changes = [F.round(percent_change(F.col("price_usd"), F.col(f"base_{k}")), 6).alias(f"change_{k}") for k in spans]
    return out.select("rank", "symbol", F.col("price_usd").alias("price"), *changes, "market_cap", F.col("volume_24h").alias("volume"), "sparkline", "has_next")


def market_report(latest: DataFrame, end: datetime) -> DataFrame:
    """Each symbol's numbers as text."""
    pct, price = F.col("change_pct"), F.col("price").cast("double")
    return latest.select(
        "symbol", price_text(price).alias("price"), adaptive_price_text(F.col("price")).alias("adaptive_price"), signed_percent_text(pct).alias("change"), signed_percent_text(pct, sign_zero=False).alias("web_change"), amount_text(F.col("volume")).alias("volume"),
        amount_text(F.col("market_cap"), trillions=True).alias("market_cap"), count_text(F.col("volume").cast("long")).alias("volume_count"), title_words(trend_class(pct)).alias("trend"), relative_age(F.col("age_seconds")).alias("age"), clock_text(F.col("window_end")).alias("clock"),
    )


def live_tail_merge(history: DataFrame, live: DataFrame) -> DataFrame:
    """History with live rows: a live row replaces history of the same symbol and time, else it is added."""
    both = history.withColumn("is_live", F.lit(False)).unionByName(live.withColumn("is_live", F.lit(True)))
    return latest_by(both, ["symbol", "window_start"], ["is_live"])


def last_minutes(candles: DataFrame, minutes: int, end: datetime) -> DataFrame:
    """Candles of the last minutes as chart series: short names, doubles, in time order."""
    rows = candles.where(F.col("window_start") > timestamp(end - timedelta(minutes=minutes)))
    numbers = {short: F.expr(f"try_cast({long} AS double)") for short, long in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("v", "volume_sum"))}
    return rows.select("symbol", F.col("window_start").alias("time"), *(v.alias(k) for k, v in numbers.items())).orderBy("symbol", "time")
