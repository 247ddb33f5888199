"""Arrays, maps and JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.sources.schemas import (
    CATEGORY_JSON,
    COIN_JSON,
    FRAME_JSON,
    FRAME_TYPES,
    GLOBAL_JSON,
    LISTING_JSON,
    SNAPSHOT_JSON,
    TRENDING_JSON,
)
from tickframe.sources.ticks import message_id


def snapshot_flatten(snapshots: DataFrame, dimension: DataFrame) -> DataFrame:
    """A tick per tracked symbol and snapshot (ts, payload); a coin the payload lacks has a null price."""
    coins = dimension.select(F.coalesce("slug", F.lower("symbol")).alias("coin_id"), "symbol")
    numbers = snapshots.select("ts", F.from_json("payload", SNAPSHOT_JSON).alias("coins"))
    rows = numbers.crossJoin(coins).withColumn("n", F.try_element_at("coins", F.col("coin_id")))  # every snapshot carries all tracked symbols
    return rows.select("symbol", "coin_id", "ts", F.col("n.usd").alias("price_usd"), F.col("n.usd_24h_vol").alias("volume_24h"), message_id(F.col("symbol"), "ts").alias("message_id"))


def ohlc_tuple_rows(payloads: DataFrame) -> DataFrame:
    """[ms, open, high, low, close] arrays to rows; milliseconds to whole seconds by floor."""
    rows = payloads.select("symbol", F.explode(F.from_json("payload", "array<array<double>>")).alias("t"))
    return rows.select("symbol", F.floor(F.get("t", 0) / 1000).alias("time"), *(F.get("t", i).alias(name) for i, name in enumerate(("open", "high", "low", "close"), 1)))


def sparkline_points(series: DataFrame, width: float = 100.0, height: float = 30.0) -> DataFrame:
    """Points of a line drawn from an ``array<double>`` column ``prices``, y downwards; fewer than two values give none."""
    n = F.size("prices")
    low, high = F.array_min("prices"), F.array_max("prices")
    span = F.when(high == low, 1.0).otherwise(high - low)
    x = lambda i: F.round(i * width / (n - 1), 4)
    y = lambda v: F.round(height - (v - low) / span * height, 4)
    points = F.when(n >= 2, F.transform("prices", lambda v, i: F.struct(x(i).alias("x"), y(v).alias("y")))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
    rising = F.when(n >= 1, F.element_at("prices", -1) >= F.get("prices", 0))
    return series.select("symbol", points.alias("points"), rising.alias("rising"))


def recent_series(candles: DataFrame, most: int) -> DataFrame:
    """The last ``most`` closes of each symbol as one array in time order."""
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("window_start")))
    last = candles.withColumn("rank", rank).where(F.col("rank") <= most)
    ordered = F.sort_array(F.collect_list(F.struct("window_start", F.col("close").cast("double").alias("close"))))
    return last.groupBy("symbol").agg(F.transform(ordered, lambda s: s["close"]).alias("prices"))


def convert_amounts(holdings: DataFrame, rates: Column) -> DataFrame:
    """Holdings (id, amount) in every currency of a rate map; a missing rate counts as 0."""
    pairs = holdings.select("id", "amount", rates.alias("rates")).select("id", "amount", "rates", F.explode(F.map_keys("rates")).alias("currency"))
    rate = F.coalesce(F.try_element_at("rates", F.col("currency")), F.lit(0.0))
    return pairs.select("id", "currency", F.round(F.col("amount") * rate, 4).alias("converted"))


def frame_decode(raw: DataFrame) -> DataFrame:
    """Pushed frames (value) by their type; broken and unknown ones go, price frames need a numeric close."""
    frames = raw.select(F.from_json("value", FRAME_JSON).alias("f")).select("f.*")
    known = frames.where(F.col("type").isin(FRAME_TYPES))
    return known.where((F.col("type") != "price_update") | F.col("data.close").isNotNull()).select("type", "symbol", F.col("data.close").alias("close"), F.col("data.eventCount").alias("event_count"))


def listing_scan(raw: DataFrame) -> DataFrame:
    """Market listings from JSON (value); the first homepage, and zero for missing numbers."""
    rows = raw.select(F.from_json("value", LISTING_JSON).alias("l")).select("l.*")
    return rows.select("id", "symbol", F.coalesce("current_price", F.lit(0.0)).alias("current_price"), F.coalesce("market_cap", F.lit(0.0)).alias("market_cap"), F.get("links.homepage", 0).alias("homepage"), F.size(F.coalesce("categories", F.array().cast("array<string>"))).alias("n_categories"))


def category_scan(raw: DataFrame) -> DataFrame:
    """Categories from JSON (value), with their first member; missing numbers are zero."""
    rows = raw.select(F.from_json("value", CATEGORY_JSON).alias("c")).select("c.*")
    numbers = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("market_cap", "market_cap_change_24h", "volume_24h")]
    return rows.select("id", "name", *numbers, F.get("top_3_coins", 0).alias("top_coin"), F.size(F.coalesce("top_3_coins", F.array().cast("array<string>"))).alias("n_top"))


def coin_detail_scan(raw: DataFrame, currency: str = "usd") -> DataFrame:
    """Coin details from JSON (value) in one currency; what a currency map lacks is null."""
    rows = raw.select(F.from_json("value", COIN_JSON).alias("c")).select("c.*")
    of = lambda name: F.try_element_at(f"market_data.{name}", F.lit(currency))
    return rows.select(
        "id", "symbol", "name", "market_cap_rank", of("current_price").alias("price"), of("price_change_percentage_24h_in_currency").alias("change_24h"), of("market_cap").alias("market_cap"),
        of("total_volume").alias("volume"), F.get("links.homepage", 0).alias("homepage"), F.coalesce("description.en", F.lit("")).alias("description"),
    )


def trending_scan(raw: DataFrame) -> DataFrame:
    """Trending coins from JSON (value), one row each, in their order."""
    rows = raw.select(F.posexplode(F.from_json("value", TRENDING_JSON)["coins"]).alias("pos", "coin")).select("pos", "coin.item.*")
    return rows.select("pos", "id", "symbol", "market_cap_rank", F.col("data.price").alias("price"), F.col("data.price_change_percentage_24h.usd").alias("change_24h"))


def global_scan(raw: DataFrame) -> DataFrame:
    """The global payload from JSON (value): a row for each coin's share, with the totals in USD and the counts."""
    rows = raw.select(F.from_json("value", GLOBAL_JSON)["data"].alias("d")).select("d.*")
    usd = lambda name: F.try_element_at(name, F.lit("usd"))
    totals = [usd("total_market_cap").alias("total_cap"), usd("total_volume").alias("total_volume"), "active_cryptocurrencies", "markets"]
    return rows.select(F.explode("market_cap_percentage").alias("symbol", "dominance_pct"), *totals)


def top_venues(listings: DataFrame, most: int = 10) -> DataFrame:
    """Per coin the venues with the largest USD notional, missing numbers as 0. Listings (id, tickers)."""
    rows = listings.select("id", F.explode("tickers").alias("t"))
    usd = F.coalesce(F.try_element_at("t.converted_last", F.lit("usd")), F.lit(0.0))
    notional = F.round(usd * F.coalesce("t.volume", F.lit(0.0)), 4)
    ranked = rows.select("id", F.col("t.market").alias("market"), notional.alias("notional")).withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("notional"), "market")))
    return ranked.where(F.col("place") <= most)


def trending_slice(payloads: DataFrame, most: int = 6) -> DataFrame:
    """The first items of an ordered list per row (key, items), in their order."""
    return payloads.select("key", F.posexplode("items").alias("pos", "item")).where(F.col("pos") < most)
