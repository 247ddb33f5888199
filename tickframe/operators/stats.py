"""Aggregations over ticks and candles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickframe.functions.scalars import percent_change, typical_price
from tickframe.operators.lineage import checkpointed


def _double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def range_stats(candles: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Low, high, mean typical price, volume, count, range, range percent and volatility (range over mean) in percent."""
    typical = typical_price(*(F.col(c) for c in ("open", "high", "low", "close")))
    stats = candles.withColumn("typical", typical).groupBy(*(keys or [])).agg(
        F.min("low").alias("min_low"), F.max("high").alias("max_high"), F.avg(_double("typical")).alias("mean"), F.sum("volume_sum").cast("decimal(38,2)").alias("total_volume"), F.count(F.lit(1)).alias("candles"),
    )
    spread = F.col("max_high") - F.col("min_low")
    return stats.select(
        *(keys or []), "min_low", "max_high", F.round("mean", 6).alias("avg_price"), "total_volume", "candles", spread.cast("decimal(20,8)").alias("price_range"),
        F.round(F.when(F.col("min_low") > 0, _double(spread) / _double("min_low") * 100).otherwise(0.0), 6).alias("price_change_pct"),
        F.round(F.when(F.col("mean") > 0, _double(spread) / F.col("mean") * 100).otherwise(0.0), 6).alias("volatility_pct"),
    )


#: Ranges into which a round of the median counts each key's values.
MEDIAN_RANGES = 4096


def median_bounds(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key the bounds of its values and the places of the lower and upper middle among them."""
    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.floor((n - 1) / 2).alias("lower"), F.floor(n / 2).alias("upper"))


def median_ranges(rows: DataFrame, bounds: DataFrame, keys: list[str], value: str, ranges: int) -> DataFrame:
    """Values between the bounds counted in at most ``ranges`` ranges per key: range, n, first, last; and the places sought."""
    renamed = bounds.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col(value).between(F.col("low"), F.col("high"))])
    share = (F.col(value) - F.col("low")).cast("double") / (F.col("high") - F.col("low")).cast("double")
    inside = rows.join(renamed, same).withColumn("range", F.least(F.floor(share * ranges), F.lit(ranges - 1)))
    return inside.groupBy(*keys, "range").agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("first"), F.max(value).alias("last"), F.max("lower").alias("lower"), F.max("upper").alias("upper"))


def exact_median(rows: DataFrame, keys: list[str], value: str, ranges: int = MEDIAN_RANGES) -> DataFrame:
    """The exact median of the decimals or finite numbers ``value`` per key, as ``median``; nulls do not count.

    Selection by narrowing: each round counts a key's values in ``ranges`` equal ranges between its bounds, and keeps the
    range with the middle, whose first and last values are the next bounds. A key is done when its bounds meet, or when its
    two middles lie in two ranges, as the end of one and the start of the other. Each round is a pass over the rows with
    partial sums and a job; it divides the bounds by ``ranges``, so prices of 20 digits take six rounds at most. A task gets
    at most ``ranges`` rows of a key from each task before it, never its values.
    """
    rows = rows.where(F.col(value).isNotNull()).select(*keys, value)
    bounds, done = checkpointed(median_bounds(rows, keys, value)), []
    while True:
        done.append(bounds.where("low = high").select(*keys, F.col("low").cast("double").alias("median")))
        bounds = bounds.where("low < high")
        if bounds.isEmpty():
            return reduce(DataFrame.unionByName, done)
        counted = median_ranges(rows, bounds, keys, value, ranges)
        before = F.sum("n").over(Window.partitionBy(*keys).orderBy("range")) - F.col("n")
        middle = counted.withColumn("before", before).where("before <= upper AND before + n > lower")
        # One range holds both middles, or one holds each.
        found = checkpointed(middle.groupBy(*keys).agg(F.min("last").alias("end"), F.max("first").alias("start"), F.min("first").alias("low"), F.max("last").alias("high"), F.max(F.col("lower") - F.col("before")).alias("lower"), F.min(F.col("upper") - F.col("before")).alias("upper"), F.count(F.lit(1)).alias("held")))
        done.append(found.where("held = 2").select(*keys, ((F.col("end").cast("double") + F.col("start").cast("double")) / 2).alias("median")))
        bounds = found.where("held = 1").select(*bounds.columns)


def price_stats(ticks: DataFrame, dimension: DataFrame, since: Column) -> DataFrame:
    """Ticks of active symbols since a time: count, low, high, mean, exact median, sample deviation."""
    active = checkpointed(dimension.where("is_active").select("symbol", "crypto_id"))
    price = _double("price_usd")
    rows, keys = ticks.where(F.col("ts") >= since).join(active, "symbol"), ["crypto_id", "symbol"]
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("price_usd").alias("min_price"), F.max("price_usd").alias("max_price"), F.round(F.avg(price), 6).alias("avg_price"),
        F.round(F.stddev_samp(price), 6).alias("stddev_price"),
    )
    return stats.join(exact_median(rows, keys, "price_usd"), keys, "left").withColumn("median_price", F.round("median", 6)).drop("median")


def alert_summary(alerts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Alerts in all, spikes and drops."""
    return alerts.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("alert_type") == "PRICE_SPIKE").alias("spikes"), F.count_if(F.col("alert_type") == "PRICE_DROP").alias("drops"))


def market_global(latest: DataFrame) -> DataFrame:
    """Each symbol's share of the market's capitalisation, with the market's totals: capitalisation, volume, symbols, those
    with volume, and markets. ``latest`` has a row for each symbol, with the market that it traded on last."""
    cap = _double("market_cap")
    totals = latest.agg(
        F.sum(cap).alias("all_caps"), F.sum("market_cap").cast("decimal(38,2)").alias("total_cap"), F.sum("volume_24h").cast("decimal(38,2)").alias("total_volume"),
        F.count(F.lit(1)).alias("symbols"), F.count_if(F.col("volume_24h") > 0).alias("active_symbols"), F.count_distinct("market").alias("markets"),
    )
    joined = latest.join(F.broadcast(totals))  # one row
    return joined.select("symbol", "market_cap", F.round(cap / F.col("all_caps") * 100, 6).alias("dominance_pct"), "total_cap", "total_volume", "symbols", "active_symbols", "markets")


def category_stats(listings: DataFrame, top: int = 3) -> DataFrame:
    """Per category: capitalisation and its change in percent, volume and the ``top`` members by capitalisation.

    Listings (category, symbol, market_cap, previous_cap, volume), where previous_cap is the capitalisation a day before;
    members are ranked before they are collected, so that no group is gathered whole.
    """
    amounts = [F.sum(c).cast("decimal(38,2)").alias(c) for c in ("market_cap", "previous_cap", "volume")]
    totals = listings.groupBy("category").agg(*amounts, F.count(F.lit(1)).alias("members"))
    change = F.round(percent_change(F.col("market_cap"), F.col("previous_cap")), 6)
    totals = totals.withColumn("cap_change_24h_pct", change)
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc_nulls_last("market_cap"), "symbol"))
    best = listings.withColumn("rank", rank).where(F.col("rank") <= top).groupBy("category").agg(F.sort_array(F.collect_list(F.struct("rank", "symbol"))).alias("best"))
    return totals.join(best, "category").select("category", "market_cap", "cap_change_24h_pct", "volume", "members", F.array_join(F.transform("best", lambda s: s["symbol"]), ",").alias("top_members"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()])


def ingest_progress(ticks: DataFrame, topic: str, group: str) -> DataFrame:
    """Last offset and time of each partition."""
    last = ticks.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("last_offset"), F.max("ts").alias("last_timestamp"))
    return last.select(F.lit(topic).alias("topic_name"), F.col("kafka_partition").alias("partition_id"), "last_offset", "last_timestamp", F.lit(group).alias("consumer_group"))


def window_avg(ticks: DataFrame, width: str) -> DataFrame:
    """Mean price per symbol and window."""
    means = ticks.groupBy("symbol", F.window("ts", width).alias("w")).agg(F.round(F.avg(_double("price_usd")), 6).alias("avg_price"))
    return means.select("symbol", F.col("w.start").alias("window_start"), "avg_price")


def symbol_coverage(dimension: DataFrame, latest: DataFrame) -> DataFrame:
    """Every symbol with whether it has a latest state, and the hit rate in percent."""
    state = latest.select("symbol", F.lit(True).alias("hit"))
    joined = dimension.join(state, "symbol", "left").select("symbol", F.coalesce("hit", F.lit(False)).alias("hit"))
    rate = joined.agg(F.round(F.avg(F.col("hit").cast("double")) * 100, 1).alias("hit_rate_pct"))
    return joined.join(F.broadcast(rate))  # one row


def is_produced() -> Column:
    """Whether a decoded message is a tick that a producer would send."""
    return F.coalesce(F.expr("coalesce(symbol, '') <> '' AND price_usd > 0"), F.lit(False))


def counters() -> list[Column]:
    """Messages produced and errors, as aggregates."""
    return [F.count_if(is_produced()).alias("produced"), F.count_if(~is_produced()).alias("errors")]


def observed(decoded: DataFrame) -> tuple[DataFrame, Observation]:
    """Decoded messages, and their counters as an observation: it is filled by the first action on them, as a write, so
    that counting takes no pass of its own. ``observation.get`` then has ``produced`` and ``errors``."""
    watch = Observation("run_counters")
    return decoded.observe(watch, *counters()), watch


def run_counters(decoded: DataFrame, coverage: DataFrame) -> DataFrame:
    """A run in one row: messages produced, errors, and of the symbols asked for the hits, misses and hit rate in percent."""
    runs = decoded.agg(*counters())
    hits = coverage.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.max("hit_rate_pct").alias("hit_rate_pct"))
    return runs.join(F.broadcast(hits))  # one row
