"""Queries over listings, holdings and nested payloads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.operators import market, nested, ohlc, stats, windows
from tickframe.plans.base import DIMENSION, LAST, LINE_TICKS, LISTINGS, TICKS, VALID, candles, pct, query, sql
from tickframe.plans.candles import hourly
from tickframe.sources.schemas import LISTING_JSON
from tickframe.sources.ticks import event_ticks, lineitem_ticks, symbol_dimension, table

#: Sample conversion rates per US dollar.
RATES = {"usd": 1.0, "eur": 0.92, "jpy": 151.5}


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category, symbol, market_cap and volume of every part sold."""
    return _listings(spark, sf_dir).drop("previous_cap")


def _listings(spark: SparkSession, sf_dir: str, before: datetime | None = None) -> DataFrame:
    """Listings with previous_cap, the capitalisation of what was shipped up to ``before``."""
    cap = F.col("l_extendedprice").cast("decimal(20,2)")
    earlier = F.when(F.col("l_shipdate") <= market.timestamp(before), cap) if before else F.lit(None).cast("decimal(20,2)")
    sums = [F.sum(v).cast("decimal(38,2)").alias(k) for k, v in (("market_cap", cap), ("previous_cap", earlier), ("volume", F.col("l_quantity").cast("decimal(20,2)")))]
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(*sums)
    joined = lines.join(table(spark, sf_dir, "part"), "p_partkey")
    return joined.select(F.col("p_brand").alias("category"), F.concat(F.lit("p"), "p_partkey").alias("symbol"), "market_cap", "previous_cap", "volume")


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = market.as_of(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return stats.category_stats(_listings(spark, sf_dir, last - timedelta(days=1)))


_LATEST = "x AS (SELECT symbol, CAST(price * 1000000 AS DECIMAL(20,2)) AS market_cap, vol, ts, id, price FROM v QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, id DESC) = 1)"
_GLOBAL = """gl AS (SELECT symbol, market_cap, round(CAST(market_cap AS DOUBLE) / sum(CAST(market_cap AS DOUBLE)) OVER () * 100, 6) AS dominance_pct, CAST(sum(market_cap) OVER () AS DECIMAL(38,2)) AS total_cap,
       CAST(sum(vol) OVER () AS DECIMAL(38,2)) AS total_volume, count(*) OVER () AS symbols, count(*) FILTER (vol > 0) OVER () AS active_symbols, (SELECT count(DISTINCT id % 4) FROM x) AS markets FROM x)"""


@query("market_global", sql(TICKS, VALID, _LATEST, _GLOBAL, select="SELECT * FROM gl"))
def market_global(spark, sf_dir):
    ticks = ohlc.valid_ticks(event_ticks(spark, sf_dir)).select("symbol", "market_cap", "volume_24h", "ts", "tick_id", F.col("kafka_partition").alias("market"))
    return stats.market_global(windows.latest_by(ticks, "symbol", ["ts", "tick_id"]))


_CATEGORIES = (
    "li2 AS (SELECT p_brand AS category, 'p' || p_partkey AS symbol, sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS market_cap, sum(CAST(l_extendedprice AS DECIMAL(20,2))) FILTER (l_shipdate <= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL '1 day') AS previous_cap, "
    "sum(CAST(l_quantity AS DECIMAL(20,2))) AS volume FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_partkey)",
    "k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY market_cap DESC NULLS LAST, symbol) AS n FROM li2)",
    f"ca AS (SELECT category, CAST(sum(market_cap) AS DECIMAL(38,2)) AS market_cap, round({pct('sum(market_cap)', 'sum(previous_cap)')}, 6) AS cap_change_24h_pct, CAST(sum(volume) AS DECIMAL(38,2)) AS volume, count(*) AS members, string_agg(symbol, ',' ORDER BY n) FILTER (n <= 3) AS top_members FROM k GROUP BY 1)",
)


@query("category_stats", sql(*_CATEGORIES, select="SELECT * FROM ca"))
def category_stats(spark, sf_dir):
    return _categories(spark, sf_dir)


@query("top_categories", sql(LISTINGS, select="SELECT category, CAST(sum(market_cap) AS DECIMAL(38,2)) AS market_cap FROM li GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"))
def top_categories(spark, sf_dir):
    return stats.category_stats(_listings(spark, sf_dir)).orderBy(F.desc("market_cap"), "category").limit(8).select("category", "market_cap")


@query("market_screener", sql(LISTINGS, select="SELECT *, CAST(row_number() OVER (ORDER BY market_cap DESC NULLS LAST, symbol) AS INTEGER) AS rank, true AS has_next FROM li ORDER BY rank LIMIT 10 OFFSET 10"))
def market_screener(spark, sf_dir):
    return market.screener(listings(spark, sf_dir), page_number=2)


_BASES = "b AS (SELECT v.symbol, " + ", ".join(f"arg_min(v.price, (v.ts, v.id)) FILTER (v.ts >= x.ts - INTERVAL '{i}') AS b_{k}" for k, i in (("1h", "1 hour"), ("24h", "1 day"), ("7d", "7 days"))) + " FROM v JOIN x USING (symbol) GROUP BY v.symbol)"
_LINE = "sl AS (SELECT symbol, string_agg(printf('%.2f', CAST(close AS DOUBLE)), ',' ORDER BY window_start) AS sparkline FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS back FROM c) WHERE back <= 168 GROUP BY symbol)"


@query("screener_table", sql(TICKS, VALID, candles("1 hour"), _LATEST, _BASES, _LINE, select=f"""
SELECT CAST(row_number() OVER (ORDER BY market_cap DESC NULLS LAST, symbol) AS INTEGER) AS rank, symbol, price, round({pct("price", "b_1h")}, 6) AS change_1h, round({pct("price", "b_24h")}, 6) AS change_24h,
       round({pct("price", "b_7d")}, 6) AS change_7d, market_cap, vol AS volume, sparkline, false AS has_next FROM x JOIN b USING (symbol) JOIN sl USING (symbol)"""))
def screener_table(spark, sf_dir):
    ticks = ohlc.valid_ticks(event_ticks(spark, sf_dir))
    shown = market.screener_table(ticks, ohlc.ohlc(ticks, "1 hour"))
    return shown.withColumn("sparkline", F.array_join(F.transform("sparkline", lambda v: F.format_string("%.2f", v)), ","))


_CHANGES = f"g AS (SELECT symbol, close AS price, round({pct('close', 'open')}, 6) AS change_pct FROM l)"


def _changes(spark, sf_dir) -> DataFrame:
    last = windows.latest_by(ohlc.ohlc(ohlc.valid_ticks(lineitem_ticks(spark, sf_dir)), "365 days"), "symbol", ["window_start"])
    return last.select("symbol", F.col("close").alias("price"), F.round((F.col("close").cast("double") - F.col("open").cast("double")) / F.col("open").cast("double") * 100, 6).alias("change_pct"))


def _mover_query(by: str, order: str) -> None:
    @query(f"movers_{by}", sql(LINE_TICKS, candles("365 days"), LAST, _CHANGES, select=f"SELECT * FROM g WHERE change_pct IS NOT NULL ORDER BY {order}, symbol LIMIT 10"))
    def run(spark, sf_dir):
        return market.movers(_changes(spark, sf_dir), by)


for _by, _order in (("abs", "abs(change_pct) DESC"), ("gainers", "change_pct DESC"), ("losers", "change_pct")):
    _mover_query(_by, _order)


_LIVE = "live AS (SELECT symbol, close FROM l WHERE symbol <> 'click'), mv AS (SELECT symbol, close AS price, round(" + pct("close", "open") + ", 6) AS change_pct FROM l WHERE symbol <> 'view')"


@query("live_ticker", sql(TICKS, VALID, candles("1 hour"), LAST, _LIVE, "j AS (SELECT coalesce(mv.symbol, live.symbol) AS symbol, coalesce(live.close, mv.price) AS price, change_pct, live.close IS NOT NULL AS is_live, CASE WHEN mv.symbol IS NULL THEN 1 ELSE 0 END AS part FROM mv FULL JOIN live ON mv.symbol = live.symbol)", select="SELECT CAST(row_number() OVER (ORDER BY part, abs(change_pct) DESC NULLS LAST, symbol) AS INTEGER) AS place, symbol, price, change_pct, is_live FROM j"))
def live_ticker(spark, sf_dir):
    last = windows.latest_by(hourly(spark, sf_dir), "symbol", ["window_start"])
    prices = market.latest_prices(last, market.as_of(last, "window_end"))
    return market.live_ticker(prices.where("symbol <> 'view'").select("symbol", "price", "change_pct"), last.where("symbol <> 'click'"))


@query("tracked_match", sql(TICKS, VALID, candles("1 hour"), LAST, DIMENSION, "i AS (SELECT DISTINCT symbol || '-coin' AS id FROM v UNION SELECT 'part-' || p_partkey FROM part)", select="SELECT id, d.symbol AS tracked, coalesce(close, CAST(1 AS DECIMAL(20,8))) AS price, close IS NOT NULL AS is_live FROM i LEFT JOIN d ON slug = id LEFT JOIN l ON l.symbol = d.symbol"))
def tracked_match(spark, sf_dir):
    ids = event_ticks(spark, sf_dir).where("symbol <> ''").select(F.concat("symbol", F.lit("-coin")).alias("id")).distinct().union(table(spark, sf_dir, "part").select(F.concat(F.lit("part-"), "p_partkey")))
    last = windows.latest_by(hourly(spark, sf_dir), "symbol", ["window_start"])
    return market.tracked_match(ids.withColumn("current_price", F.lit(1).cast("decimal(20,8)")), symbol_dimension(spark, sf_dir), last)


@query("symbol_coverage", sql(TICKS, VALID, DIMENSION, "s AS (SELECT symbol, symbol IN (SELECT symbol FROM v) AS hit FROM d)", select="SELECT symbol, hit, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) OVER () * 100, 1) AS hit_rate_pct FROM s"))
def symbol_coverage(spark, sf_dir):
    latest = windows.latest_by(ohlc.valid_ticks(event_ticks(spark, sf_dir)).select("symbol", "ts", "tick_id"), "symbol", ["ts", "tick_id"])
    return stats.symbol_coverage(symbol_dimension(spark, sf_dir), latest)


@query("convert_amounts", "SELECT c_custkey AS id, currency, round(c_acctbal * rate, 4) + 0.0 AS converted FROM customer, (VALUES ('usd', 1.0::DOUBLE), ('eur', 0.92::DOUBLE), ('jpy', 151.5::DOUBLE), ('xau', 0.0::DOUBLE)) AS r(currency, rate)")
def convert_amounts(spark, sf_dir):
    holdings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    rates = F.create_map(*[F.lit(x) for pair in RATES.items() for x in pair], F.lit("xau"), F.lit(None).cast("double"))
    return nested.convert_amounts(holdings, rates)


def _amount(value: str, trillions: bool) -> str:
    t = f"WHEN {value} >= 1e12 THEN printf('$%.2fT', {value} / 1e12) " if trillions else ""
    return f"CASE {t}WHEN {value} >= 1e9 THEN printf('$%.2fB', {value} / 1e9) WHEN {value} >= 1e6 THEN printf('$%.2fM', {value} / 1e6) WHEN {value} >= 1e3 THEN printf('$%.2fK', {value} / 1e3) ELSE printf('$%.2f', {value}) END"


_REPORT = f"o AS (SELECT symbol, window_end, CAST(close AS DOUBLE) AS p, round({pct('close', 'open')}, 2) AS ch, CAST(volume_sum AS DOUBLE) AS vo, CAST(close AS DOUBLE) * 1e7 AS cap, greatest(date_diff('second', window_end, (SELECT max(window_end) FROM c)), 0) AS s FROM l)"


@query("market_report", sql(TICKS, VALID, candles("1 hour"), LAST, _REPORT, select=f"SELECT symbol, '$' || format('{{:,.2f}}', p) AS price, CASE WHEN p >= 1000 THEN format('{{:,.2f}}', p) WHEN p >= 1 THEN format('{{:,.4f}}', p) ELSE format('{{:,.6f}}', p) END AS adaptive_price, printf('%+.2f%%', ch) AS change, CASE WHEN ch = 0 THEN '0.00%' ELSE printf('%+.2f%%', ch) END AS web_change, {_amount('vo', False)} AS volume, {_amount('cap', True)} AS market_cap, format('{{:,}}', CAST(vo AS BIGINT)) AS volume_count, CASE WHEN ch > 2 THEN 'Strong Up' WHEN ch > 0 THEN 'Up' WHEN ch < -2 THEN 'Strong Down' WHEN ch < 0 THEN 'Down' ELSE 'Flat' END AS trend, CASE WHEN s < 60 THEN 'just now' WHEN s < 3600 THEN (s // 60) || ' min' WHEN s < 86400 THEN (s // 3600) || CASE WHEN s // 3600 = 1 THEN ' hour' ELSE ' hours' END END AS age, strftime(window_end, '%H:%M:%S') AS clock FROM o"))
def market_report(spark, sf_dir):
    candles_ = hourly(spark, sf_dir)
    end = market.as_of(candles_, "window_end")
    latest = market.latest_prices(candles_, end).withColumn("change_pct", F.round("change_pct", 2)).withColumn("market_cap", F.col("price").cast("double") * 1e7)
    return market.market_report(latest, end)


@query("snapshot_flatten", sql(TICKS, DIMENSION, select="SELECT d.symbol, coalesce(slug, lower(d.symbol)) AS coin_id, ts, CASE WHEN coalesce(slug, lower(d.symbol)) = t.symbol || '-coin' OR coalesce(slug, lower(d.symbol)) = t.symbol THEN price END AS price_usd, CASE WHEN coalesce(slug, lower(d.symbol)) = t.symbol || '-coin' OR coalesce(slug, lower(d.symbol)) = t.symbol THEN vol END AS volume_24h, d.symbol || '-' || CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS message_id FROM t, d"))
def snapshot_flatten(spark, sf_dir):
    numbers = F.struct(F.col("price_usd").alias("usd"), F.col("volume_24h").alias("usd_24h_vol"))
    payload = F.to_json(F.create_map(F.concat("symbol", F.lit("-coin")), numbers, F.col("symbol"), numbers))
    return nested.snapshot_flatten(event_ticks(spark, sf_dir).select("ts", payload.alias("payload")), symbol_dimension(spark, sf_dir))


@query("ohlc_tuple_rows", sql(TICKS, VALID, candles("1 hour"), select="SELECT symbol, CAST(epoch(window_start) AS BIGINT) AS time, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close FROM c"))
def ohlc_tuple_rows(spark, sf_dir):
    candles_ = hourly(spark, sf_dir)
    ms = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', window_start)") * 1000 + 999
    row = F.array(ms.cast("double"), *(F.col(c).cast("double") for c in ("open", "high", "low", "close")))
    return nested.ohlc_tuple_rows(candles_.groupBy("symbol", F.to_date("window_start").alias("day")).agg(F.to_json(F.collect_list(row)).alias("payload")))


_SPARK = "q AS (SELECT symbol, CAST(close AS DOUBLE) AS v, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS back FROM c), s AS (SELECT symbol, v, back, row_number() OVER (PARTITION BY symbol ORDER BY back DESC) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n, min(v) OVER (PARTITION BY symbol) AS lo, max(v) OVER (PARTITION BY symbol) AS hi FROM q WHERE back <= 168)"


@query("sparkline_points", sql(TICKS, VALID, candles("1 hour"), _SPARK, select="SELECT symbol, i, round(i * 100.0::DOUBLE / (n - 1), 4) AS x, round(30 - (v - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END * 30, 4) AS y, last_value(v) OVER w >= first_value(v) OVER w AS rising FROM s WHERE n >= 2 WINDOW w AS (PARTITION BY symbol ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"))
def sparkline_points(spark, sf_dir):
    drawn = nested.sparkline_points(nested.recent_series(hourly(spark, sf_dir), 168))
    return drawn.select("symbol", "rising", F.posexplode("points").alias("i", "p")).select("symbol", F.col("i").cast("long"), "p.x", "p.y", "rising")


@query("frame_decode", sql(TICKS, VALID, candles("1 hour"), select="SELECT CASE WHEN event_count = 1 THEN 'keepalive' ELSE 'price_update' END AS type, symbol, close, CAST(event_count AS INTEGER) AS event_count FROM c WHERE event_count = 1 OR event_count % 2 = 0"))
def frame_decode(spark, sf_dir):
    # One-tick candles come as keep-alives; frames of odd counts are unknown, broken or lack a close.
    n = F.col("event_count")
    kind = F.when(n == 1, "keepalive").when(n % 4 == 3, "gossip").otherwise("price_update")
    data = F.struct(F.when((n == 1) | (n % 2 == 0), F.col("close")).alias("close"), n.alias("eventCount"))
    value = F.when(n % 4 == 1, F.when(n == 1, F.to_json(F.struct(kind.alias("type"), "symbol", data.alias("data")))).otherwise(F.lit("{oops"))).otherwise(F.to_json(F.struct(kind.alias("type"), "symbol", data.alias("data"))))
    return nested.frame_decode(hourly(spark, sf_dir).select(value.alias("value")))


def _listing_json(spark, sf_dir) -> DataFrame:
    rows = listings(spark, sf_dir)
    tickers = F.array(*[F.struct(F.concat(F.lit(f"venue{i}-"), "category").alias("market"), (F.col("volume").cast("double") / i).alias("volume"), F.create_map(F.lit("usd" if i % 5 else "eur"), F.lit(float(i))).alias("converted_last")) for i in range(1, 13)])
    body = F.struct(
        F.col("symbol").alias("id"), "symbol", F.when(F.col("volume") > 300, F.col("volume").cast("double")).alias("current_price"), F.col("market_cap").cast("double").alias("market_cap"), F.array("category").alias("categories"),
        F.struct(F.when(F.col("volume") > 200, F.array(F.concat(F.lit("https://"), "symbol"), F.lit("x"))).alias("homepage")).alias("links"), tickers.alias("tickers"),
    )
    return rows.select(F.to_json(body).alias("value"))


@query("listing_scan", sql(LISTINGS, select="SELECT symbol AS id, symbol, CASE WHEN volume > 300 THEN CAST(volume AS DOUBLE) ELSE 0 END AS current_price, CAST(market_cap AS DOUBLE) AS market_cap, CASE WHEN volume > 200 THEN 'https://' || symbol END AS homepage, 1 AS n_categories FROM li"))
def listing_scan(spark, sf_dir):
    return nested.listing_scan(_listing_json(spark, sf_dir))


_CATEGORY_ROWS = "SELECT category AS id, 'Category ' || category AS name, CAST(market_cap AS DOUBLE) AS market_cap, coalesce(cap_change_24h_pct, 0.0) AS market_cap_change_24h, CASE WHEN members > 50 THEN CAST(volume AS DOUBLE) ELSE 0.0 END AS volume_24h, split_part(top_members, ',', 1) AS top_coin, CAST(least(members, 3) AS INTEGER) AS n_top FROM ca"


@query("category_scan", sql(*_CATEGORIES, select=_CATEGORY_ROWS))
def category_scan(spark, sf_dir):
    # Small categories come without a volume.
    rows = _categories(spark, sf_dir)
    body = F.struct(
        F.col("category").alias("id"), F.concat(F.lit("Category "), "category").alias("name"), F.col("market_cap").cast("double").alias("market_cap"), F.col("cap_change_24h_pct").alias("market_cap_change_24h"),
        F.split("top_members", ",").alias("top_3_coins"), F.when(F.col("members") > 50, F.col("volume").cast("double")).alias("volume_24h"), F.lit("2024-01-01T00:00:00Z").alias("updated_at"),
    )
    return nested.category_scan(rows.select(F.to_json(body).alias("value")))


@query("coin_detail_scan", sql(LISTINGS, select="""
SELECT symbol AS id, symbol, upper(symbol) AS name, CAST(NULL AS BIGINT) AS market_cap_rank, CASE WHEN volume > 300 THEN CAST(volume AS DOUBLE) END AS price, CAST(NULL AS DOUBLE) AS change_24h, CAST(market_cap AS DOUBLE) AS market_cap, CAST(volume AS DOUBLE) AS volume,
       CASE WHEN volume > 200 THEN 'https://' || symbol END AS homepage, CASE WHEN volume > 250 THEN 'of ' || category ELSE '' END AS description FROM li"""))
def coin_detail_scan(spark, sf_dir):
    volume = F.col("volume").cast("double")
    numbers = F.struct(
        F.when(volume > 300, F.create_map(F.lit("usd"), volume, F.lit("eur"), volume / 2)).otherwise(F.create_map(F.lit("eur"), volume)).alias("current_price"),
        F.create_map(F.lit("usd"), F.col("market_cap").cast("double")).alias("market_cap"), F.create_map(F.lit("usd"), volume).alias("total_volume"),
    )
    links = F.struct(F.when(volume > 200, F.array(F.concat(F.lit("https://"), "symbol"))).otherwise(F.array().cast("array<string>")).alias("homepage"))
    text = F.struct(F.when(volume > 250, F.concat(F.lit("of "), "category")).alias("en"))
    body = F.struct(F.col("symbol").alias("id"), "symbol", F.upper("symbol").alias("name"), numbers.alias("market_data"), links.alias("links"), text.alias("description"))
    return nested.coin_detail_scan(listings(spark, sf_dir).select(F.to_json(body).alias("value")))


@query("trending_scan", sql(LISTINGS, "k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY market_cap DESC, symbol) AS n FROM li)", select="""
SELECT CAST(n - 1 AS INTEGER) AS pos, symbol AS id, symbol, CAST(n AS BIGINT) AS market_cap_rank, CAST(volume AS DOUBLE) AS price, CASE WHEN n % 2 = 1 THEN CAST(n AS DOUBLE) / 4 END AS change_24h FROM k WHERE n <= 7"""))
def trending_scan(spark, sf_dir):
    rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("market_cap"), "symbol"))
    first = listings(spark, sf_dir).withColumn("n", rank).where("n <= 7")
    n = F.col("n")
    data = F.struct(F.col("volume").cast("double").alias("price"), F.when(n % 2 == 1, F.struct((n / 4).alias("usd"))).alias("price_change_percentage_24h"))
    item = F.struct(F.col("symbol").alias("id"), F.upper("symbol").alias("name"), "symbol", n.alias("market_cap_rank"), data.alias("data"))
    payloads = first.groupBy("category").agg(F.sort_array(F.collect_list(F.struct("n", item.alias("item")))).alias("coins"))
    coins = F.transform("coins", lambda c: F.struct(c["item"].alias("item")))
    return nested.trending_scan(payloads.select(F.to_json(F.struct(coins.alias("coins"))).alias("value")))


@query("global_scan", sql(TICKS, VALID, _LATEST, _GLOBAL, select="SELECT symbol, dominance_pct, CAST(total_cap AS DOUBLE) AS total_cap, CAST(total_volume AS DOUBLE) AS total_volume, active_symbols AS active_cryptocurrencies, markets FROM gl"))
def global_scan(spark, sf_dir):
    rows = market_global(spark, sf_dir)
    one = rows.groupBy("total_cap", "total_volume", "active_symbols", "markets").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "dominance_pct"))).alias("shares"))
    usd = lambda c: F.create_map(F.lit("usd"), F.col(c).cast("double"))
    data = F.struct(F.col("active_symbols").alias("active_cryptocurrencies"), "markets", usd("total_cap").alias("total_market_cap"), usd("total_volume").alias("total_volume"), F.col("shares").alias("market_cap_percentage"))
    return nested.global_scan(one.select(F.to_json(F.struct(data.alias("data"))).alias("value")))


@query("top_venues", sql(LISTINGS, "v AS (SELECT symbol AS id, 'venue' || i || '-' || category AS market, round(CASE WHEN i % 5 = 0 THEN 0 ELSE CAST(i AS DOUBLE) END * (CAST(volume AS DOUBLE) / i), 4) AS notional FROM li, generate_series(1, 12) AS s(i)), k AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY notional DESC, market) AS INTEGER) AS place FROM v)", select="SELECT * FROM k WHERE place <= 10"))
def top_venues(spark, sf_dir):
    decoded = _listing_json(spark, sf_dir).select(F.from_json("value", LISTING_JSON).alias("l")).select("l.id", "l.tickers")
    return nested.top_venues(decoded)


@query("trending_slice", sql(TICKS, "g AS (SELECT symbol AS key, CAST(ts AS DATE) AS day, id, row_number() OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts, id) - 1 AS pos FROM t)", select="SELECT key, CAST(pos AS INTEGER) AS pos, id AS item FROM g WHERE pos < 6"))
def trending_slice(spark, sf_dir):
    # Only the first six of a day are collected; Spark limits them in each task before it sorts a day.
    place = F.row_number().over(Window.partitionBy("symbol", "day").orderBy("ts", "tick_id"))
    first = event_ticks(spark, sf_dir).withColumn("day", F.to_date("ts")).withColumn("place", place).where("place <= 6")
    lists = first.groupBy(F.col("symbol").alias("key"), "day").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "tick_id"))), lambda s: s["tick_id"]).alias("items"))
    return nested.trending_slice(lists).drop("day")
