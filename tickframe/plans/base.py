"""Registration of queries with the SQL that checks them, and the SQL's shared parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return register


#: Named parts of oracle SQL.
TICKS = "t AS (SELECT event_type AS symbol, CAST(value AS DECIMAL(20,8)) AS price, CAST(json_extract_string(props, '$.k') AS DECIMAL(20,2)) AS vol, ts, event_id AS id FROM events)"
VALID = "v AS (SELECT * FROM t WHERE symbol <> '' AND price > 0 AND ts IS NOT NULL)"
LINE_TICKS = "v AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 100 // CAST(l_quantity AS BIGINT) AS DECIMAL(16,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(20,8)) AS price, CAST(l_quantity AS DECIMAL(20,2)) AS vol, l_shipdate AS ts, l_orderkey * 100 + l_linenumber AS id FROM lineitem WHERE l_quantity >= 1)"
DIMENSION = (
    "d AS (SELECT crypto_id, symbol, CASE WHEN crypto_id % 3 <> 0 THEN upper(substr(symbol, 1, 1)) || substr(symbol, 2) END AS name, CASE WHEN crypto_id % 2 <> 0 THEN symbol || '-coin' END AS slug, crypto_id % 4 <> 0 AS is_active "
    "FROM (SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) AS INTEGER) AS crypto_id FROM (SELECT event_type AS symbol FROM events WHERE event_type <> '' UNION SELECT 'ghost')))"
)
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def candles(width: str, name: str = "c", source: str = "v") -> str:
    return (
        f"{name} AS (SELECT symbol, time_bucket(INTERVAL '{width}', ts, {EPOCH}) AS window_start, time_bucket(INTERVAL '{width}', ts, {EPOCH}) + INTERVAL '{width}' AS window_end, arg_min(price, (ts, id)) AS open, max(price) AS high, min(price) AS low, "
        f"arg_max(price, (ts, id)) AS close, CAST(coalesce(sum(vol), 0) AS DECIMAL(38,2)) AS volume_sum, count(*) AS event_count FROM {source} GROUP BY ALL)"
    )


#: Alerts of candles ``c``: the ratio in integers, half-even at four digits.
ALERTS = (
    "a0 AS (SELECT *, CAST(open * 100000000 AS HUGEINT) AS den, CAST(abs(close - open) * 100000000 AS HUGEINT) * 10000 AS num FROM c WHERE open <> 0), "
    "a1 AS (SELECT *, num // den AS q, num % den AS r FROM a0), "
    "a2 AS (SELECT *, CAST(CAST(sign(close - open) AS INTEGER) * (q + CASE WHEN 2 * r > den OR (2 * r = den AND q % 2 = 1) THEN 1 ELSE 0 END) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,4)) AS pct FROM a1), "
    "a AS (SELECT symbol, CASE WHEN pct > 0 THEN 'PRICE_SPIKE' ELSE 'PRICE_DROP' END AS alert_type, pct AS price_change_pct, open AS old_price, close AS new_price, window_start, window_end, "
    "CASE WHEN abs(pct) >= 10 THEN 'HIGH' WHEN abs(pct) >= 7 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM a2 WHERE abs(pct) > 5)"
)
TYPICAL = "CAST(round_even(CAST(open + high + low + close AS DOUBLE) / 4, 8) AS DECIMAL(20,8))"
RECORDS = f"r AS (SELECT crypto_id, window_start, window_end, open, high, low, close, {TYPICAL} AS avg_price, volume_sum, event_count AS trade_count FROM c JOIN d USING (symbol))"
LAST = "l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1)"
LISTINGS = "li AS (SELECT p_brand AS category, 'p' || p_partkey AS symbol, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS market_cap, CAST(sum(l_quantity) AS DECIMAL(38,2)) AS volume FROM (SELECT l_partkey, CAST(l_extendedprice AS DECIMAL(20,2)) AS l_extendedprice, CAST(l_quantity AS DECIMAL(20,2)) AS l_quantity FROM lineitem) JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_partkey)"


def sql(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}" if parts else select


def pct(current: str, previous: str) -> str:
    return f"CASE WHEN {previous} = 0 THEN 0.0 ELSE (CAST({current} AS DOUBLE) - CAST({previous} AS DOUBLE)) / CAST({previous} AS DOUBLE) * 100 END"
