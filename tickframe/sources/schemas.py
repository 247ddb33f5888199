"""Schemas of the tick pipeline's records."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE, AMOUNT, PERCENT = T.DecimalType(20, 8), T.DecimalType(20, 2), T.DecimalType(10, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

#: A price update as published.
TICK_JSON = _struct(symbol=_S, coin_id=_S, price_usd=PRICE, volume_24h=AMOUNT, market_cap=AMOUNT, price_change_24h=PERCENT, last_updated=_L, timestamp=_S, producer_id=_S, message_id=_S)
#: A feed snapshot: coin id to its numbers.
SNAPSHOT_JSON = T.MapType(_S, _struct(usd=PRICE, usd_24h_vol=AMOUNT, usd_market_cap=AMOUNT, usd_24h_change=PERCENT, last_updated_at=_L))
ALERT_JSON = _struct(symbol=_S, alert_type=_S, price_change_percent=PERCENT, open_price=PRICE, close_price=PRICE, window_start=_S, window_end=_S, timestamp=_S, severity=_S)
CANDLE_JSON = _struct(symbol=_S, windowStart=_D, windowEnd=_D, open=PRICE, high=PRICE, low=PRICE, close=PRICE, volumeSum=AMOUNT, eventCount=_I)
#: A pushed frame: the payload's meaning depends on ``type``.
FRAME_JSON = _struct(type=_S, symbol=_S, data=CANDLE_JSON, count=_L)
FRAME_TYPES = ["connection", "initial_data", "price_update", "keepalive", "pong"]
LISTING_JSON = _struct(
    id=_S, symbol=_S, name=_S, image=_S, current_price=_D, market_cap=_D, market_cap_rank=_L, total_volume=_D, high_24h=_D, low_24h=_D,
    categories=T.ArrayType(_S), sparkline_in_7d=_struct(price=T.ArrayType(_D)), links=_struct(homepage=T.ArrayType(_S)),
    tickers=T.ArrayType(_struct(market=_S, base=_S, target=_S, last=_D, volume=_D, converted_last=T.MapType(_S, _D))),
)
CATEGORY_JSON = _struct(id=_S, name=_S, market_cap=_D, market_cap_change_24h=_D, content=_S, top_3_coins=T.ArrayType(_S), volume_24h=_D, updated_at=_S)
_BY_CURRENCY = T.MapType(_S, _D)
COIN_JSON = _struct(
    id=_S, symbol=_S, name=_S, market_cap_rank=_L, description=_struct(en=_S), links=_struct(homepage=T.ArrayType(_S)),
    market_data=_struct(current_price=_BY_CURRENCY, price_change_percentage_24h_in_currency=_BY_CURRENCY, market_cap=_BY_CURRENCY, total_volume=_BY_CURRENCY),
)
TRENDING_JSON = _struct(coins=T.ArrayType(_struct(item=_struct(id=_S, name=_S, symbol=_S, market_cap_rank=_L, score=_L, data=_struct(price=_D, price_change_percentage_24h=_struct(usd=_D))))))
GLOBAL_JSON = _struct(data=_struct(active_cryptocurrencies=_L, markets=_L, total_market_cap=_BY_CURRENCY, total_volume=_BY_CURRENCY, market_cap_percentage=_BY_CURRENCY, updated_at=_L))
ALERT_TYPES = ["PRICE_SPIKE", "PRICE_DROP"]
