"""Column functions of the tick domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Alert severity by absolute percent, and trend classes by percent.
HIGH_PERCENT, MEDIUM_PERCENT, STRONG_TREND = 10, 7, 2
DASH = "—"


def event_time(timestamp: Column, last_updated: Column) -> Column:
    """ISO time, else the feed's epoch seconds, else null."""
    return F.coalesce(F.try_to_timestamp(timestamp), F.timestamp_seconds(last_updated))


def iso_text(ts: str) -> Column:
    """ISO form of a time in whole seconds, as messages carry it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def clock_text(ts: Column) -> Column:
    """HH:mm:ss; ``Unknown`` where there is no time."""
    return F.coalesce(F.date_format(ts, "HH:mm:ss"), F.lit("Unknown"))


def two_digits(value: Column) -> Column:
    """A number with two digits, halves away from zero; null is 0.00."""
    return F.coalesce(F.round(value.cast("decimal(38,8)"), 2).cast("decimal(36,2)"), F.lit(0).cast("decimal(36,2)")).cast("string")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a time with or without zone, by the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def ordinal(micros: Column, number: Column) -> Column:
    """One number that orders by time, then by a long, which may be negative: cheaper to aggregate by than a struct."""
    return (micros.cast("decimal(38,0)") * F.lit("2" + "0" * 19).cast("decimal(20,0)") + number).cast("decimal(38,0)")


def tick_order(ts: str, tick_id: str) -> Column:
    """One number that orders ticks by time, then id."""
    return ordinal(epoch_micros(ts), F.col(tick_id))


def percent_change(current: Column, previous: Column) -> Column:
    """Percent from previous to current; 0 from 0."""
    return F.when(previous == 0, F.lit(0.0)).otherwise((current.cast("double") - previous.cast("double")) / previous.cast("double") * 100)


def anomaly_percent(opened: Column, closed: Column) -> Column:
    """The ratio rounded half-even at four digits, then times 100."""
    return (F.bround((closed - opened) / opened, 4) * 100).cast("decimal(20,4)")


def typical_price(o: Column, h: Column, low: Column, c: Column) -> Column:
    """Mean of the four prices, half-even at eight digits; 0 when one is null."""
    return F.coalesce(F.bround((o + h + low + c) / 4, 8), F.lit(0)).cast("decimal(20,8)")


def severity(percent: Column) -> Column:
    return F.when(F.abs(percent) >= HIGH_PERCENT, "HIGH").when(F.abs(percent) >= MEDIUM_PERCENT, "MEDIUM").otherwise("LOW")


def alert_type(percent: Column) -> Column:
    return F.when(percent > 0, "PRICE_SPIKE").otherwise("PRICE_DROP")


def direction(opened: Column, closed: Column) -> Column:
    return F.when(closed >= opened, "up").otherwise("down")


def trend_class(percent: Column) -> Column:
    return F.when(percent > STRONG_TREND, "strong_up").when(percent > 0, "up").when(percent < -STRONG_TREND, "strong_down").when(percent < 0, "down").otherwise("flat")


def price_text(price: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(price, 2))


def signed_percent_text(percent: Column, sign_zero: bool = True) -> Column:
    """``+1.50%``; with ``sign_zero`` off, zero has no sign."""
    signed = F.format_string("%+.2f%%", percent)
    return signed if sign_zero else F.when(percent == 0, F.lit("0.00%")).otherwise(signed)


def amount_text(amount: Column, trillions: bool = False) -> Column:
    """``$1.23K``, M, B, and T if asked for; below a thousand plain."""
    value = F.coalesce(amount.cast("double"), F.lit(0.0))
    text = F.when(F.lit(trillions) & (value >= 1e12), F.format_string("$%.2fT", value / 1e12))
    for size, letter in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
        text = text.when(value >= size, F.format_string(f"$%.2f{letter}", value / size))
    return text.otherwise(F.format_string("$%.2f", value))


def adaptive_price_text(price: Column) -> Column:
    """Two digits from 1000, four from 1, else six; a dash for what is no number."""
    value = price.cast("double")
    whole = F.abs(value)
    text = F.when(whole >= 1000, F.format_number(value, 2)).when(whole >= 1, F.format_number(value, 4)).otherwise(F.format_number(value, 6))
    return F.when(value.isNull() | F.isnan(value) | (whole == float("inf")), F.lit(DASH)).otherwise(text)


def count_text(count: Column) -> Column:
    return F.format_number(F.coalesce(count, F.lit(0)), 0)


def title_words(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def relative_age(seconds: Column) -> Column:
    """just now, N min, N hours, N days, N weeks, by whole units; null beyond four weeks (a date is shown then)."""
    def label(n: Column, one: str, many: str) -> Column:
        return F.concat(n.cast("string"), F.when(n == 1, f" {one}").otherwise(f" {many}"))

    minutes, hours, days = F.floor(seconds / 60), F.floor(seconds / 3600), F.floor(seconds / 86400)
    return (
        F.when(seconds < 60, "just now").when(minutes < 60, label(minutes, "min", "min")).when(hours < 24, label(hours, "hour", "hours"))
        .when(days < 7, label(days, "day", "days")).when(days < 28, label(F.floor(days / 7), "week", "weeks"))
    )


#: Days shown and the candle width for them.
PERIODS = {1: "30 minutes", 7: "4 hours", 14: "4 hours", 30: "4 hours", 90: "4 days", 180: "4 days", 365: "4 days"}


def period_width(days: int) -> str:
    """Candle width for a period: 1 day half an hour, up to 30 days four hours, beyond four days."""
    return "30 minutes" if days <= 1 else "4 hours" if days <= 30 else "4 days"
