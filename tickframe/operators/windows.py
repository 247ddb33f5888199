"""Running calculations per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.scalars import epoch_micros, ordinal, percent_change
from tickframe.operators.lineage import checkpointed

HOUR = 3600
SPANS = {"1h": HOUR, "24h": 24 * HOUR, "7d": 7 * 24 * HOUR, "30d": 30 * 24 * HOUR}
#: Rows of a symbol that are sorted together, and the cells, in microseconds, into which a span of time with more is split:
#: days, hours, minutes, seconds, milliseconds and microseconds. Ahead of them stands a cell from -EVER
#: that holds all times there are, and rows without one: the whole symbol.
MOST_ROWS = 1 << 18
CELLS = [86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1]
EVER = 5 * 10**17
WHOLE = 2 * EVER
#: ``look_back``: rows that are sorted together, look-back points among them, and rows for which it has one partition.
MOST_POINTS, TASK_ROWS = 1 << 16, 1 << 20


def _cell(at: str, width: int) -> Column:
    if width == WHOLE:
        micros = F.coalesce(F.col(at), F.lit(0))
        return micros - F.pmod(micros + EVER, F.lit(WHOLE))
    return F.col(at) - F.pmod(F.col(at), F.lit(width))


def hot_cells(df: DataFrame, most: int = MOST_ROWS, at: str = "at", hours: DataFrame | None = None, cells: list[int] = CELLS) -> list[DataFrame]:
    """For each width of ``cells``, the cells (symbol, __cell) of ``df(symbol, at)`` with more than ``most`` rows.

    A narrower width is only counted inside the hot cells of the one before; the list ends with the first width that has no
    hot cell. Each step is a job; the tables have at most one row for each ``most`` rows of ``df``. ``hours``, if at hand, has
    the rows' counts as (symbol, at, n) by hour: then ``df`` is only read for widths below.
    """
    hot: list[DataFrame] = []
    for k, width in enumerate(cells[:-1]):
        by_hour = hours is not None and width >= CELLS[1]
        rows = hours if by_hour else df.select("symbol", F.col(at).alias("at"), F.lit(1).alias("n"))
        if hot:
            rows = rows.withColumn("__cell", _cell("at", cells[k - 1])).join(hot[-1], ["symbol", "__cell"], "left_semi")
        counts = rows.groupBy("symbol", _cell("at", width).alias("__cell")).agg(F.sum("n").alias("n"))
        found = checkpointed(counts.where(F.col("n") > most).select("symbol", "__cell"))
        if found.isEmpty():
            break
        hot.append(found)
    return hot


def with_bucket(df: DataFrame, hot: list[DataFrame], at: str = "at", cells: list[int] = CELLS) -> DataFrame:
    """``df(symbol, at, ...)`` with ``bucket``, the start of the widest of ``cells`` around ``at`` that is not hot.

    Buckets of a symbol are disjoint, in the order of their starts, and lie within the widest cells. None has more rows than
    ``hot`` was made for, but for those of one symbol in one microsecond.
    """
    bucket, columns = _cell(at, cells[0]), df.columns
    for k, found in enumerate(hot):
        df = df.withColumn("__cell", _cell(at, cells[k])).join(found.withColumn(f"__hot{k}", F.lit(True)), ["symbol", "__cell"], "left").drop("__cell")
        bucket = F.when(F.col(f"__hot{k}"), _cell(at, cells[k + 1])).otherwise(bucket)
    return df.withColumn("bucket", bucket).select(*columns, "bucket")


def with_halo(df: DataFrame, order: list[str], rows: int, most: int = MOST_ROWS) -> DataFrame:
    """Each bucket of a symbol as a partition of its own, led by the last ``rows`` rows before it, marked ``carried``.

    ``order`` begins with the time. Adds ``bucket``: the whole symbol, or where that has over ``most`` rows a day or less. A
    whole symbol has nothing before it, so a table of many symbols with few rows each is only sorted by them. Of other buckets
    the last rows are gathered; as every bucket has at least one, those of the ``rows`` buckets before suffice.
    """
    timed, cells = df.withColumn("__at", epoch_micros(order[0])), [WHOLE, *CELLS]
    hot = hot_cells(timed, most, "__at", cells=cells)
    own = with_bucket(timed, hot, "__at", cells).drop("__at")
    if not hot:
        return own.withColumn("carried", F.lit(False))
    split = own.where(~F.col("bucket").eqNullSafe(F.lit(-EVER)))
    back = Window.partitionBy("symbol", "bucket").orderBy(*(F.desc(c) for c in order))
    last = split.withColumn("back", F.row_number().over(back)).where(F.col("back") <= rows)
    last = last.groupBy("symbol", "bucket").agg(F.collect_list(F.struct("back", *df.columns)).alias("last"))
    buckets = Window.partitionBy("symbol").orderBy("bucket").rowsBetween(-rows, -1)
    ordered = last.select("symbol", "bucket", F.sort_array("last", asc=False).alias("last"))
    halo = ordered.select("bucket", F.flatten(F.collect_list("last").over(buckets)).alias("before"))
    halo = halo.select("bucket", F.explode(F.slice("before", F.greatest(F.size("before") - rows + 1, F.lit(1)), rows)).alias("b"))
    halo = halo.select("bucket", *(F.col(f"b.{c}").alias(c) for c in df.columns), F.lit(True).alias("carried"))
    return own.withColumn("carried", F.lit(False)).unionByName(halo)


def _bucketed(order: list[str]) -> WindowSpec:
    return Window.partitionBy("symbol", "bucket").orderBy(*order)


def moving_average(df: DataFrame, value: str, rows: int | dict[str, int], order: list[str], name: str = "", full_only: bool = False, most: int = MOST_ROWS) -> DataFrame:
    """Mean of the last ``rows`` values per symbol, or several such means by name. ``full_only``: null until there are so
    many. Each bucket is averaged apart, led by as many rows before it as the mean needs."""
    means = rows if isinstance(rows, dict) else {name: rows}
    out, by = with_halo(df, order, max(means.values()) - 1, most), _bucketed(order)
    for alias, n in means.items():
        mean = F.avg(F.col(value).cast("double")).over(by.rowsBetween(-(n - 1), 0))
        out = out.withColumn(alias, F.round(F.when(F.row_number().over(by) >= n, mean) if full_only else mean, 6))
    return out.where("NOT carried").drop("carried", "bucket")


def candle_sma(candles: DataFrame, periods: tuple[int, ...] = (20, 50)) -> DataFrame:
    """Simple moving averages of closes; a symbol with fewer candles than a period has none."""
    return moving_average(candles.select("symbol", "window_start", "close"), "close", {f"sma_{n}": n for n in periods}, ["window_start"], full_only=True)


def with_previous(df: DataFrame, value: str, order: list[str], name: str = "previous", most: int = MOST_ROWS) -> DataFrame:
    """Rows with the symbol's value before, as ``name``; each bucket is a partition of its own, led by the last row before it."""
    out = with_halo(df, order, 1, most).withColumn(name, F.lag(value).over(_bucketed(order)))
    return out.where("NOT carried").drop("carried", "bucket")


def trend_detect(ticks: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Change from the symbol's previous tick, classed up or down beyond the threshold, else flat."""
    ticks = ticks.select("symbol", "ts", "tick_id", "price_usd")
    moved = with_previous(ticks, "price_usd", ["ts", "tick_id"]).withColumn("change_pct", F.round(percent_change(F.col("price_usd"), F.col("previous")), 6))
    trend = F.when(F.col("change_pct") > threshold, "up").when(F.col("change_pct") < -threshold, "down").otherwise("flat")
    return moved.select("symbol", "tick_id", "ts", "price_usd", "previous", "change_pct", trend.alias("trend"))


def tick_jumps(ticks: DataFrame, percent: float = 50.0) -> DataFrame:
    """Ticks that differ from the one before by more than ``percent``."""
    return trend_detect(ticks, percent).where(F.abs("change_pct") > percent).drop("trend")


def _by_hour(timed: DataFrame, spans: dict[str, int]) -> DataFrame:
    """How many ticks and look-back points (symbol, at, n) each hour has; ticks are counted first where spans are whole hours."""
    hours = lambda df: df.groupBy("symbol", _cell("at", CELLS[1]).alias("at")).agg(F.sum("n").alias("n"))
    ticks = timed.select("symbol", "at", F.lit(1).alias("n"))
    if not any(n % HOUR for n in spans.values()):
        ticks = hours(ticks)
    return hours(ticks.select("symbol", "n", F.explode(F.array(*[F.col("at") + n * 1_000_000 for n in (0, *spans.values())])).alias("at")))


def look_back(ticks: DataFrame, spans: dict[str, int], extremes: str, most: int = MOST_POINTS) -> DataFrame:
    """For each tick what the last so many seconds hold: the price of the earliest tick inside a span as base_<span>, and
    the high and low of the span ``extremes``, which is a day. Every row comes out again, also one that repeats another's
    tick_id, or all of it, or has no tick_id.

    A tick leaves each span at its time plus the span: at this point its price, and little else, is sorted together with the
    ticks of the point's bucket, latest first. The last point of a span that was passed is a tick's base, and the points of
    ``extremes`` passed are the ticks of the day before that it still sees. Before its own rows a bucket passes carried ones
    with what lies behind it: each span's first point of the later buckets, and the high and low of the day's later points.
    A tick sees its own day from the start in the same way, by a running frame led by the high and low of the day's earlier
    buckets; both together are the last 24 hours. So one shuffle brings the points to the ticks, and nothing is brought back.

    Points count when buckets are sized, so that neither a hot day nor the quiet one after it, on which its points lie, is
    sorted whole; and there is a partition for every ``TASK_ROWS`` rows, so that more rows make more tasks, not larger ones.
    """
    own, price, span = ["symbol", "tick_id", "ts", "price_usd"], F.col("price_usd"), F.col("span")
    tick, later, earlier, edge = 0, len(spans) + 1, len(spans) + 2, (1 << 63) - 1
    code = {k: i for i, k in enumerate(spans, 1)}
    timed = ticks.select(*own, epoch_micros("ts").alias("at"))
    hours = checkpointed(_by_hour(timed, spans))
    order = ordinal(F.col("at"), F.coalesce(F.col("tick_id").cast("long"), F.lit(-(1 << 63))))
    points = [F.struct((F.col("at") + n * 1_000_000).alias("at"), F.lit(i).alias("span")) for i, n in enumerate((0, *spans.values()))]
    rows = timed.select(*own, order.alias("order"), F.explode(F.array(*points)).alias("p"))
    rows = rows.select("symbol", "tick_id", F.when(F.col("p.span") == tick, F.col("ts")).alias("ts"), "price_usd", "order", "p.at", "p.span")
    rows = with_bucket(rows, hot_cells(rows, most, hours=hours))

    # Once for each span, as every row then meets three aggregates; beside the buckets, which are few.
    table = rows.groupBy("symbol", "bucket", "span").agg(F.min_by("price_usd", "order").alias("first"), F.max("price_usd").alias("most"), F.min("price_usd").alias("least"))
    sides = (("high", "most", tick), ("low", "least", tick), ("left_high", "most", code[extremes]), ("left_low", "least", code[extremes]))
    table = table.groupBy("symbol", "bucket").agg(*[F.max(F.when(span == i, F.col(value))).alias(name) for name, value, i in (*((k, "first", i) for k, i in code.items()), *sides)])
    table = table.withColumn("day", _cell("bucket", CELLS[0]))
    up = Window.partitionBy("symbol", "day").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("symbol", "day").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("symbol").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carried = [(edge, i, F.last(k, ignorenulls=True).over(behind)) for k, i in code.items()]
    carried += [(edge, later, F.max("left_high").over(down)), (edge, later, F.min("left_low").over(down)), (-edge, earlier, F.max("high").over(up)), (-edge, earlier, F.min("low").over(up))]
    carried = [F.struct(F.lit(at).cast("long").alias("at"), F.lit(i).alias("span"), value.alias("price_usd")) for at, i, value in carried]
    carried = table.select("symbol", "bucket", F.array(*carried).alias("c")).select("symbol", "bucket", F.explode("c").alias("c")).select("symbol", "bucket", "c.*").where("price_usd IS NOT NULL")

    total = hours.agg(F.sum("n")).first()[0] or 0
    tasks = max(ticks.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS))
    rows = rows.drop("order").unionByName(carried, allowMissingColumns=True).repartition(tasks, "symbol", "bucket")
    # At equal times points come before ticks, and of points the smallest id last.
    passed = Window.partitionBy("symbol", "bucket").orderBy(F.desc("at"), F.desc("span"), F.desc("tick_id")).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(span.isin(code[extremes], later), price)
    bases = [F.last(F.when(span == i, price), ignorenulls=True).over(passed).alias(f"base_{k}") for k, i in code.items()]
    found = rows.select(*own, "bucket", "at", "span", *bases, F.max(seen).over(passed).alias("left_high"), F.min(seen).over(passed).alias("left_low")).where(span.isin(tick, earlier))
    today = Window.partitionBy("symbol", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    found = found.withColumns({"high": F.max(price).over(today), "low": F.min(price).over(today)}).where(span == tick)
    return found.select(*own, *[f"base_{k}" for k in spans], F.greatest("high", "left_high").alias("high"), F.least("low", "left_low").alias("low"))


def multi_change(ticks: DataFrame, most: int = MOST_POINTS) -> DataFrame:
    """For each tick: percent change over 1 h, 24 h, 7 d and 30 d, 24 h absolute change, 24 h high and low.

    A span's base is the earliest tick inside it. Rows that repeat a tick_id, or have none, each get their row.
    """
    out, price = look_back(ticks, SPANS, "24h", most), F.col("price_usd")
    changes = [F.round(percent_change(price, F.col(f"base_{k}")), 6).alias(f"change_{k}") for k in SPANS]
    day = (price - F.col("base_24h")).cast("decimal(20,8)").alias("change_abs_24h")
    return out.select("symbol", "tick_id", "ts", "price_usd", *changes, day, F.col("high").alias("high_24h"), F.col("low").alias("low_24h"))


#: Types that a hash aggregation can carry: their values have a fixed width.
CARRIED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _ordering(df: DataFrame, order: list[str]) -> Column:
    """One number that sorts as ``order`` does, nulls first: a time, a whole number or a flag, or a time and then a number."""

    def number(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.coalesce(epoch_micros(c), F.lit(-(10**18)))
        if isinstance(kind, (T.IntegralType, T.BooleanType)):
            return F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63)))
        raise ValueError(f"{c}: order by times, whole numbers or flags")

    if len(order) == 1:
        return number(order[0])
    if len(order) != 2 or not isinstance(df.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise ValueError("order by one column, or by a time and a whole number")
    return ordinal(number(order[0]), number(order[1]))


def latest_by(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The last row of each key: hash aggregations with partial results; no row is sorted, and of a task only one row for each
    key goes to the shuffle.

    Columns of fixed width ride along with the largest ordering. Others, such as texts, have no place in a hash table: then
    the largest ordering is found in a first pass, and the rows that have it in a second. A row without an ordering counts
    when its key has no others; of equal orderings one row is kept.
    """
    keys, name = [key] if isinstance(key, str) else key, "__order"
    ordered = df.withColumn(name, _ordering(df, order))
    rest = [c for c in df.columns if c not in keys]
    if all(isinstance(df.schema[c].dataType, CARRIED) for c in rest):
        return ordered.groupBy(*keys).agg(*[F.max_by(c, name).alias(c) for c in rest]).select(*df.columns)
    top = ordered.groupBy(*keys).agg(F.max(name).alias("__top")).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.col(name) == F.col("__top")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return ordered.join(top, same, "left_semi").dropDuplicates(keys).select(*df.columns)
