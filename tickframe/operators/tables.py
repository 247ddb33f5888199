"""Table upkeep and batch sinks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators.market import timestamp

#: Days that ticks and one-minute candles are kept.
TICK_DAYS, CANDLE_DAYS = 7, 90


def retention_keep(df: DataFrame, column: str, days: int, end: datetime) -> DataFrame:
    """Rows not older than ``days`` before ``end``."""
    return df.where(F.col(column) >= timestamp(end - timedelta(days=days)))


def seed_symbols(existing: DataFrame, seed: DataFrame) -> DataFrame:
    """Seed rows whose symbol the dimension lacks: what an insert without conflicts would add."""
    return seed.join(existing.select("symbol"), "symbol", "left_anti")


def combined_export(candles: DataFrame, symbols: list[str]) -> DataFrame:
    """Series of several symbols in one table, by time."""
    return candles.where(F.col("symbol").isin(symbols)).select("symbol", "window_start", "open", "high", "low", "close", "volume_sum").orderBy("window_start", "symbol")


def write_csv(df: DataFrame, folder: str, name: str, at: datetime) -> str:
    """Write with header into a folder named by time; returns its path."""
    path = f"{folder.rstrip('/')}/{name}_{at:%Y%m%d_%H%M%S}"
    df.write.option("header", True).csv(path)
    return path


#: Rows of one file of a table, and bytes of a row group, the unit that a lookup reads or skips.
FILE_ROWS, GROUP_BYTES = 2_000_000, 16 << 20


def write_clustered(df: DataFrame, path: str, date: str, order: list[str | Column], mode: str = "append", file_rows: int = FILE_ROWS, group_bytes: int = GROUP_BYTES, **options: str) -> None:
    """Parquet in partitions of ``date``, dealt by ranges of (date, order) to files of about ``file_rows`` rows, sorted.

    Ranges come from a sample of the rows, so a large date falls into several tasks and files, and small ones share a task.
    Within a date, files and row groups hold ranges of the order's first columns, which their statistics tell: a lookup by
    key skips the others.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in (date, *order)]
    files = max(1, -(-df.count() // file_rows))
    dealt = df.repartitionByRange(files, *columns).sortWithinPartitions(*columns)
    dealt.write.mode(mode).options(**{"maxRecordsPerFile": str(2 * file_rows), "parquet.block.size": str(group_bytes)} | options).partitionBy(date).parquet(path)


def write_by_date(df: DataFrame, path: str, time: str, key: str, mode: str = "append", file_rows: int = FILE_ROWS, group_bytes: int = GROUP_BYTES) -> None:
    """Parquet in date partitions, clustered by key and then latest first, as the readers ask."""
    write_clustered(df.withColumn("date", F.to_date(time)), path, "date", [key, F.desc(time)], mode, file_rows, group_bytes)


def drop_older(spark: SparkSession, path: str, time: str, days: int, end: datetime, date: str = "date") -> list[str]:
    """Delete the rows of a table in date partitions that are older than ``days`` before ``end``; gives the dates dropped.

    Whole dates go as folders, through the file system. Of the date on the boundary only what stays is written again, beside
    the table first, and then takes its place; a run that breaks in between leaves the staged rows, from which the next one
    goes on. Younger dates are not touched. Nothing else may write to the boundary date meanwhile.
    """
    cut = end - timedelta(days=days)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    place = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{path}{name}")
    edge, staged = f"/{date}={cut:%Y-%m-%d}", f"__kept/{cut:%Y-%m-%d}"
    if files.exists(place(edge)) or files.exists(place(f"{staged}/_SUCCESS")):
        if not files.exists(place(f"{staged}/_SUCCESS")):
            rows = spark.read.parquet(f"{path}{edge}")
            if not rows.where(F.col(time).cast("timestamp_ntz") < timestamp(cut)).isEmpty():
                rows.where(F.col(time).cast("timestamp_ntz") >= timestamp(cut)).write.mode("overwrite").parquet(f"{path}{staged}")
        if files.exists(place(f"{staged}/_SUCCESS")):
            files.delete(place(edge), True)
            files.rename(place(staged), place(edge))
    names = [x.getPath().getName() for x in files.listStatus(root)] if files.exists(root) else []
    old = sorted(n for n in names if n.startswith(f"{date}=") and n < edge[1:])
    for name in old:
        files.delete(place(f"/{name}"), True)
    files.delete(place("__kept"), True)
    return [n.removeprefix(f"{date}=") for n in old]


def publish(df: DataFrame, target: str, servers: str | None = None) -> None:
    """Send key and value to a topic, or append them as JSON to a folder when no servers are given."""
    if servers:
        df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        df.write.mode("append").json(target)
