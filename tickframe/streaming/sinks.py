"""Idempotent sinks. A replayed batch leaves the tables as they were."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tickframe.operators.market import timestamp
from tickframe.operators.ohlc import alert_messages, candle_json
from tickframe.operators.tables import write_clustered
from tickframe.operators.windows import latest_by

#: Seconds that a latest state counts, and the time between checkpoints.
STATE_SECONDS, CHECKPOINT_EVERY = 300, "60 seconds"


def start(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append", every: str | None = CHECKPOINT_EVERY) -> StreamingQuery:
    """Run ``batch`` on each micro-batch; ``every`` None takes what is there and ends. Restarts go on from the checkpoint."""
    return triggered(stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(batch), every)


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def _remove(spark: SparkSession, path: str) -> None:
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def _run(df: DataFrame) -> str:
    """The streaming query that a batch belongs to: its restarts share it, a query with another checkpoint has another."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def upsert_by_date(path: str, keys: list[str], time: str) -> Callable[[DataFrame, int], None]:
    """Merge rows into date partitions by key; rows of the batch at hand win, and only touched dates are rewritten.

    A replayed batch brings the same rows again, so the table stays as it is; and whatever is in the table stays, also
    under a query with a fresh checkpoint, which counts its batches from 0 again. The merged dates are staged first, so
    that a crash leaves either the old or the new partition.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        new = df.withColumn("date", F.to_date(time)).withColumns({"run_id": F.lit(_run(df)), "batch_id": F.lit(number).cast("long")}).persist()
        dates = [r["date"] for r in new.select("date").distinct().collect()]
        if dates:
            merged = new.withColumn("at_hand", F.lit(True))
            if _exists(spark, path):
                old = spark.read.parquet(path).where(F.col("date").isin(dates))
                merged = merged.unionByName(old.withColumn("at_hand", F.lit(False)))
            newest = Window.partitionBy(*keys, "date").orderBy(F.desc("at_hand"))
            staged = f"{path}__staged/{_run(df)}-{number}"
            merged.withColumn("n", F.row_number().over(newest)).where("n = 1").drop("n", "at_hand").write.mode("overwrite").parquet(staged)
            write_clustered(spark.read.parquet(staged), path, "date", keys, mode="overwrite", partitionOverwriteMode="dynamic")
            _remove(spark, staged)
        new.unpersist()

    return batch


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of a latest table's whole versions, ascending."""
    files, hadoop = _file_system(spark, path)
    if not files.exists(hadoop):
        return []
    names = [x.getPath().getName() for x in files.listStatus(hadoop)]
    numbers = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [n for n in numbers if _exists(spark, f"{path}/version={n}/_SUCCESS")]


def latest_table(path: str, key: str | list[str] = "symbol", order: tuple[str, ...] = ("window_start",)) -> Callable[[DataFrame, int], None]:
    """Keep each symbol's last candle, or each key's last row by ``order``, as ("ts", "tick_id") for ticks: readers of the
    latest price then read a row for each key and no history. Every batch writes the whole small table as a new version,
    and the two last stay.

    Merging keeps the later row, so a replayed batch, or one of a query with a fresh checkpoint, changes nothing that
    is newer.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark, rows = df.sparkSession, df
        done = _versions(spark, path)
        if done:
            rows = df.unionByName(spark.read.parquet(f"{path}/version={done[-1]}").select(*df.columns))
        latest_by(rows, key, list(order)).write.mode("overwrite").parquet(f"{path}/version={done[-1] + 1 if done else 0}")
        for old in done[:-1]:
            _remove(spark, f"{path}/version={old}")

    return batch


def read_latest(spark: SparkSession, path: str, now: datetime | None = None) -> DataFrame:
    """The latest table; with ``now``, rows whose window ended over STATE_SECONDS ago are gone."""
    rows = spark.read.parquet(f"{path}/version={_versions(spark, path)[-1]}")
    return rows if now is None else rows.where(F.expr(f"timestampdiff(SECOND, cast(window_end AS timestamp_ntz), {_literal(now)})") <= STATE_SECONDS)


def _literal(value: datetime) -> str:
    return f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'"


def alert_table(path: str) -> Callable[[DataFrame, int], None]:
    """Alerts by symbol and window, once each."""
    merge = upsert_by_date(path, ["symbol", "window_start"], "window_start")
    return lambda df, number: merge(df.withColumn("created_at", F.col("window_end")), number)


def triggered(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Started with a micro-batch every so often, without end; None takes what is there and ends."""
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def raw_tick_sink(ticks: DataFrame, path: str, checkpoint: str, every: str | None = CHECKPOINT_EVERY) -> StreamingQuery:
    """Ticks with offset and partition into date partitions, exactly once by the file sink's log."""
    dated = ticks.withColumn("date", F.to_date("ts"))
    return triggered(dated.writeStream.format("parquet").partitionBy("date").option("path", path).option("checkpointLocation", checkpoint), every)


def _publish(path: str, messages: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Keyed JSON files in a folder for each batch of each query, which a replay rewrites: exactly once."""
    return lambda df, number: messages(df).write.mode("overwrite").json(f"{path}/run={_run(df)}/batch={number}")


def publish_candles(path: str, symbols: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Candles as keyed JSON files, for the given symbols or all."""
    return _publish(path, lambda df: candle_json(df.where(F.col("symbol").isin(symbols)) if symbols and "ALL" not in symbols else df))


def publish_alerts(path: str) -> Callable[[DataFrame, int], None]:
    """Alerts as keyed JSON files, with their dedupe keys."""
    return _publish(path, lambda df: alert_messages(df).drop("headers"))


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Messages, as of ``alert_messages``, to a topic, at least once; ``jobs.alerts_once`` drops repeats by the dedupe key on
    the reader's side. Needs Spark's Kafka package."""
    columns = [c for c in ("key", "value", "headers") if c in messages.columns]
    writer = messages.select(*columns).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("includeHeaders", "true")
    return triggered(writer.option("checkpointLocation", checkpoint), CHECKPOINT_EVERY)


def print_lines(lines: DataFrame, every: str | None = CHECKPOINT_EVERY, **options: str) -> StreamingQuery:
    """Print a stream of text lines, such as ``candle_lines`` or ``alert_lines``."""
    return triggered(lines.writeStream.format("console").option("truncate", False).options(**options), every)


def expired(rows: DataFrame, now: datetime) -> DataFrame:
    """Rows of a latest table that no longer count."""
    return rows.where(timestamp(now) > F.col("window_end").cast("timestamp_ntz") + F.expr(f"INTERVAL '{STATE_SECONDS}' SECOND"))
