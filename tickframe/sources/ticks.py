"""Tick tables and streams, and the symbol dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.functions.scalars import iso_text
from tickframe.sources.schemas import ALERT_JSON, TICK_JSON


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def message_id(symbol: Column, ts: Column) -> Column:
    """SYMBOL-epoch_ms."""
    return F.concat_ws("-", symbol, F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})").cast("string"))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks from the event table: symbol, price_usd, volume_24h, market_cap, ts, tick_id, kafka_offset, kafka_partition."""
    events = table(spark, sf_dir, "events")
    price = F.col("value").cast("decimal(20,8)")
    return events.select(
        F.col("event_type").alias("symbol"), price.alias("price_usd"), F.get_json_object("props", "$.k").cast("decimal(20,2)").alias("volume_24h"), (price * 1_000_000).cast("decimal(20,2)").alias("market_cap"),
        "ts", F.col("event_id").alias("tick_id"), F.col("event_id").alias("kafka_offset"), F.pmod("event_id", F.lit(4)).cast("int").alias("kafka_partition"),
    )


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tick per order line with many keys: symbol is the supplier, price the unit price, time the ship date."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity >= 1")
    price = F.expr("cast(round(l_extendedprice * 100) as bigint) * 100 div cast(l_quantity as bigint)").cast("decimal(16,0)") * F.lit("0.0001").cast("decimal(5,4)")
    return lines.select(
        F.col("l_suppkey").cast("string").alias("symbol"), price.cast("decimal(20,8)").alias("price_usd"), F.col("l_quantity").cast("decimal(20,2)").alias("volume_24h"),
        F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("tick_id"),
    )


def symbol_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """crypto_id, symbol, name, slug, is_active: every traded symbol and one that never trades.

    Some names and slugs are missing, as in a hand-kept table; every fourth symbol is inactive.
    """
    seen = table(spark, sf_dir, "events").where("event_type <> ''").select(F.col("event_type").alias("symbol")).union(spark.sql("SELECT 'ghost'")).distinct()
    numbered = seen.withColumn("crypto_id", F.row_number().over(Window.orderBy("symbol")))
    return numbered.select(
        "crypto_id", "symbol", F.when(F.col("crypto_id") % 3 != 0, F.initcap("symbol")).alias("name"), F.when(F.col("crypto_id") % 2 != 0, F.concat("symbol", F.lit("-coin"))).alias("slug"), (F.col("crypto_id") % 4 != 0).alias("is_active"),
    )


def symbol_list(dimension: DataFrame) -> DataFrame:
    """Active and inactive symbols with fall-backs: the symbol as name, its lower-case form as slug."""
    return dimension.select("crypto_id", "symbol", F.coalesce("name", "symbol").alias("name"), F.coalesce("slug", F.lower("symbol")).alias("slug"), "is_active")


def kafka_ticks(spark: SparkSession, servers: str, topic: str = "crypto-prices", starting: str = "latest", **options: str) -> DataFrame:
    """Raw value stream of a topic. Needs Spark's Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting)
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"), F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"))


def file_ticks(spark: SparkSession, path: str, files_a_batch: int = 1) -> DataFrame:
    """Raw value stream of text files, one JSON record a line."""
    return spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(path)


def jdbc_table(spark: SparkSession, url: str, name: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A database table. With a partition column it is read in parallel ranges of that column, a number, date or time; its
    lowest and highest values, which the database looks up, are the bounds where none are given. Columns and filters are
    pushed down to the database."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column:
        if not bounds:
            ends = reader.option("query", f"SELECT min({partition_column}) AS low, max({partition_column}) AS high FROM {name}").load().first()
            bounds = (str(ends[0]), str(ends[1])) if ends[0] is not None else None
        if bounds:
            # The upper bound ends the last range but one; rows beyond either bound are read too.
            ranges = {"partitionColumn": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(partitions)}
            return spark.read.format("jdbc").option("url", url).options(**options).option("dbtable", name).options(**ranges).load()
    return spark.read.format("jdbc").option("url", url).options(**options).option("dbtable", name).load()


def jdbc_catalog(spark: SparkSession, catalog: str, url: str, **options: str) -> Callable[[str], DataFrame]:
    """Names a database as a catalog of the session and gives a reader of its tables, as ``read("schema.table")``.

    Through it limits, top rows and aggregates are pushed down as well as filters: the database counts, and only the result
    comes over.
    """
    key = f"spark.sql.catalog.{catalog}"
    pushed = {"pushDownAggregate": "true", "pushDownLimit": "true", "pushDownTableSample": "true", "pushDownOffset": "true"}
    for k, v in ({"url": url} | pushed | options).items():
        spark.conf.set(f"{key}.{k}", v)
    spark.conf.set(key, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    return lambda name: spark.table(f"{catalog}.{name}")


def kafka_alerts(spark: SparkSession, servers: str, topic: str = "crypto-alerts", **options: str) -> DataFrame:
    """New alerts of a topic, decoded. Needs Spark's Kafka package on the cluster."""
    return decode_alerts(kafka_ticks(spark, servers, topic, "latest", **options))


def decode_alerts(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON alerts to columns, from a table or a stream; broken ones, and those without symbol or type, go."""
    alerts = raw.withColumn("alert", F.from_json(column, ALERT_JSON)).select(*[c for c in raw.columns if c != column], "alert.*")
    return alerts.where("symbol IS NOT NULL AND alert_type IS NOT NULL")


def tick_messages(ticks: DataFrame) -> DataFrame:
    """Ticks (symbol, price_usd, volume_24h, ts) as messages to publish: JSON, keyed by symbol."""
    body = F.struct("symbol", "price_usd", "volume_24h", iso_text("ts").alias("timestamp"), message_id(F.col("symbol"), "cast(ts as timestamp_ntz)").alias("message_id"))
    return ticks.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))


def decode_ticks(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON records to tick columns; a broken record has nulls throughout, unknown fields are ignored."""
    return raw.withColumn("tick", F.from_json(column, TICK_JSON)).select(*[c for c in raw.columns if c != column], "tick.*")
