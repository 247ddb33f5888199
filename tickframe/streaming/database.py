"""Keyed upserts into a database over JDBC."""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a batch that goes to the database at once, and how often a failed step is tried again.
BATCH_ROWS, RETRIES = 100, 3

#: Statement that merges staged rows into a table: ``merge`` is standard SQL, ``on_conflict`` the form of databases without it.
DIALECTS = ("merge", "on_conflict")


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def merge_statement(table: str, staged: str, columns: dict[str, str], keys: list[str], part: int, dialect: str = "merge", quote: Callable[[str], str] = quoted) -> str:
    """SQL that updates rows of ``table`` that staged rows of one part share a key with, and inserts the others.

    ``columns`` has the table's name of each staged column; staged ones are quoted, as Spark creates them.
    """
    names, sources = ", ".join(columns.values()), {c: quote(c) for c in columns}
    rest, mine = [c for c in columns if c not in keys], f"{quote('part_')} = {part}"
    if dialect == "on_conflict":
        update = ", ".join(f"{columns[c]} = EXCLUDED.{columns[c]}" for c in rest)
        do = f"UPDATE SET {update}" if rest else "NOTHING"
        return f"INSERT INTO {table} ({names}) SELECT {', '.join(sources.values())} FROM {staged} WHERE {mine} ON CONFLICT ({', '.join(columns[k] for k in keys)}) DO {do}"
    on = " AND ".join([f"s.{mine}", *(f"t.{columns[k]} = s.{sources[k]}" for k in keys)])
    update = f"WHEN MATCHED AND s.{mine} THEN UPDATE SET {', '.join(f'{columns[c]} = s.{sources[c]}' for c in rest)} " if rest else ""
    return f"MERGE INTO {table} t USING {staged} s ON {on} {update}WHEN NOT MATCHED AND s.{mine} THEN INSERT ({names}) VALUES ({', '.join(f's.{c}' for c in sources.values())})"


def tried(step: Callable[[], None], retries: int = RETRIES, pause: float = 1.0) -> None:
    """Run a step that may be repeated; after a failure ``retries`` times more, pausing longer each time."""
    for left in range(retries, -1, -1):
        try:
            return step()
        except (PySparkException, Py4JJavaError):
            if not left:
                raise
            time.sleep(pause * (retries - left + 1))


def execute(spark: SparkSession, url: str, statements: list[str], properties: dict[str, str]) -> None:
    """Statements in one transaction on a connection of the driver: all or none take effect."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    given = jvm.java.util.Properties()
    for k, v in properties.items():
        if k != "driver":
            given.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        try:
            for text in statements:
                statement = connection.createStatement()
                statement.execute(text)
                statement.close()
            connection.commit()
        except Py4JJavaError:
            connection.rollback()
            raise
    finally:
        connection.close()


def upsert_jdbc(url: str, table: str, keys: list[str], parts: int = 4, dialect: str = "merge", retries: int = RETRIES, pause: float = 1.0, names: dict[str, str] | None = None, **properties: str) -> Callable[[DataFrame, int], None]:
    """A batch function for ``sinks.start`` that merges rows into a database table by key.

    Executors send a micro-batch to a staging table over ``parts`` connections, BATCH_ROWS rows at a time, dealt by a hash of
    the key; then the database merges each part from there in a transaction of its own, so no row passes the driver. Of rows
    that repeat a key in a micro-batch one stays, chosen by their values. Each step is tried again after a failure; as all
    are keyed, repeating a step, or a whole micro-batch after a restart, leaves the table as it is. The staging table is
    named after the table and written anew by each micro-batch, so one query at a time may write to a table. Rows with a null
    key are refused, as the database would not match them. ``names`` gives the table's columns that are called or quoted
    otherwise than the frame's; ``properties`` are those of the connection, as user, password and driver.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    staged = f"{table}_staged"

    def batch(df: DataFrame, number: int) -> None:
        spark, columns = df.sparkSession, df.columns
        quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
        known = {c: (names or {}).get(c, c) for c in columns}
        one = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in columns if c not in keys))
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        for k in keys:
            df = df.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"{k} is null: a key must be there"))).otherwise(F.col(k)))
        single = df.withColumn("n_", F.row_number().over(one)).where("n_ = 1").drop("n_") if len(columns) > len(keys) else df.dropDuplicates(keys)
        rows = single.withColumn("part_", part)
        writer = rows.repartition(parts, "part_").write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", staged).option("batchsize", BATCH_ROWS).options(**properties)
        tried(writer.save, retries, pause)
        for k in range(parts):
            tried(lambda k=k: execute(spark, url, [merge_statement(table, staged, known, keys, k, dialect, quote)], properties), retries, pause)

    return batch
