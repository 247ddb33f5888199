"""Database reads and keyed upserts, on the embedded database in Spark's jars; and table upkeep on disk."""

import datetime
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickframe.operators import ohlc, tables
from tickframe.sources.ticks import event_ticks, jdbc_catalog, jdbc_table, symbol_dimension
from tickframe.streaming import database, sinks

SF = "/root/testdata/sf0.001"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
COLUMNS = "crypto_id INT NOT NULL, window_start TIMESTAMP NOT NULL, window_end TIMESTAMP, close_price DECIMAL(20,8), trade_count INT, PRIMARY KEY (crypto_id, window_start)"
KEYS = ["crypto_id", "window_start"]
NAMES = {"close": "close_price"}
ROW = "crypto_id int, window_start timestamp, window_end timestamp, close decimal(20,8), trade_count int"


@pytest.fixture
def url(spark):
    name = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    database.execute(spark, name, [f"CREATE TABLE candles ({COLUMNS})"], {"driver": DRIVER})
    return name


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, url):
    return sorted((r["crypto_id"], r["window_start"], float(r["close"]), r["trade_count"]) for r in spark.read.format("jdbc").option("url", url).option("driver", DRIVER).option("dbtable", "candles").load().withColumnsRenamed({c: c.lower() for c in ("CRYPTO_ID", "WINDOW_START", "TRADE_COUNT")} | {"CLOSE_PRICE": "close"}).collect())


def candles(spark, rows):
    at = datetime.datetime(2024, 1, 1, 23, 58)
    full = [(i, at + datetime.timedelta(minutes=m), at + datetime.timedelta(minutes=m + 1), float(c), n) for i, m, c, n in rows]
    return spark.createDataFrame(full, ROW.replace("decimal(20,8)", "double")).withColumn("close", F.col("close").cast("decimal(20,8)"))


def test_upsert_inserts_updates_and_replays(spark, url):
    batch = database.upsert_jdbc(url, "candles", KEYS, names=NAMES, driver=DRIVER)
    first = candles(spark, [(i, m, 10 * i + m, 1) for i in range(1, 60) for m in range(5)])  # two dates in one batch, several batches of 100
    for _ in range(2):
        batch(first, 0)
    want = sorted((r["crypto_id"], r["window_start"], float(r["close"]), r["trade_count"]) for r in first.collect())
    assert rows_of(spark, url) == want
    batch(candles(spark, [(1, 0, 777, 9), (1, 4, 778, 9), (99, 0, 1, 1), (99, 0, 1, 1)]), 1)
    after = rows_of(spark, url)
    assert len(after) == len(want) + 1 and sum(r[2] in (777, 778) for r in after) == 2 and sum(r[0] == 99 for r in after) == 1
    batch(first, 0)  # an old batch again
    assert len(rows_of(spark, url)) == len(want) + 1
    with pytest.raises(Exception, match="key must be there"):
        batch(candles(spark, [(None, 0, 1, 1)]), 2)


def test_upsert_is_retried_and_resumes(spark, url, monkeypatch):
    rows, real, calls = candles(spark, [(i, 0, i, 1) for i in range(1, 41)]), database.execute, []

    def failing(spark, url, statements, properties):
        calls.append(statements)
        if len(calls) in (2, 3, 6):  # a part fails twice, another once; half of its work was done before
            real(spark, url, [*statements, "INSERT INTO no_such_table VALUES (1)"], properties)
        real(spark, url, statements, properties)

    monkeypatch.setattr(database, "execute", failing)
    database.upsert_jdbc(url, "candles", KEYS, pause=0.0, names=NAMES, driver=DRIVER)(rows, 0)
    assert len(calls) == 4 + 3 and len(rows_of(spark, url)) == 40

    def broken(spark, url, statements, properties):
        if '"part_" = 2' in statements[0]:
            statements = [*statements, "INSERT INTO no_such_table VALUES (1)"]
        calls.append(statements)
        real(spark, url, statements, properties)

    calls.clear()
    monkeypatch.setattr(database, "execute", broken)
    changed = rows.withColumn("trade_count", F.lit(2))
    with pytest.raises(Exception, match="NO_SUCH_TABLE"):
        database.upsert_jdbc(url, "candles", KEYS, pause=0.0, names=NAMES, driver=DRIVER)(changed, 1)
    assert len(calls) == 2 + 1 + database.RETRIES
    done = [r[3] for r in rows_of(spark, url)]
    assert len(done) == 40 and 0 < done.count(2) < 40  # parts before the broken one, in whole transactions
    monkeypatch.setattr(database, "execute", real)
    database.upsert_jdbc(url, "candles", KEYS, names=NAMES, driver=DRIVER)(changed, 1)  # the micro-batch is run again
    assert {r[3] for r in rows_of(spark, url)} == {2} and len(rows_of(spark, url)) == 40


def test_statements():
    names = {"k": "k", "a": "a", "close": '"close"'}
    merge = database.merge_statement("t", "s", names, ["k"], 3)
    assert merge == 'MERGE INTO t t USING s s ON s."part_" = 3 AND t.k = s."k" WHEN MATCHED AND s."part_" = 3 THEN UPDATE SET a = s."a", "close" = s."close" WHEN NOT MATCHED AND s."part_" = 3 THEN INSERT (k, a, "close") VALUES (s."k", s."a", s."close")'
    conflict = database.merge_statement("t", "s", {"k": "k", "a": "b"}, ["k"], 0, "on_conflict")
    assert conflict == 'INSERT INTO t (k, b) SELECT "k", "a" FROM s WHERE "part_" = 0 ON CONFLICT (k) DO UPDATE SET b = EXCLUDED.b'
    assert database.merge_statement("t", "s", {"k": "k"}, ["k"], 0, "on_conflict").endswith("DO NOTHING")
    with pytest.raises(ValueError):
        database.upsert_jdbc("u", "t", ["k"], dialect="other")


def test_stream_into_the_database(spark, url, tmp_path):
    """A stream with a restart, whose batches touch two dates, equals its rows."""
    folder = tmp_path / "in"
    for i, rows in enumerate([[(1, 0, 1, 1), (1, 3, 2, 1)], [(1, 3, 5, 2), (2, 4, 7, 1)]]):
        candles(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(ROW).parquet(str(folder))
        query = sinks.start(stream, str(tmp_path / "check"), database.upsert_jdbc(url, "candles", KEYS, names=NAMES, driver=DRIVER), every=None)
        query.awaitTermination(120)
        assert query.exception() is None
    assert [(r[0], r[2], r[3]) for r in rows_of(spark, url)] == [(1, 1.0, 1), (1, 5.0, 2), (2, 7.0, 1)]


def test_database_scan(spark, url):
    dimension = symbol_dimension(spark, SF)
    records = ohlc.candle_records(ohlc.ohlc(event_ticks(spark, SF), "1 hour"), dimension)
    records = records.select("crypto_id", F.col("window_start").cast("timestamp").alias("window_start"), F.col("window_end").cast("timestamp").alias("window_end"), "close", F.col("trade_count").cast("int").alias("trade_count"))
    database.upsert_jdbc(url, "candles", KEYS, names=NAMES, driver=DRIVER)(records, 0)
    scan = jdbc_table(spark, url, "candles", "window_start", partitions=4, driver=DRIVER)
    assert scan.rdd.getNumPartitions() == 4
    lower = scan.toDF(*[c.lower().replace("close_price", "close") for c in scan.columns])
    assert lower.exceptAll(records).count() == records.exceptAll(lower).count() == 0
    sizes = [r["count"] for r in scan.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2
    some = jdbc_table(spark, url, "candles", "crypto_id", ("1", "5"), 2, driver=DRIVER).where("CRYPTO_ID = 3 AND CLOSE_PRICE > 100").select("CLOSE_PRICE")
    text = plan(some)
    assert "PushedFilters: [*IsNotNull(CRYPTO_ID), *IsNotNull(CLOSE_PRICE), *EqualTo(CRYPTO_ID,3), *GreaterThan(CLOSE_PRICE," in text and "ReadSchema: struct<CLOSE_PRICE:decimal(20,8)>" in text
    assert some.count() == records.where("crypto_id = 3 AND close > 100").count()
    read = jdbc_catalog(spark, "market" + uuid.uuid4().hex[:6], url, driver=DRIVER)
    table = read("APP.CANDLES")
    counted = table.groupBy("CRYPTO_ID").agg(F.count(F.lit(1)).alias("n"), F.max("CLOSE_PRICE").alias("top"))
    assert "PushedAggregates: [COUNT(*), MAX(CLOSE_PRICE)]" in plan(counted)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, records.groupBy("crypto_id").agg(F.count(F.lit(1)), F.max("close")).collect()))
    assert jdbc_table(spark, url, "candles", "trade_count", driver=DRIVER).where("1 = 0").count() == 0
    database.execute(spark, url, ["DELETE FROM candles"], {"driver": DRIVER})
    assert jdbc_table(spark, url, "candles", "crypto_id", driver=DRIVER).count() == 0


# files


def test_a_large_day_gives_several_files_and_lookups_skip(spark, tmp_path):
    """A day with a million rows: several files, and a lookup by key reads a part of the row groups."""
    day = spark.range(1_000_000).select((F.col("id") % 500).alias("crypto_id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 86400)").alias("window_start"), F.sha1(F.col("id").cast("string")).alias("body"))
    small = day.limit(50).withColumn("window_start", F.expr("window_start + INTERVAL '1' DAY"))
    path = str(tmp_path / "t")
    tables.write_by_date(day.unionByName(small), path, "window_start", "crypto_id", file_rows=200_000, group_bytes=1 << 20)
    files = [len(list((tmp_path / "t" / f"date=2024-01-0{d}").glob("part-*"))) for d in (1, 2)]
    assert 5 <= files[0] <= 8 and files[1] == 1
    found = spark.read.parquet(path).where("date = '2024-01-01' AND crypto_id = 250")
    assert found.count() == 2000
    rows = found.select("body")
    rows.collect()
    scanned = [n for n in rows._jdf.queryExecution().executedPlan().collectLeaves().mkString("\n").splitlines()]
    assert scanned
    metrics = rows._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert 2000 <= metrics.apply("numOutputRows").value() < 150_000  # of a million
    import pyarrow.parquet as pq

    groups = [pq.ParquetFile(f).metadata for f in (tmp_path / "t" / "date=2024-01-01").glob("part-*")]
    assert sum(g.num_row_groups for g in groups) > len(groups)


def test_retention_drops_folders_and_rewrites_only_the_boundary(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    ticks = spark.range(10 * 24).select(F.col("id").alias("tick_id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, id)").alias("ts"), F.lit("x").alias("symbol"))
    path = tmp_path / "ticks"
    tables.write_by_date(ticks, str(path), "ts", "symbol")
    files = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("part-*")}
    before, end = files(), start + datetime.timedelta(days=10, hours=6)
    dropped = tables.drop_older(spark, str(path), "ts", 7, end)
    assert dropped == ["2024-01-01", "2024-01-02", "2024-01-03"]
    after = files()
    young = {f: t for f, t in before.items() if f.parent.name > "date=2024-01-04"}
    assert {f: t for f, t in after.items() if f.parent.name > "date=2024-01-04"} == young
    assert {f.parent.name for f in after} == {f"date=2024-01-{d:02}" for d in range(4, 11)}
    left = spark.read.parquet(str(path))
    cut = end - datetime.timedelta(days=7)
    assert left.count() == ticks.where(F.col("ts") >= F.lit(cut).cast("timestamp_ntz")).count() and left.agg(F.min("ts")).first()[0] == cut
    assert tables.drop_older(spark, str(path), "ts", 7, end) == [] and files() == after
    # A run that ended between deleting and moving goes on from the staged rows.
    edge, kept = path / "date=2024-01-04", Path(f"{path}__kept") / "2024-01-04"
    kept.parent.mkdir()
    edge.rename(kept)
    (kept / "_SUCCESS").touch()
    assert tables.drop_older(spark, str(path), "ts", 7, end) == [] and spark.read.parquet(str(path)).count() == left.count() and not kept.exists()
    assert tables.drop_older(spark, str(tmp_path / "none"), "ts", 7, end) == []
