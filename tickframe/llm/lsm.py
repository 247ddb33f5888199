"""Exact deduplication over a log-structured merge index of text digests.

Each task is a memtable: it sorts its (digest, doc_id) entries, spilling as it must, and flushes them as one sorted run
without a shuffle. Compaction merges the runs of a level into one of the next and keeps each digest's smallest identifier
and its count. A run that compaction writes has a filter, a table of bitmaps over the digests that several entries hold;
lookups test it first, so that only its hits are joined with the run. Documents under a digest that another document
holds as well are verified by comparing their bytes with the keeper's. DataFrame functions do all the work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import materialize, scratch_dir

Digest = Callable[[Column], Column]
#: Keys, and rows of a filter's bitmaps (4 KB each), are broadcast if there are at most so many.
BROADCAST_KEYS, BROADCAST_BITMAPS = 1_000_000, 4096
#: Bits of a bitmap as Spark builds it, and those of a filter for each digest in it.
BITMAP_BITS, BITS_A_KEY = 32_768, 16
#: Runs of a level that compaction merges into one of the next level.
FANOUT = 4


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalize_spaces(text: Column) -> Column:
    """Null is empty; each run of space, tab, newline, vertical tab, form feed, carriage return becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class BitmapFilter:
    """A one-hash Bloom filter of digests: a table of bitmaps by segment."""

    def __init__(self, keys: DataFrame):
        n = keys.count()
        self.segments = 1 << max(0, -(-n * BITS_A_KEY // BITMAP_BITS) - 1).bit_length()
        segment, bit = self._place()
        placed = keys.select(segment.alias("segment"), bit.alias("bit"))
        self.bitmaps = materialize(placed.groupBy("segment").agg(F.bitmap_construct_agg("bit").alias("bits")), "filter")

    def _place(self) -> tuple[Column, Column]:
        h = F.xxhash64("digest")
        return F.pmod(h, F.lit(self.segments)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(BITMAP_BITS))

    def test(self, entries: DataFrame) -> DataFrame:
        """``entries`` with ``maybe``: whether the filter may hold the digest."""
        segment, bit = self._place()
        bitmaps = F.broadcast(self.bitmaps) if self.segments <= BROADCAST_BITMAPS else self.bitmaps
        byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        set_ = F.getbit(byte, F.pmod("bit", F.lit(8)).cast("int")) == 1
        joined = entries.withColumns({"segment": segment, "bit": bit}).join(bitmaps, "segment", "left")
        return joined.withColumn("maybe", F.coalesce(set_, F.lit(False))).drop("segment", "bit", "bits")


class DigestIndex:
    """Runs of sorted digests by level, under one folder of the cluster's shared storage."""

    def __init__(self, spark, root: str | None = None):
        self.spark, self.root = spark, root or scratch_dir(spark)
        self.levels: list[list[str]] = [[]]
        self.runs = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.root}/level={level}/run={self.runs}"
        self.runs += 1
        writer = rows.select("digest", "keep_id", "n").sortWithinPartitions("digest").write
        writer.option("parquet.bloom.filter.enabled#digest", "true").option("parquet.enable.dictionary", "false").parquet(path)
        self.levels.extend([] for _ in range(level + 1 - len(self.levels)))
        self.levels[level].append(path)

    def read(self, level: int | None = None) -> DataFrame:
        """digest, keep_id, n of the runs of a level, or of all."""
        paths = self.levels[level] if level is not None else [p for runs in self.levels for p in runs]
        return self.spark.read.schema("digest binary, keep_id long, n long").parquet(*paths)

    def flush(self, entries: DataFrame) -> None:
        """Add (digest, doc_id): each task flushes its memtable as a sorted run with a filter on the digest."""
        self._write(entries.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n")), 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= FANOUT:
                self._merge(level)

    def _merge(self, level: int) -> None:
        self._write(self._merged(self.read(level)), level + 1)
        self.levels[level] = []

    @staticmethod
    def _merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))

    def compact(self) -> None:
        """Merge all levels into one run of the last."""
        merged, last = self._merged(self.read()), len(self.levels)
        self._write(merged, last)
        self.levels = [[] for _ in range(last)] + [self.levels[last]]

    def table(self) -> DataFrame:
        """digest, keep_id, n of every digest, from the compacted run or from all runs."""
        return self.read() if sum(map(len, self.levels)) == 1 else self._merged(self.read())


def exact_dedup(docs: DataFrame, normalize: Callable[[Column], Column] = normalize_spaces, digest: Digest = sha256) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; null counts as empty. The smallest doc_id of a group stays
    (``keep_id``), ``group_size`` counts its rows. Rows that repeat a doc_id with the same text are all marked kept when
    that doc_id stays. A null doc_id is larger than any other: it stays only in a group without another, where keep_id is
    null and all rows are kept. ``digest`` may collide: rows under a digest that several hold are compared byte for byte
    with the keeper, and rows that differ are grouped by their text. Other columns are not read; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", normalize(F.col("text")).alias("norm"))
    entries = materialize(keyed.select(digest(F.col("norm")).alias("digest"), "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha")), "entries")
    index = DigestIndex(spark)
    index.flush(entries)
    index.compact()
    shared = materialize(index.table().where("n > 1"), "shared")
    tested = BitmapFilter(shared).test(entries)
    looked_up = tested.where("maybe").join(shared.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d"), "left")
    alone = tested.where("not maybe").select("doc_id", "sha").unionByName(looked_up.where("d is null").select("doc_id", "sha"))
    lone = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    # Only documents under a digest with several entries are read again for the byte comparison.
    ids = looked_up.where("d is not null").select(F.col("doc_id").alias("hit_id")).distinct()
    small = ids.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    again = keyed.join(F.broadcast(ids) if small else ids, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
    again = again.withColumn("digest", digest(F.col("norm")))
    # Keepers are found by digest and identifier and written first, so that a digest with very many rows is joined with
    # one row in a join of its own, which Spark can split.
    first = shared.select(F.col("digest").alias("d"), "keep_id")
    found = again.join(first, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keepers = materialize(found.groupBy("digest").agg(F.min("norm").alias("keep_norm")), "keepers")
    same = F.col("norm") == F.col("keep_norm")
    verdicts = again.join(keepers, "digest").select(
        "digest", "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"), same.alias("same"), F.when(~same, F.col("norm")).otherwise("").alias("other")
    )
    verdicts = materialize(verdicts, "verified")
    # Rows that only share the digest are grouped by their own text; for true copies ``other`` is empty.
    group = ["digest", "same", "other"]
    sizes = materialize(verdicts.groupBy(*group).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "sizes")
    grouped = verdicts.join(sizes, group).select("doc_id", "keep_id", "group_size", "sha")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return lone.unionByName(grouped).select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
