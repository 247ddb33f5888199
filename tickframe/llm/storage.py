"""Shared scratch tables and size probes used by the corpus operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the session's ``spark.checkpoint.dir``.

    Where that is unset, a session within one process (as in tests) gets a temporary folder; on a cluster it is an error,
    as each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage there."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and text bytes of a corpus; partition counts are derived from them."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def bucket_count(n_bytes: int, per_bucket: int = 4 << 20, least: int = 256) -> int:
    """Power of two of hash buckets, so that one bucket covers about ``per_bucket`` bytes of text at any corpus size."""
    want = max(least, -(-n_bytes // per_bucket))
    return 1 << (want - 1).bit_length()


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most ``most_rows`` rows, else unhinted (a shuffled join)."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


#: Rows and bytes in a batch that goes to Python. Spark's defaults of 10,000 rows and 64 MB suit short rows; texts are long.
#: A longer row is a batch of its own.
TEXTS_A_BATCH, BYTES_A_BATCH = 1000, 4 << 20


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, in a session that hands texts to Python in small batches, unless it was told sizes of its own."""
    conf = docs.sparkSession.conf
    rows, size = (f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    if conf.get(rows, "10000") == "10000":
        conf.set(rows, str(TEXTS_A_BATCH))
    if conf.get(size) in ("64MB", "67108864", "67108864b"):
        conf.set(size, f"{BYTES_A_BATCH}b")
    return docs
