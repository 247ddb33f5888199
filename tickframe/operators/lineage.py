"""Cutting lineage between the rounds of an operator that runs in several."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a folder of its own under the session's ``spark.checkpoint.dir``, and read back.

    So it can be read after executors are lost, and its size is known to the joins that follow. Where the setting is
    missing, a session within one process (as in tests) gets a temporary folder; on a cluster it is an error, as each
    executor would write to a disk of its own. The folders stay until the checkpoint folder is cleared.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/rounds-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
