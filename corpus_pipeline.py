"""A training-corpus pipeline: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.fmindex import decontaminate
from tickframe.llm.linededup import dedup_lines
from tickframe.llm.packing import pack_documents
from tickframe.llm.paritysketch import near_duplicates
from tickframe.llm.queries import table, vocabulary_path
from tickframe.llm.storage import scratch_dir
from tickframe.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    scored = score_toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), keep_text=True)
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share."""
    kept = dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))).select("doc_id", "text", "lang", "source", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates."""
    firsts = near_duplicates(docs).where("doc_id <> component_id").select("doc_id")
    return docs.select(*COLUMNS).join(firsts, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).where("not contaminated").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, placed in sequences."""
    return pack_documents(docs, Path(vocabulary_path("word_bpe_49k.json")).read_text(encoding="utf-8"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
