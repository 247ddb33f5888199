"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is the words that documents labelled toxic hold far more often than others, counted over the training rows;
the features are densities of lexicon words (all, in a row, near second-person pronouns), capitals, punctuation and
obfuscated words. Trees and calibration are fitted by Spark on the labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm.storage import in_small_batches, materialize
from tickframe.llm.textbatch import LONG_WORD, SLICE_BYTES, U64, lean, mix, running_hash, slices, substring_hash, to_bytes_array, word_spans

#: Fitting reads at most about so many labelled rows, half of them for each class, chosen by a hash of the doc_id; counts
#: for the lexicon read all.
FIT_ROWS = 50_000
LEXICON_WORDS = 500
#: Labels are broadcast to the texts if there are at most so many, else joined by shuffle.
BROADCAST_LABELS = 1_000_000
#: Second-person words of the corpus languages.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi vous votre du dich dir dein deine ihr euch usted ustedes tú".split())
#: Characters commonly written for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
LETTERS = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
MARKS = np.array([0x20 < b < 0x7F and not chr(b).isalnum() for b in range(256)])
CAPITALS = np.array([65 <= b <= 90 for b in range(256)])
#: Marks around a word.
EDGE_MARKS = ".,;:!?\"'()"
WORD = re.compile(r"[^\W_]+")
FEATURES = ["lexicon_rate", "lexicon_hits", "lexicon_distinct", "lexicon_weight", "second_person_rate", "near_second_person", "caps_rate", "shout_rate", "punctuation_rate", "exclaim_rate", "obfuscated_rate", "obfuscated_hits", "log_words"]


#: Letters, digits and white space are all below this code point.
MOST_LETTERS = 0x40000


class _Letters:
    """What is known of each code point, as arrays; made when first needed, as it takes a while."""

    def __init__(self) -> None:
        chars = [chr(c) for c in range(MOST_LETTERS)]

        def which(test) -> np.ndarray:
            return np.append(np.fromiter(map(test, chars), bool, MOST_LETTERS), np.zeros(0x110000 - MOST_LETTERS, bool))

        self.word, self.alpha, self.upper, self.visible = which(str.isalnum), which(str.isalpha), which(str.isupper), ~which(str.isspace)
        self.small = (which(str.islower) | which(str.istitle)) & ~self.upper
        self.inner = self.visible.copy()
        self.inner[[ord(c) for c in EDGE_MARKS]] = False
        low = np.arange(0x110000, dtype=np.uint64)
        cased = np.flatnonzero(self.upper | which(str.istitle))
        low[cased] = [ord(fold(chars[c])) for c in cased]
        #: Equal for capitals and small letters.
        self.value = mix((low + U64(1)) * U64(0x9E3779B97F4A7C15))
        #: The same with lookalikes as the letters they are written for, and which characters then stay in a word.
        self.plain, self.stays = self.value.copy(), self.word.copy()
        self.plain[list(LOOKALIKES)] = self.value[[ord(fold(chr(c) if isinstance(c, int) else c)) for c in LOOKALIKES.values()]]
        self.stays[[ord("_"), *LOOKALIKES]] = True

    def hashes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word, folded; the running hash is kept for a stretch of the text at a time."""
        found, i = np.empty(len(starts), np.uint64), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE_BYTES)))
            low, high = starts[i], min(ends[j - 1], starts[j - 1] + LONG_WORD)
            found[i:j] = substring_hash(running_hash(self.value[codes[low:high]]), starts[i:j] - low, np.minimum(ends[i:j], high) - low)
            i = j
        for i in np.flatnonzero(ends - starts >= LONG_WORD):
            found[i] = xxhash.xxh3_64_intdigest(fold(codes[starts[i] : ends[i]].tobytes().decode("utf-32-le")))
        return found


letters = cache(_Letters)


def fold(text: str) -> str:
    """Lower case, letter by letter: the two letters whose small form has two letters or depends on the word are simple."""
    return text.replace("\u0130", "i").replace("\u03a3", "\u03c3").lower()


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of folded words, in their order."""
    if not words:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return letters().hashes(codes, np.append(0, ends[:-1]), ends)


class Lexicon:
    """Lexicon words and second-person words by hash, for lookups of many words at once."""

    def __init__(self, words: dict[str, float]) -> None:
        self.words = words
        found = word_hashes(list(words))
        order = np.argsort(found)
        self.known, self.weight = found[order], np.array(list(words.values()), np.float64)[order]
        self.you = np.sort(word_hashes(sorted(SECOND_PERSON)))

    def may_hide(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which of these stretches are a lexicon word by hash, read without marks and with lookalikes as letters."""
        table, size = letters(), ends - starts
        short = np.flatnonzero(size < LONG_WORD)
        size, first = size[short], starts[short]
        edges = np.append(0, np.cumsum(size))
        taken = codes[np.arange(edges[-1]) + np.repeat(first - edges[:-1], size)]
        stays = table.stays[taken]
        edges = np.append(0, np.cumsum(stays))[edges]
        may = np.ones(len(starts), bool)
        may[short] = position(self.known, substring_hash(running_hash(table.plain[taken[stays]]), edges[:-1], edges[1:]))[1]
        return may

    def hides(self, raw: str) -> bool:
        """Whether marks or characters written for letters hide a lexicon word."""
        plain = re.sub(r"[^\w]", "", fold(raw.strip(EDGE_MARKS)).translate(LOOKALIKES))
        return plain in self.words and plain != fold(raw.strip(EDGE_MARKS + "#*%&$"))


def position(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each x is in the sorted values, and whether it is there at all."""
    if not len(sorted_values):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return at, sorted_values[at] == x


def between(places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the ascending places lie in each [start, end)."""
    return np.searchsorted(places, ends) - np.searchsorted(places, starts)


def feature_rows(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Dense features of the texts data[offsets[i]:offsets[i + 1]], a row for each; an empty text has zeros."""
    table, n_rows = letters(), len(offsets) - 1
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    rows = list(zip(offsets[:-1], offsets[1:], strict=True))

    def per_row(mask: np.ndarray) -> np.ndarray:
        return np.array([np.count_nonzero(mask[a:b]) for a, b in rows], np.int64)

    at_code = np.append(0, np.cumsum(per_row((data & 0xC0) != 0x80)))
    starts, ends, before = word_spans(codes, at_code, table.word)
    n_words = np.diff(before)
    row_of = np.repeat(np.arange(n_rows), n_words)
    hashes = table.hashes(codes, starts, ends)

    entry, hit = position(lexicon.known, hashes)
    at, you = np.flatnonzero(hit), np.flatnonzero(position(lexicon.you, hashes)[1])
    close = np.zeros(len(at), bool)
    if len(you):
        gap = np.searchsorted(you, at)
        for other in (you[np.maximum(gap - 1, 0)], you[np.minimum(gap, len(you) - 1)]):
            close |= (row_of[other] == row_of[at]) & (np.abs(other - at) <= 5)
    distinct = np.unique(row_of[at] * max(1, len(lexicon.known)) + entry[at])
    distinct_row, distinct_entry = np.divmod(distinct, max(1, len(lexicon.known)))
    shout = (ends - starts > 2) & (between(np.flatnonzero(table.upper[codes]), starts, ends) > 0)
    shout[shout] = between(np.flatnonzero(table.small[codes]), starts[shout], ends[shout]) == 0

    # Only what is not all letters between its outer marks can hide a word.
    raw_start, raw_end, raw_before = word_spans(codes, at_code, table.visible)
    inner = np.flatnonzero(table.inner[codes])
    first, last = np.searchsorted(inner, raw_start), np.searchsorted(inner, raw_end) - 1
    suspect = np.flatnonzero(first <= last)
    low, high = inner[first[suspect]], inner[last[suspect]] + 1
    odd = between(np.flatnonzero(~table.alpha[codes]), low, high) > 0
    suspect = suspect[odd][lexicon.may_hide(codes, low[odd], high[odd])]
    hiding = [i for i in suspect if lexicon.hides(codes[raw_start[i] : raw_end[i]].tobytes().decode("utf-32-le"))]

    def count(of: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, weights, n_rows).astype(np.float64)

    words, size = np.maximum(n_words, 1), np.maximum(np.diff(offsets), 1)
    hits, hidden = count(row_of[at]), count(np.searchsorted(raw_before, np.array(hiding, np.int64), "right") - 1)
    return np.stack(
        [
            hits / words, hits, count(distinct_row), count(distinct_row, lexicon.weight[distinct_entry]), count(row_of[you]) / words, count(row_of[at[close]]) / words,
            per_row(CAPITALS[data]) / np.maximum(per_row(LETTERS[data]), 1), count(row_of[shout]) / words,
            per_row(MARKS[data]) / size, per_row(data == 33) / size, hidden / words, hidden, np.log1p(n_words),
        ],
        axis=1,
    )


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """Dense features of one text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return feature_rows(data, np.array([0, len(data)]), Lexicon(lexicon))[0].tolist()


def extract(lexicon):
    """Task function: puts the features of ``text`` in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(lexicon.value)
        for batch in batches:
            data, offsets = to_bytes_array(batch.column("text"))
            parts = [feature_rows(chunk, at, known) for _, _, chunk, at in slices(data, offsets)]
            rows = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            keep = [n for n in batch.schema.names if n != "text"]
            added = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(rows.shape[1])]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *added], names=[*keep, *FEATURES])

    return run


def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, other documents) of a task's labelled rows."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for word in set(WORD.findall(fold(text or ""))):
                counts.setdefault(word, [0, 0])[0 if toxic else 1] += 1
        if len(counts) > 500_000:
            yield from _word_rows(counts)
            counts = {}
    yield from _word_rows(counts)


def _word_rows(counts: dict[str, list[int]]) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "pos": pa.array([c[0] for c in counts.values()], pa.int64()), "neg": pa.array([c[1] for c in counts.values()], pa.int64())})


def learn_lexicon(labelled: DataFrame, counts: dict[int, int], size: int = LEXICON_WORDS) -> dict[str, float]:
    """The ``size`` words most telling of toxic documents, with their log-odds; every labelled row is counted."""
    pos, neg = counts[1], counts[0]
    least = max(min(5, pos), pos // 200)
    rows = labelled.select("text", (F.col("toxic") == 1).alias("toxic")).mapInArrow(lean(distinct_words), "word string, pos long, neg long")
    words = rows.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    top = words.where(F.col("pos") >= least).withColumn("odds", odds).where("odds > 2.5").orderBy(F.desc("odds"), F.desc("pos"), "word").limit(size)
    return {r["word"]: r["odds"] for r in top.collect()}


def is_held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def fitting_sample(labelled: DataFrame, counts: dict[int, int], fit_rows: int) -> DataFrame:
    """At most about ``fit_rows`` labelled rows, half of them for each class, or all rows of a class that has fewer.

    Adds ``weight``, how many rows of its class a row stands for, and ``calibrates``, true for about a quarter of each
    class; a class with fewer than eight rows both fits and calibrates.
    """
    shares = {k: min(1.0, max(fit_rows - min(fit_rows // 2, counts[1 - k]), 1) / counts[k]) for k in (0, 1)}
    luck = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])
    few = F.when(F.col("toxic") == 1, counts[1] < 8).otherwise(counts[0] < 8)
    picked = labelled.where(luck < share).withColumn("weight", 1 / share)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4))
    return picked.withColumn("calibrates", few | (fold == 0)).withColumn("fits", few | (fold != 0))


def fit(labelled: DataFrame, counts: dict[int, int], sent, fit_rows: int, trees: int):
    """Trees and calibration fitted on a sample of ``labelled``; a function from features to ``calibrated`` and ``raw``."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = fitting_sample(labelled, counts, fit_rows).select("text", F.col("toxic").cast("double").alias("toxic"), "weight", "calibrates", "fits")
    rows = sample.mapInArrow(lean(extract(sent)), "toxic double, weight double, calibrates boolean, fits boolean, " + FEATURE_TYPES)
    # Spark ML sums statistics a partition at a time; the sample is bounded by ``fit_rows``, so a few partitions hold it.
    rows = assembler.transform(materialize(rows, "fit").coalesce(8)).select("toxic", "weight", "calibrates", "fits", "features")
    learn, calibrate = rows.where("fits").cache(), rows.where("calibrates")
    if calibrate.select("toxic").distinct().count() < 2:  # chance left a small class out
        calibrate = rows
    model = GBTClassifier(labelCol="toxic", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=3, stepSize=0.2, seed=17, minInstancesPerNode=5)
    model = model.fit(learn if learn.select("toxic").distinct().count() == 2 else rows)

    def raw(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("raw", vector_to_array("probability")[1])

    isotonic = IsotonicRegression(labelCol="toxic", featuresCol="raw", weightCol="weight").fit(raw(calibrate).select("raw", "toxic", "weight"))
    learn.unpersist()
    return lambda df: isotonic.setPredictionCol("calibrated").transform(raw(assembler.transform(df)))


FEATURE_TYPES = ", ".join(f"{f} double" for f in FEATURES)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, fit_rows: int = FIT_ROWS, trees: int = 20, keep_text: bool = False) -> DataFrame:
    """Score every row of ``docs(doc_id, text, ...)``, learning from ``labels(doc_id, toxic)``.

    Returns the rows' columns (the text only with ``keep_text``), with held_out, score (0 to 1, higher: toxic likelier)
    and predicted (score at least ``threshold``); columns of ``docs`` with these three names are replaced, all others
    stay, whatever their names. Rows with crc32(doc_id) mod 3 = 1 are never learnt from. Null and empty texts have zero
    features and get a score. Rows without a label, or without a doc_id, are only scored; of repeated labels the highest
    counts. Where the labelled rows lack a class nothing can be told apart: every score is the share of toxic ones among
    them, (toxic + 1) / (rows + 2). Fitting reads at most about ``fit_rows`` rows, half of them for each class.
    """
    docs = in_small_batches(docs).drop("held_out", "score", "predicted")
    truth = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~is_held_out())
    n_labelled = truth.count()
    texts = docs.select("doc_id", "text")
    if n_labelled <= BROADCAST_LABELS:
        labelled = texts.join(F.broadcast(truth), "doc_id")
    else:
        labelled = materialize(texts.join(truth, "doc_id"), "labelled")
    labelled = labelled.withColumn("toxic", (F.col("toxic") == 1).cast("int"))
    counts = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    others = [c for c in docs.columns if keep_text or c != "text"]
    # The caller's columns go through the model as one struct, so that no name of theirs meets one of the model's.
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("given"), is_held_out().alias("held_out"), "text")
    if not (counts[0] and counts[1]):
        score = F.lit((counts[1] + 1) / (counts[0] + counts[1] + 2))
        return given.select("given.*", "held_out", score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(learn_lexicon(labelled, counts))
    model = fit(labelled, counts, sent, fit_rows, trees)
    schema = T.StructType([f for f in given.schema.fields if f.name != "text"] + [T.StructField(f, T.DoubleType()) for f in FEATURES])
    scored = model(given.mapInArrow(lean(extract(sent)), schema))
    # Calibration has steps; within a step the trees' own probability orders the rows.
    score = F.least(F.greatest(0.98 * F.col("calibrated") + 0.02 * F.col("raw"), F.lit(0.0)), F.lit(1.0))
    return scored.select("given.*", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
