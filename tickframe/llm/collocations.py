"""Phrase collocations from a prefix-free parse of the corpus.

Every text is cut by content: a window of as many words as the longest phrase has, less one, whose hash is divisible by
``SPACING`` ends one chunk and starts the next, so that neighbours overlap by that window. Equal passages give equal chunks
wherever they lie. The chunks form a dictionary with the number of times that the parse uses each; phrases are counted inside
distinct chunks only, times that number. A phrase belongs to the chunk in which it starts before the last window, or anywhere
in a text's last chunk, so an overlap counts once.

Phrases are counted by length. One of k words can be frequent only where both its parts of k - 1 words are, so a Bloom filter
of the frequent ones spares the shuffle most of the rare; what passes it wrongly is told by its exact count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.storage import in_small_batches, materialize
from tickframe.llm.textbatch import lean, mix, slices, to_bytes_array, word_hash

U64 = np.uint64
#: A window of words is a trigger once in so many times; chunks have at most ``LONGEST`` words of their own.
SPACING, LONGEST = 32, 512
#: Bytes of chunks whose phrases are counted together in a task before they go to the shuffle, and rows that it sends at once.
BATCH_BYTES, SLICE_ROWS = 1 << 22, 1 << 16
#: Bits of a filter for each frequent phrase, and at most; a fuller filter lets more rare phrases into the shuffle. It is kept,
#: sent and collected in segments.
BITS_EACH, MOST_BITS, SEGMENT_BITS = 16, 1 << 29, 1 << 20
#: Parts of a language that are ranked apart in the first round.
RANK_SALTS = 32

#: Bytes that end a piece, and bytes that end a word.
PIECE_END = np.array([chr(b) in ".,;:!?\n\v\f\r" for b in range(256)])
WORD_END = PIECE_END | np.array([chr(b) in " \t" for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

CHUNKS = "lang string, chunk string, last boolean"
COUNTS = "lang string, phrase string, f long"


def edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    steps = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def substrings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[start:end] for each pair; they may overlap."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[places])).cast(pa.string())


def cuts(words: np.ndarray, row: np.ndarray, overlap: int) -> np.ndarray:
    """First words of all chunks, from the words' hashes and rows."""
    n, fresh = len(words), np.diff(row, prepend=-1) > 0
    windows = words.copy()
    for k in range(1, overlap):
        windows[: n - k] = mix(windows[: n - k] * U64(31) + words[k:])
    whole = np.zeros(n, bool)  # windows that end in the row in which they start
    whole[: n - overlap + 1] = row[: n - overlap + 1] == row[overlap - 1 :]
    again = np.append(False, windows[1:] == windows[:-1])  # a run of one word is no trigger after trigger
    first = fresh | (whole & ~again & (mix(windows) % U64(SPACING) == 0))
    # A stretch without triggers is cut by length.
    at = np.flatnonzero(first)
    since = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return np.flatnonzero(first | (whole & (since % LONGEST == 0)))


def parse_task(overlap: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lines(batch.column("text"))
            for first_row, _, raw, rows in slices(data, offsets):
                low = LOWER[raw]
                ended = WORD_END[low]
                starts, ends = edges(~ended)
                if not len(starts):
                    continue
                row = np.searchsorted(rows, starts, "right") - 1
                first = cuts(word_hash(low, starts, ends, fold_case=False), row, overlap)
                own = np.append(first[1:], len(starts))
                last = np.append(row[own[:-1]] != row[own[:-1] - 1], True)
                upto = np.where(last, own, own + overlap)
                # Words with one byte between them: a space, or a line end where a piece ends.
                marks = np.cumsum(PIECE_END[low])[starts]
                flat, kept = np.where(ended, 0x20, low).astype(np.uint8), ~ended
                flat[ends[:-1][np.diff(marks) > 0]] = 0x0A
                kept[ends] = True
                place = np.append(0, np.cumsum(ends - starts + 1))
                lang = batch.column("lang").take(pa.array(row[first] + first_row))
                yield pa.RecordBatch.from_arrays([lang, substrings(flat[kept], place[first], place[upto] - 1), pa.array(last)], names=["lang", "chunk", "last"])

    return run


def lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of the texts, each with a line end after it."""
    whole = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    data, offsets = to_bytes_array(whole)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def seeds(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(n) for n in names], np.uint64)


def phrase_hash(words: np.ndarray, seed: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, from their hashes and the seeds of their languages."""
    n = max(0, len(words) - k + 1)
    found = mix(words[:n] ^ seed[:n])
    for j in range(1, k):
        found = mix(found * U64(31) + words[j : n + j])
    return found


class Filter:
    """Bloom filter with two hashes, each within the same segment; no bits let everything pass."""

    def __init__(self, bits: int, segments: dict[int, bytes] | None):
        self.bits, size = bits, min(bits, SEGMENT_BITS) // 8
        self.data = None if segments is None else np.frombuffer(b"".join(segments.get(i, bytes(size)) for i in range(max(1, bits // SEGMENT_BITS))), np.uint8)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        return (hashes % U64(bits)).astype(np.int64), (mix(hashes) % U64(bits)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.data is None:
            return np.ones(len(hashes), bool)
        one, two = self.places(hashes, self.bits)
        return ((self.data[one >> 3] >> (one & 7).astype(np.uint8)) & (self.data[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)


def filter_places(k: int, bits: int) -> Callable:
    """Task function: the filter's bits of phrases of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = lines(batch.column("phrase"))
            starts, ends = edges((data != 0x20) & (data != 0x0A))
            names = batch.column("lang").dictionary_encode()
            seed = np.repeat(seeds(names.dictionary.to_pylist())[names.indices.to_numpy()], k)
            hashes = phrase_hash(word_hash(data, starts, ends, fold_case=False), seed, k)[::k]
            both = np.concatenate(Filter.places(hashes, bits))
            yield pa.RecordBatch.from_arrays([pa.array((both // SEGMENT_BITS).astype(np.int32)), pa.array((both % SEGMENT_BITS).astype(np.int32))], names=["segment", "place"])

    return run


def segment_bits(bits: int) -> Callable:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        marks = np.zeros(min(bits, SEGMENT_BITS), np.uint8)
        marks[rows.column("place").to_numpy()] = 1
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()])})

    return run


def frequent_filter(often: DataFrame, k: int) -> Filter:
    """The filter of the phrases of k words in ``often``: at most MOST_BITS reach the driver."""
    bits = min(MOST_BITS, 1 << (max(8, BITS_EACH * often.count()) - 1).bit_length())
    places = often.select("lang", "phrase").mapInArrow(lean(filter_places(k, bits)), "segment int, place int").distinct()
    return Filter(bits, {r["segment"]: bytes(r["bits"]) for r in places.groupBy("segment").applyInArrow(segment_bits(bits), "segment int, bits binary").collect()})


def phrase_counts(langs: list[str], lang: np.ndarray, chunks: pa.Array, last: np.ndarray, times: np.ndarray, k: int, most: int, known: Filter) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(languages, phrases, counts) of the phrases of k words in distinct chunks whose parts ``known`` may hold, in slices."""
    data, offsets = lines(chunks)
    starts, ends = edges((data != 0x20) & (data != 0x0A))
    n, chunk = len(starts), np.searchsorted(offsets, starts, "right") - 1
    final = np.searchsorted(chunk, np.arange(len(offsets) - 1), "right")  # where a chunk's words end
    own = np.arange(n) < final[chunk] - np.where(last[chunk], 0, most - 1)
    if n < k:
        return
    piece = np.cumsum(data == 0x0A)[starts]
    good = own[: n - k + 1] & (piece[: n - k + 1] == piece[k - 1 :])
    if k > 1:
        parts = known.has(phrase_hash(word_hash(data, starts, ends, fold_case=False), seeds(langs)[lang[chunk]], k - 1))
        good &= parts[:-1] & parts[1:]
    at = np.flatnonzero(good)
    if not len(at):
        return
    words = substrings(data, starts, ends).dictionary_encode()
    code, width = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
    # A phrase has the dense code of its beginning, then its last word's, both below 2**31: equal codes are equal phrases.
    base = code[at] + width * lang[chunk[at]].astype(np.int64)
    for j in range(1, k):
        base = np.unique(base, return_inverse=True)[1].astype(np.int64) * width + code[at + j]
    order = np.argsort(base)
    head = np.flatnonzero(np.diff(base[order], prepend=-1))
    sums = np.add.reduceat(times[chunk[at]][order], head)
    some = at[order[head]]
    for i in range(0, len(some), SLICE_ROWS):
        few = some[i : i + SLICE_ROWS]
        yield lang[chunk[few]], substrings(data, starts[few], ends[few + k - 1]), sums[i : i + SLICE_ROWS]


def count_task(k: int, most: int, known: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            names = table.column("lang").combine_chunks().dictionary_encode()
            arrays = names.indices.to_numpy(), table.column("chunk").combine_chunks(), table.column("last").to_numpy(), table.column("f").to_numpy()
            for lang, phrases, sums in phrase_counts(names.dictionary.to_pylist(), *arrays, k, most, known.value):
                yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(lang)), phrases, pa.array(sums)], names=["lang", "phrase", "f"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("chunk").nbytes
            if size >= BATCH_BYTES:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)

    return run


def phrase_tables(docs: DataFrame, most: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n) with the words of each language, and (lang, words, phrase, f) of the phrases that occur ``least`` times."""
    sc = docs.sparkSession.sparkContext
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    parsed = in_small_batches(docs).select(lang, "text").mapInArrow(lean(parse_task(most - 1)), CHUNKS)
    dictionary = materialize(parsed.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("f")), "dictionary")
    totals, tables, known = None, [], Filter(8, None)
    for k in range(1, most + 1):
        counted = dictionary.mapInArrow(lean(count_task(k, most, sc.broadcast(known))), COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        counts = materialize(counted if k == 1 else counted.where(F.col("f") >= least), f"words{k}")
        totals = counts.groupBy("lang").agg(F.sum("f").alias("n")) if k == 1 else totals
        often = counts.where(F.col("f") >= least)
        tables.append(often.select("lang", F.lit(k).alias("words"), "phrase", "f"))
        known = frequent_filter(often, k) if k < most else known
    return totals, reduce(DataFrame.unionByName, tables)


def mine_collocations(docs: DataFrame, most_words: int = 3, least: int = 10, top: int = 2000, cover: int = 50) -> DataFrame:
    """The strongest phrases of each language of ``docs(text, lang, ...)``: lang, rank, phrase, a, l, r, n, score.

    Texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs, A-Z lower-cased. Candidates
    are phrases of 2 to ``most_words`` words with a = f(phrase) >= ``least``; cut after its first words into parts with counts
    l and r, a phrase scores floor(1000000 * a * a / (l * r)) by its lowest-scoring cut, ties to the earliest. A candidate goes
    when a longer candidate that holds its words has at least ``cover`` % of its count. n counts the language's words.
    ``top`` phrases of each language are kept, by score, then a, descending, then by the phrase's bytes.

    A null lang is ``und``; null and empty texts have no words; repeated rows count each time; other columns are not read, and
    rows need no doc_id; an empty table, or one without candidates, gives no rows. All arithmetic is in 38-digit decimals:
    counts up to 10^16 are exact. Texts of any length are cut into
    chunks of at most ``LONGEST`` words and the overlap; very long words are words.
    """
    if most_words < 2:
        raise ValueError("phrases have two words at least")
    n, often = phrase_tables(docs, most_words, least)
    candidates = often.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    listed = candidates.withColumn("w", F.split("phrase", " "))
    part = lambda a, b: F.array_join(F.slice("w", a, b), " ")
    cut = listed.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select("lang", "words", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    side = lambda name, f: often.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    valued = cut.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    scored = valued.withColumn("top", (a * a * F.lit(1_000_000)).cast("decimal(38,0)")).withColumn("below", (l * r).cast("decimal(38,0)")).withColumn("score", F.expr("top div below"))
    # The lowest score, then the smallest k, as one number.
    best = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("words").alias("words"), F.min_by(F.struct("l", "r", "score"), F.col("score") * most_words + F.col("k")).alias("best"))
    inner = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    covered = listed.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longest")).groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    kept = best.join(covered, ["lang", "phrase"], "left").where(F.coalesce(F.col("longest") * 100 < F.col("a") * cover, F.lit(True)))
    rows = kept.select("lang", "phrase", "a", "best.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Two rounds, so that no task ranks a whole language: at most RANK_SALTS * top rows of one meet in a task.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
