"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents inside one task. Its words become symbols of the benchmark's vocabulary (any other word,
and any word in no benchmark word pair, is a separator), a wavelet matrix over the Burrows-Wheeler transform answers
rank queries, all test phrases are searched backwards at once, and sampled suffix positions locate the occurrences,
whose spans are merged per document.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm.storage import broadcast_if_small, in_small_batches, materialize
from tickframe.llm.textbatch import WORD_CHARS, lean, slices, to_bytes_array, word_hash, word_spans

#: Benchmark words searched at once, of which the phrases are broadcast (about 60 bytes a word); a larger benchmark is
#: searched in several passes, whose hits meet in a join.
BLOCK_WORDS = 1 << 18
#: Hits of several passes are broadcast to the texts if there are at most so many documents with any.
BROADCAST_HITS = 100_000
#: Words of a shard; a longer document makes a shard of its own.
SHARD_WORDS = 1 << 19
SAMPLE_EVERY = 8


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased, runs of letters, digits and non-ASCII bytes) and each row's word offset."""
    data, offsets = to_bytes_array(column)
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    total = 0
    for _, _, chunk, at in slices(data, offsets):
        starts, ends, before = word_spans(chunk, at, WORD_CHARS)
        parts.append(word_hash(chunk, starts, ends))
        counts.append(before[1:] + total)
        total += len(starts)
    return np.concatenate(parts), np.concatenate(counts)


@dataclass
class Phrases:
    """Test phrases of one block: their symbols in one array, and the items that hold each."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = place + 1
    pairs: np.ndarray  # sorted symbol pairs of all phrases
    single: np.ndarray  # symbols that are phrases alone
    symbols: np.ndarray
    offsets: np.ndarray
    item_of: np.ndarray  # for each (phrase, item): the item's number
    phrase_of: np.ndarray  # and the phrase
    items: list[str]


def build_phrases(items: list[str], hashes: np.ndarray, offsets: np.ndarray, window: int) -> Phrases:
    """Distinct windows of ``window`` words; an item of fewer words is one phrase."""
    vocabulary = np.unique(hashes)
    ids = np.searchsorted(vocabulary, hashes) + 1
    found: dict[bytes, int] = {}
    owners: set[tuple[int, int]] = set()
    texts: list[np.ndarray] = []
    for item in range(len(items)):
        own = ids[offsets[item] : offsets[item + 1]].astype(np.int64)
        for at in range(max(1, len(own) - window + 1) if len(own) else 0):
            phrase = own[at : at + window]
            number = found.setdefault(phrase.tobytes(), len(found))
            if number == len(texts):
                texts.append(phrase)
            owners.add((number, item))
    owned = np.array(sorted(owners), np.int64).reshape(-1, 2)
    lengths = np.array([len(t) for t in texts], np.int64)
    symbols = np.concatenate(texts) if texts else np.zeros(0, np.int64)  # windows overlap: one symbol stands in several
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    inside = np.ones(max(0, len(symbols) - 1), bool)
    inside[starts[1:-1] - 1] = False
    pairs = np.unique((symbols[:-1] << 32 | symbols[1:])[inside]) if len(symbols) > 1 else np.zeros(0, np.int64)
    return Phrases(vocabulary, pairs, np.unique(symbols[starts[:-1][lengths == 1]]), symbols, starts, owned[:, 1], owned[:, 0], items)


def member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order, by prefix doubling until no two share a rank."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        ahead = np.zeros(len(text), np.int64)
        ahead[: max(0, len(text) - length)] = rank[length:] + 1
        key = rank * (len(text) + 2) + ahead
        order = np.argsort(key, kind="stable")
        length *= 2
        if len(text) < 2:
            return order
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if step[-1] == len(text) - 1:
            return order
        rank[order] = step


class WaveletMatrix:
    """Rank and access over a symbol sequence, one bit level at a time."""

    def __init__(self, text: np.ndarray, bits: int):
        self.bits, self.zeros, self.rank0 = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (text >> level) & 1
            self.rank0.append(np.concatenate([[0], np.cumsum(1 - bit)]))
            self.zeros.append(int(self.rank0[-1][-1]))
            text = np.concatenate([text[bit == 0], text[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low = np.zeros_like(at)
        for level in range(self.bits):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            r0, z = self.rank0[level], self.zeros[level]
            at = np.where(bit == 0, r0[at], z + at - r0[at])
            low = np.where(bit == 0, r0[low], z + low - r0[low])
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for level in range(self.bits):
            r0, z = self.rank0[level], self.zeros[level]
            bit = 1 - (r0[at + 1] - r0[at])
            symbol = symbol << 1 | bit
            at = np.where(bit == 0, r0[at], z + at - r0[at])
        return symbol


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        self.n = len(text) + 1
        text = np.concatenate([text + 1, [0]])  # 0 ends the text
        order = suffix_array(text)
        bwt = text[order - 1]
        self.wavelet = WaveletMatrix(bwt, int(symbols + 2).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 2))])
        self.sampled = order % SAMPLE_EVERY == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all phrases, extended to the left by one symbol a step."""
        low, high = np.zeros(len(offsets) - 1, np.int64), np.full(len(offsets) - 1, self.n, np.int64)
        lengths = np.diff(offsets)
        for step in range(1, int(lengths.max(initial=0)) + 1):
            on = np.flatnonzero((lengths >= step) & (low < high))
            symbol = symbols[offsets[on + 1] - step] + 1
            low[on] = self.first[symbol] + self.wavelet.rank(symbol, low[on])
            high[on] = self.first[symbol] + self.wavelet.rank(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        left = np.flatnonzero(~self.sampled[rows])
        while len(left):
            at = rows[left]
            symbol = self.wavelet.access(at)
            rows[left] = self.first[symbol] + self.wavelet.rank(symbol, at)
            steps[left] += 1
            left = left[~self.sampled[rows[left]]]
        return self.samples[self.sample_rank[rows]] + steps


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [low, high): the index of each range repeated, and all numbers in it."""
    count = high - low
    which = np.repeat(np.arange(len(low)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)


def search_shard(hashes: np.ndarray, offsets: np.ndarray, phrases: Phrases, delta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add the occurrences' spans to ``delta`` (+1 at starts, -1 past ends); (row, item number) pairs that occur."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.vocabulary) or not len(hashes):
        return none
    at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    ids = np.where(phrases.vocabulary[at] == hashes, at + 1, 0).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    joined = member(phrases.pairs, ids[:-1] << 32 | ids[1:]) & (row[:-1] == row[1:])
    keep = member(phrases.single, ids)
    keep[:-1] |= joined
    keep[1:] |= joined
    places = np.flatnonzero(keep)
    if not len(places):
        return none
    gap = np.concatenate([[False], (np.diff(places) > 1) | (row[places[1:]] != row[places[:-1]])])
    shift = np.arange(len(places)) + np.cumsum(gap)
    text, origin = np.zeros(shift[-1] + 1, np.int64), np.zeros(shift[-1] + 1, np.int64)
    text[shift], origin[shift] = ids[places], places
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.symbols, phrases.offsets)
    phrase, rows = expand(low, high)
    start = origin[index.locate(rows)]
    np.add.at(delta, start, 1)
    np.add.at(delta, start + np.diff(phrases.offsets)[phrase], -1)
    hit = np.unique(row[start] * (len(low) + 1) + phrase)
    hit_row, hit_phrase = hit // (len(low) + 1), hit % (len(low) + 1)
    first, last = np.searchsorted(phrases.phrase_of, hit_phrase, "left"), np.searchsorted(phrases.phrase_of, hit_phrase, "right")
    which, owner = expand(first, last)
    pair = np.unique(hit_row[which] * len(phrases.items) + phrases.item_of[owner])
    return pair // len(phrases.items), pair % len(phrases.items)


@dataclass
class Shard:
    """Rows of a task whose texts are searched at once."""

    rows: pa.Table
    words: np.ndarray
    offsets: np.ndarray

    def search(self, phrases: Phrases | None) -> tuple[np.ndarray, list[set[str]]]:
        """Which words are hit, and each row's items."""
        delta = np.zeros(len(self.words) + 1, np.int64)
        found: list[set[str]] = [set() for _ in range(self.rows.num_rows)]
        if phrases is not None:
            for row, item in zip(*search_shard(self.words, self.offsets, phrases, delta), strict=True):
                found[row].add(phrases.items[item])
        return np.cumsum(delta[:-1]) > 0, found

    def spans(self, hit: np.ndarray) -> list[list[dict]]:
        """Each row's merged runs of hit words."""
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        spans: list[list[dict]] = [[] for _ in range(self.rows.num_rows)]
        for lo, hi in zip(edge[::2], edge[1::2], strict=True):
            first, last = np.searchsorted(self.offsets, lo, "right") - 1, np.searchsorted(self.offsets, hi - 1, "right") - 1
            for r in range(first, last + 1):  # a run of hit words may touch the end of one row and the start of the next
                a, b = max(lo, self.offsets[r]), min(hi, self.offsets[r + 1])
                if a < b:
                    spans[r].append({"start": int(a - self.offsets[r]), "end": int(b - self.offsets[r])})
        return spans


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """A task's rows in shards of about SHARD_WORDS words."""
    rows, hashes, counts, size = [], [], [], 0

    def shard() -> Shard:
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
        return Shard(pa.Table.from_batches(rows), np.concatenate(hashes), offsets)

    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            found, before = word_hashes(part.column("text"))
            rows.append(part)
            hashes.append(found)
            counts.append(np.diff(before))
            size += len(found)
            if size >= SHARD_WORDS:
                yield shard()
                rows, hashes, counts, size = [], [], [], 0
    if rows:
        yield shard()


SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
ADDED = ["n_words", "n_hit", "n_items", "items", "items_sha256", "spans"]


def marked(shard: Shard, hit: np.ndarray, items: list[list[str]], drop: list[str]) -> pa.RecordBatch:
    """The shard's rows without the columns in ``drop``, and the ADDED ones."""
    total = np.concatenate([[0], np.cumsum(hit)])
    joined = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
    added = [
        pa.array(np.diff(shard.offsets), pa.int64()), pa.array(total[shard.offsets[1:]] - total[shard.offsets[:-1]], pa.int64()), pa.array([len(x) for x in items], pa.int64()),
        pa.array(items, pa.list_(pa.string())), pa.array(joined, pa.string()), pa.array(shard.spans(hit), SPAN_TYPE),
    ]
    names = [n for n in shard.rows.schema.names if n not in drop]
    given = [shard.rows.column(n).combine_chunks() for n in names]
    given = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in given]
    return pa.RecordBatch.from_arrays([*given, *added], names=[*names, *ADDED])


def scan(sent):
    """Task function: rows with their n_words, n_hit, items and spans, by the one block of phrases that was broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = pickle.loads(sent.value) if sent else None
        for shard in shards(batches):
            hit, found = shard.search(phrases)
            yield marked(shard, hit, [sorted(x) for x in found], [])

    return run


def scan_hits(sent):
    """Task function: of the rows with hits in the broadcast block, the key, spans and items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = pickle.loads(sent.value)
        for shard in shards(batches):
            hit, found = shard.search(phrases)
            spans = shard.spans(hit)
            on = [i for i, x in enumerate(spans) if x]
            key = shard.rows.column(KEY).combine_chunks().take(pa.array(on, pa.int64()))
            key = key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key
            columns = [key, pa.array([spans[i] for i in on], SPAN_TYPE), pa.array([sorted(found[i]) for i in on], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[KEY, HIT_SPANS, HIT_ITEMS])

    return run


def merge_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the hits of all passes merged."""
    for shard in shards(batches):
        delta = np.zeros(len(shard.words) + 1, np.int64)
        for row, spans in enumerate(shard.rows.column(HIT_SPANS).to_pylist()):
            for span in spans or ():
                delta[shard.offsets[row] + span["start"]] += 1
                delta[shard.offsets[row] + span["end"]] -= 1
        items = [sorted(x or ()) for x in shard.rows.column(HIT_ITEMS).to_pylist()]
        yield marked(shard, np.cumsum(delta[:-1]) > 0, items, [KEY, HIT_SPANS, HIT_ITEMS])


KEY, HIT_SPANS, HIT_ITEMS = "__row_key", "__hit_spans", "__hit_items"


def phrase_blocks(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """(block, phrases): the benchmark's phrases, pickled, in blocks of about ``block_words`` words, which tasks build."""

    def build(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        hashes, offsets = word_hashes(rows.column("text"))
        raw = pickle.dumps(build_phrases(rows.column("item_id").to_pylist(), hashes, offsets, window), protocol=5)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([raw], pa.binary())], names=["block", "phrases"])

    items = benchmark.selectExpr("cast(item_id as string) AS item_id", "text").where("item_id is not null and text is not null")
    words = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 5
    blocks = max(1, -(-words // block_words))
    dealt = items.select(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"), "item_id", "text")
    return materialize(dealt.groupBy("block").applyInArrow(build, "block long, phrases binary"), "phrases")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Mark the words of ``docs(doc_id, text, ...)`` that lie in a phrase of ``benchmark(item_id, text)``.

    Returns every row with its columns plus n_words, n_hit, n_items, items (ids as sorted strings), items_sha256, spans
    (merged runs of hit words, end exclusive) and contaminated (n_hit > 0 and share * n_hit >= n_words). Null and empty
    texts have no words. Repeated rows each get their result, repeated items count once; items without an id or text
    have no phrases. A row without a doc_id is one like any other. Columns of ``docs`` with the names of the added ones
    are replaced. Empty tables give no rows, or rows without hits. To the driver and the tasks comes one block of phrases
    at a time, of ``block_words`` words or of one longer item.
    """
    docs = in_small_batches(docs.drop(*ADDED, "contaminated"))
    sc = docs.sparkSession.sparkContext
    blocks = phrase_blocks(benchmark, window, block_words)
    numbers = [r["block"] for r in blocks.select("block").collect()]
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    kinds = [T.LongType()] * 3 + [T.ArrayType(T.StringType()), T.StringType(), T.ArrayType(span)]
    schema = T.StructType(docs.schema.fields + [T.StructField(n, k) for n, k in zip(ADDED, kinds, strict=True)])

    def sent(block: int):
        return sc.broadcast(bytes(blocks.where(F.col("block") == block).first()["phrases"]))

    if len(numbers) <= 1:
        found = docs.mapInArrow(lean(scan(sent(numbers[0]) if numbers else None)), schema)
    else:
        # Rows with the same doc_id and text have the same hits.
        keyed = docs.withColumn(KEY, F.concat_ws("-", F.xxhash64("doc_id", "text"), F.xxhash64("text", F.lit(1), "doc_id")))
        passes = [keyed.select(KEY, "text").mapInArrow(scan_hits(sent(b)), f"{KEY} string, {HIT_SPANS} array<struct<start:int,end:int>>, {HIT_ITEMS} array<string>") for b in numbers]
        hits = reduce(DataFrame.unionByName, [materialize(p, "hits").dropDuplicates([KEY]) for p in passes])
        hits = hits.groupBy(KEY).agg(F.flatten(F.collect_list(HIT_SPANS)).alias(HIT_SPANS), F.array_distinct(F.flatten(F.collect_list(HIT_ITEMS))).alias(HIT_ITEMS))
        hits = materialize(hits, "merged")
        found = keyed.join(broadcast_if_small(hits, BROADCAST_HITS), KEY, "left").mapInArrow(merge_hits, schema)
    return found.selectExpr("*", f"n_hit > 0 AND {int(share)} * n_hit >= n_words AS contaminated")
