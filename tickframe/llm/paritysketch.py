"""Near-duplicate join on word shingles by parity sketches.

Each shingle is hashed into one of K blocks of a sketch and XORed into it, so every shingle that only one of two sets
holds changes at most one block: the number of differing blocks is a lower bound of the symmetric difference. Two sets
that reach the similarity differ in at most d shingles, so of any d + 1 filled blocks of one at least one is the same
in the other. Sets are sketched per size band, with K growing with the band, and joined on d + 1 blocks each, those
with most shingles first. Pairs pass a bitwise parity filter and an exact comparison of their shingle sets. The members
of one key's group meet its smallest one first; only what that leaves unconnected is compared by sketches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.components import connected_components
from tickframe.llm.storage import broadcast_if_small, bucket_count, corpus_size, in_small_batches, materialize
from tickframe.llm.textbatch import (
    NOT_SPACE,
    U64,
    lean,
    lean_group,
    mix,
    pack_planes,
    slices,
    to_bytes_array,
    unpack_planes,
    word_hash,
    word_spans,
)

SHINGLE = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
KEYS_A_FLUSH = 1 << 20
#: Logarithms of the fewest and most bits of a parity sketch, its bits for each shingle, and the bytes of one in a group.
LEAST_BITS, MOST_BITS, BITS_A_SHINGLE, GROUP_BYTES = 6, 16, 4, 256
#: Ids of documents in candidate pairs are broadcast, to filter the read of their texts, if there are at most so many.
BROADCAST_IDS = 1_000_000
#: Members of a group compared by one task; a larger group falls apart by size, then into blocks. Linked sets are in the
#: same or a neighbouring size class; its factor is a little more than the similarity needs, for rounding.
GROUP_BLOCK, SIZE_FACTOR = 2048, 1.34
#: One document in so many is sampled for frequent keys; a key is one from so many sampled documents on; and at most so
#: many are told to the tasks. Keys of HOT sampled documents or more are dealt over SALTS tasks.
SAMPLE_EVERY, OFTEN, MOST_FREQUENT, HOT, SALTS = 16, 4, 500_000, 10_000, 64
#: Rounds in which the members of a group meet one more of them before they are compared with each other.
CENTER_ROUNDS = 1
LOW_BITS = U64((1 << 40) - 1)
STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingle hashes of each row, slice by slice."""
    data, offsets = to_bytes_array(column)
    for _, _, chunk, at in slices(data, offsets):
        starts, ends, before = word_spans(chunk, at, NOT_SPACE)
        words = word_hash(chunk, starts, ends)
        long = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            long += words[k : k + len(long)] * STEP[k]
        long = mix(long)
        out = []
        for lo, hi in zip(before[:-1], before[1:], strict=True):
            if hi - lo >= SHINGLE:
                out.append(np.unique(long[lo : hi - SHINGLE + 1]))
            elif hi > lo:
                out.append(mix((words[lo:hi] * STEP[: hi - lo]).sum(keepdims=True, dtype=np.uint64) + U64(hi - lo)))
            else:
                out.append(np.zeros(0, np.uint64))
        yield out


def most_different(a: int, b: int) -> int:
    """The largest symmetric difference of two linked sets of these sizes."""
    return (100 - PERCENT) * (a + b) // (100 + PERCENT)


def size_bands(most: int = 1 << 40) -> list[int]:
    """First sizes of the bands; a linked partner is in the same or a neighbouring band."""
    bands = [1]
    while bands[-1] < most:
        bands.append(100 * bands[-1] // PERCENT + 1)
    return bands


BANDS = size_bands()
_BANDS = np.array(BANDS)


def block_count(band: int) -> int:
    """Blocks of a band's sketch: about two shingles a block, and more room for small sets."""
    largest = BANDS[band + 1] - 1
    return 1 << 16 if largest < 64 else 2 * largest + 64 if largest < 256 else 11 * largest // 20


def blocks_of(shingles: np.ndarray, band: int) -> np.ndarray:
    """The block of each shingle, ascending as the shingles are."""
    return ((shingles >> U64(32)) * U64(block_count(band))) >> U64(32)


def block_keys(shingles: np.ndarray, band: int, need: int, frequent: np.ndarray) -> np.ndarray:
    """The first ``need`` filled blocks of the set's sketch for a band, or all if there are fewer.

    A key has the number of the block's shingles (more come first), then a hash of block and content. Keys in
    ``frequent`` (sorted, low 40 bits) come last. Any order that all sets share finds all pairs.
    """
    blocks = blocks_of(shingles, band)
    starts = np.flatnonzero(np.diff(blocks, prepend=U64(1 << 63)))
    content = np.bitwise_xor.reduceat(mix(shingles), starts)
    filled = np.diff(starts, append=len(shingles))
    keys = mix(content ^ mix(blocks[starts] + np.array([band], np.uint64) * STEP[1])) >> U64(8) | (U64(255) - np.minimum(filled, 255).astype(np.uint64)) << U64(56)
    if len(keys) <= need:
        return keys
    order = keys >> U64(1)
    if len(frequent):
        low = keys & LOW_BITS
        order |= (frequent[np.minimum(np.searchsorted(frequent, low), len(frequent) - 1)] == low).astype(np.uint64) << U64(63)
    return keys[np.argpartition(order, need - 1)[:need]]


def needs(n: int) -> list[tuple[int, int]]:
    """(band, blocks) that a set of size n is joined on: its own band, for partners of any size, and the band below."""
    band = int(np.searchsorted(_BANDS, n, "right")) - 1
    own = [(band, most_different(n, 100 * n // PERCENT) + 1)]
    return own if not band else [*own, (band - 1, most_different(n, BANDS[band] - 1) + 1)]


def sketch_keys(shingles: np.ndarray, frequent: np.ndarray) -> list[np.ndarray]:
    return [block_keys(shingles, band, need, frequent) for band, need in needs(len(shingles))]


def enough_blocks(shingles: np.ndarray) -> bool:
    """Whether the set fills as many blocks as it is joined on."""
    return all(1 + np.count_nonzero(np.diff(blocks_of(shingles, band))) >= need for band, need in needs(len(shingles)))


def parity_bits(shingles: np.ndarray) -> bytes:
    """A parity bit per shingle hash, XORed, in some bits for each shingle; the Hamming distance of two such
    sketches is at most the sets' symmetric difference. Bits are dealt by low hash bits, so that a sketch folds."""
    bits = 1 << max(LEAST_BITS, min(MOST_BITS, (BITS_A_SHINGLE * len(shingles) - 1).bit_length()))
    odd = np.bincount((mix(shingles + STEP[2]) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch in ``size`` bytes: its halves XORed, as if it had been dealt over fewer bits."""
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


META = "doc_id long, n long, h1 long, h2 long, sketch binary, enough boolean"
KEYS = "bucket int, keys binary, docs binary"


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    if not len(shingles):
        return 0, 0
    return int(shingles.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(shingles + STEP[4])).view(np.int64))


def meta_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: size, set hash, parity bits, and whether its sketch has enough filled blocks."""
    for part in batches:
        ids = iter(part.column("doc_id").to_pylist())
        for sets in shingle_sets(part.column("text")):
            hashes = [set_hash(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(ids) for _ in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array([parity_bits(x) if len(x) else None for x in sets], pa.binary()), pa.array([not len(x) or enough_blocks(x) for x in sets], pa.bool_()),
                ],
                names=["doc_id", "n", "h1", "h2", "sketch", "enough"],
            )


def within(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def copy_key(doc_id: int, own: tuple[int, int]) -> int:
    return (doc_id * int(STEP[0]) ^ own[0]) & (1 << 64) - 1


def is_copy(doc_id: int, own: tuple[int, int], keys: np.ndarray = (), check: np.ndarray = ()) -> bool:
    """Whether the document with this set is told as a copy of an earlier one."""
    if not len(keys):
        return False
    at = min(int(np.searchsorted(keys, np.uint64(copy_key(doc_id, own)))), len(keys) - 1)
    return int(keys[at]) == copy_key(doc_id, own) and int(check[at]) == own[1]


def key_task(buckets: int, told=None):
    """Task function: packed rows of (key, doc_id) by bucket. ``told`` broadcasts the keys to use last, and the hot ones
    among them: those have SALTS buckets of their own each, numbered from ``buckets`` on, dealt by document."""
    shift = U64(buckets.bit_length() - 1)

    def flush(keys: list[np.ndarray], docs: list[int], counts: list[int], hot: np.ndarray) -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.repeat(np.array(docs, np.int64), counts)
        bucket = (key & U64(buckets - 1)).astype(np.int64)
        salted = within(hot, key & LOW_BITS)
        bucket[salted] += buckets * (1 + (mix(doc[salted].view(np.uint64)) % U64(SALTS)).astype(np.int64))
        order = np.argsort(bucket, kind="stable")
        key, doc, bucket = (key[order] >> shift).astype(np.uint32), doc[order], bucket[order]
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        columns = [
            pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
            pa.array([key[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([pack_planes(doc[a:b]) for a, b in spans], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, counts, held, seen = [], [], [], 0, set()
        last, hot, *known = told.value if told else (np.zeros(0, np.uint64),) * 2
        for part in batches:
            ids = iter(part.column("doc_id").to_pylist())
            for sets in shingle_sets(part.column("text")):
                for shingles in sets:
                    doc_id = next(ids)
                    # Equal sets of a task need one entry.
                    if len(shingles) and doc_id is not None and (own := set_hash(shingles)) not in seen and not is_copy(doc_id, own, *known):
                        seen.add(own)
                        for k in sketch_keys(shingles, last):
                            keys.append(k)
                            docs.append(doc_id)
                            counts.append(len(k))
                            held += len(k)
                if held >= KEYS_A_FLUSH:
                    yield flush(keys, docs, counts, hot)
                    keys, docs, counts, held, seen = [], [], [], 0, set()
        if keys:
            yield flush(keys, docs, counts, hot)

    return run


def frequent_keys(buckets: int):
    """Group function: the low bits of a bucket's keys that OFTEN documents or more have, with their number."""
    shift = U64(buckets.bit_length() - 1)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x, np.uint32) for batch in batches for x in batch.column("keys").to_pylist()]
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        low = (found[n >= OFTEN].astype(np.uint64) << shift | U64(key[0].as_py())) & LOW_BITS
        yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(n[n >= OFTEN])], names=["key", "n"])

    return run


GROUPS = "a long, b long, g long, hot boolean"
MEMBERS_A_BATCH = 1 << 16


def bucket_groups(buckets: int):
    """Group function: the groups of documents under one key of a bucket.

    Pairs (a, b) of a group's smallest member with each other one; and for groups of three or more a row (g, a) for each
    member, where g is equal for equal groups. A bucket that holds a salt of hot keys gives rows (g, a) alone.
    """
    shift = buckets.bit_length() - 1

    def rows(a: np.ndarray, b: np.ndarray | None, g: np.ndarray | None, hot: bool) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(a), MEMBERS_A_BATCH):
            part = slice(at, at + MEMBERS_A_BATCH)
            n = len(a[part])
            columns = [a[part], *(pa.nulls(n, pa.int64()) if x is None else x[part] for x in (b, g))]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(np.full(n, hot))], names=["a", "b", "g", "hot"])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for batch in batches:
            keys.extend(np.frombuffer(x, np.uint32) for x in batch.column("keys").to_pylist())
            docs.extend(unpack_planes(x) for x in batch.column("docs").to_pylist())
        key_of, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.lexsort((doc, key_of))
        key_of, doc = key_of[order], doc[order]
        first = (np.diff(key_of, prepend=~key_of[:1]) != 0) | (np.diff(doc, prepend=doc[:1] - 1) != 0)
        key_of, doc = key_of[first], doc[first]
        bucket = key[0].as_py()
        if bucket >= buckets:
            yield from rows(doc, None, (key_of.astype(np.int64) << shift | bucket % buckets) + (1 << 48), True)
            return
        starts = np.flatnonzero(np.diff(key_of, prepend=~key_of[:1]) != 0)
        sizes = np.diff(starts, append=len(doc))
        center = np.repeat(doc[starts], sizes)
        pairs = np.unique(np.stack([center[center != doc], doc[center != doc]], axis=1), axis=0)
        yield from rows(pairs[:, 0], pairs[:, 1], None, False)
        # Equal groups of a bucket are told once; a group's number is a sum over its members.
        number = mix(np.add.reduceat(mix(doc.view(np.uint64) + STEP[3]), starts) ^ mix(sizes.astype(np.uint64))) if len(doc) else np.zeros(0, np.uint64)
        large = np.flatnonzero(sizes > 2)
        large = large[np.unique(number[large], return_index=True)[1]]
        at = np.repeat(starts[large], sizes[large])
        at += np.arange(len(at)) - np.repeat(np.cumsum(sizes[large]) - sizes[large], sizes[large])
        yield from rows(doc[at], None, np.repeat(number[large].view(np.int64), sizes[large]), False)

    return run


def set_rows(bits: int):
    """Task function: each document's sorted shingle hashes, cut to 32 bits or whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique((s >> U64(32)).astype(np.uint32)) if bits == 32 else s for part in shingle_sets(batch.column("text")) for s in part]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "shingles"])

    return run


#: Outcome of a comparison.
APART, LINKED, UNSURE = 0, 1, 2


def compare_sets(bits: int):
    """Task function: says of each pair whether its sets reach the similarity. With 32-bit hashes, pairs so near the
    threshold that colliding hashes could decide are unsure."""
    kind = np.uint32 if bits == 32 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outcome = []
            for n_a, n_b, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b")), *(batch.column(c) for c in ("set_a", "set_b")), strict=True):
                p, q = np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind)
                at = np.searchsorted(q, p)
                same = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                over = (100 + PERCENT) * same - PERCENT * (n_a + n_b)
                doubt = (8 + (n_a * n_b >> 30)) * (100 + PERCENT) if bits == 32 else 0
                outcome.append(UNSURE if abs(over) < doubt else LINKED if over >= 0 else APART)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(outcome, pa.int32())], names=["a", "b", "n_a", "n_b", "outcome"])

    return run


def close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and parity sketches allow the similarity."""
    for batch in batches:
        keep = []
        for i, (n_a, n_b, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")), strict=True)):
            if 100 * min(n_a, n_b) < PERCENT * max(n_a, n_b):
                continue
            p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            size = min(len(p), len(q))
            if int(np.bitwise_count(fold(p, size) ^ fold(q, size)).sum()) <= most_different(n_a, n_b):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b", "n_a", "n_b")], names=["a", "b", "n_a", "n_b"])


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with their sketches in GROUP_BYTES at most."""
    for batch in batches:
        short = [fold(np.frombuffer(s, np.uint8), GROUP_BYTES).tobytes() for s in batch.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("n"), pa.array(short, pa.binary())], names=["rep", "n", "sketch"])


def close_in_group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a group in different components that sizes and parity sketches allow."""
    rows = pa.Table.from_batches(list(batches))
    node, label, n, side, guest = (rows.column(c).to_numpy() for c in ("rep", "label", "n", "side", "guest"))
    sketches = [np.frombuffer(s, np.uint8) for s in rows.column("sketch").to_pylist()]
    size = min(map(len, sketches))
    bits = np.stack([fold(s, size) for s in sketches]).view(np.uint64)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    a, b = [], []

    def compare(i: int, others: np.ndarray) -> None:
        fits = (label[others] != label[i]) & (100 * np.minimum(n[others], n[i]) >= PERCENT * np.maximum(n[others], n[i]))
        j = others[fits & ~(guest[others] & guest[i])]
        j = j[(100 + PERCENT) * np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1) <= (100 - PERCENT) * (n[j] + n[i])]
        a.extend(np.minimum(node[i], node[j]))
        b.extend(np.maximum(node[i], node[j]))

    # Most members are in one component, within which nothing is compared: the others meet all.
    labels, counts = np.unique(label, return_counts=True)
    most = label == labels[counts.argmax()]
    for i in left[~most[left]]:
        compare(i, right)
    if (side != 2).any():
        for i in right[~most[right]]:
            compare(i, left[most[left]])
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class _Join:
    """One run of the join over ``docs``."""

    def __init__(self, docs: DataFrame):
        self.docs = in_small_batches(docs).select("doc_id", "text")
        self.buckets = bucket_count(corpus_size(docs)[1])
        self.meta = materialize(self.docs.mapInArrow(lean(meta_task), META), "meta")
        filled = self.meta.where("n > 0 and doc_id is not null")
        classes = filled.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
        #: Documents with the same set as a smaller doc_id. Written first, classes meet their members in a join that Spark can split.
        self.copies = materialize(filled.join(materialize(classes, "classes"), ["n", "h1", "h2"]).where("doc_id <> rep").select("doc_id", "rep", "h1", "h2"), "copies")
        self.facts = filled.select(F.col("doc_id").alias("rep"), "n", "sketch")

    def to_reps(self, df: DataFrame, name: str) -> DataFrame:
        """The column's documents replaced by the first one with the same set."""
        own = self.copies.select(F.col("doc_id").alias(name), "rep")
        return df.join(own, name, "left").withColumn(name, F.coalesce("rep", name)).drop("rep")

    def sets_of(self, pairs: DataFrame, bits: int) -> DataFrame:
        ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
        if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        return self.docs.join(ids, "doc_id", "left_semi").mapInArrow(lean(set_rows(bits)), "doc_id long, shingles binary")

    def compared(self, pairs: DataFrame, bits: int) -> DataFrame:
        """Pairs (a, b, n_a, n_b) with the outcome of comparing their sets."""
        sets = materialize(self.sets_of(pairs, bits), "sets")
        joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        return materialize(joined.mapInArrow(lean(compare_sets(bits)), "a long, b long, n_a long, n_b long, outcome int"), "compared")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Links (a, b) among candidate pairs, by their sets: short hashes first, whole ones near the threshold."""
        first = self.compared(pairs, 32)
        second = self.compared(first.where(F.col("outcome") == UNSURE).drop("outcome"), 64)
        return first.unionByName(second).where(F.col("outcome") == LINKED).select("a", "b")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs of different sets that sizes and parity sketches allow, with both sizes."""
        pairs = self.to_reps(self.to_reps(pairs, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        facts = self.facts.dropDuplicates(["rep"])
        for side in "ab":
            pairs = pairs.join(facts.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")), side)
        return materialize(pairs.mapInArrow(lean(close_pairs), "a long, b long, n_a long, n_b long"), "pairs")

    def few_blocks(self) -> DataFrame | None:
        """Pairs of the rare sets with too few filled blocks with any set that shares one of their first shingles, or
        None. Of the shingles that a linked set may lack plus one, at least one is shared."""
        rare = self.meta.where("not enough").select("doc_id")
        if rare.isEmpty():
            return None
        first = self.docs.join(broadcast_if_small(rare, BROADCAST_IDS), "doc_id", "left_semi").mapInArrow(exploded_sets(True), SHINGLES)
        first = materialize(first.select(F.col("doc_id").alias("a"), "shingle"), "first")
        every = self.docs.mapInArrow(exploded_sets(False), SHINGLES)
        return every.withColumnRenamed("doc_id", "b").join(broadcast_if_small(first, BROADCAST_IDS), "shingle").select("a", "b").distinct()

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys seen often in a sample, and the hot ones among them. They come last in the order of blocks, and hot ones
        are dealt over salts, so which they are decides how many candidates there are, not which pairs are found."""
        sample = self.docs.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(SAMPLE_EVERY)) == 0)
        packed = sample.mapInArrow(lean(key_task(self.buckets)), KEYS)
        counted = packed.groupBy("bucket").applyInArrow(lean_group(frequent_keys(self.buckets)), "key long, n long")
        most = counted.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).toArrow()
        keys, n = most.column("key").to_numpy().view(np.uint64), most.column("n").to_numpy()
        return np.unique(keys), np.unique(keys[n >= HOT])

    def known_copies(self) -> tuple[np.ndarray, np.ndarray]:
        """What tells copies apart in a task, which then need no keys; none if there are over BROADCAST_IDS."""
        if self.copies.count() > BROADCAST_IDS:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        found = self.copies.select("doc_id", "h1", "h2").distinct().toArrow()
        doc, h1 = (found.column(c).to_numpy().view(np.uint64) for c in ("doc_id", "h1"))
        keys = doc * STEP[0] ^ h1
        order = np.argsort(keys)
        return keys[order], found.column("h2").to_numpy()[order]

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b) of each group's smallest member with the others, and members (g, rep) of groups of three or more."""
        last, hot = self.frequent()
        told = self.docs.sparkSession.sparkContext.broadcast((last, hot, *self.known_copies()))
        packed = self.docs.mapInArrow(lean(key_task(self.buckets, told)), KEYS)
        found = materialize(packed.groupBy("bucket").applyInArrow(lean_group(bucket_groups(self.buckets)), GROUPS), "groups")
        pairs = found.where("b is not null").select("a", "b")
        if len(hot):
            own = found.where("hot").select("g", "a")
            centers = materialize(own.groupBy("g").agg(F.min("a").alias("center")), "centers")
            pairs = pairs.unionByName(own.join(centers, "g").where("a <> center").select(F.col("center").alias("a"), F.col("a").alias("b")))
        members = self.to_reps(found.where("g is not null").select("g", F.col("a").alias("rep0")), "rep0")
        return pairs, materialize(members.select("g", F.col("rep0").alias("rep")).distinct(), "members")

    def labelled(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of the groups that are not connected throughout, with their components."""
        tagged = members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
        tagged = tagged.select("g", "rep", F.coalesce("component", "rep").alias("label"))
        apart = tagged.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("g")
        return materialize(tagged.join(apart, "g"), "open")

    def centered(self, members: DataFrame, turn: int) -> DataFrame:
        """Pairs of one member of each group, mostly one of many groups, with the members of other components."""
        degree = members.groupBy("rep").agg(F.count(F.lit(1)).alias("groups"))
        luck = F.pmod(F.xxhash64("rep", F.lit(turn)), F.lit(1000)) / 1000
        order = F.struct((F.col("groups") * (1 + luck * min(turn, 1))).alias("o"), "rep")
        centers = members.join(degree, "rep").groupBy("g").agg(F.max_by(F.struct("rep", "label"), order).alias("c"))
        met = members.join(materialize(centers, "centers"), "g").where("label <> c.label")
        return met.select(F.col("c.rep").alias("a"), F.col("rep").alias("b")).distinct()

    def across(self, members: DataFrame) -> DataFrame:
        """Pairs of members in different components that sizes and folded sketches allow.

        A group of at most GROUP_BLOCK members is compared in one task. Those of a larger one are hosts of their size
        class and guests of the next one, and classes are compared block against block.
        """
        sizes = members.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("blocks"))
        short = self.facts.dropDuplicates(["rep"]).mapInArrow(lean(folded), "rep long, n long, sketch binary")
        rest = members.join(sizes, "g").join(short, "rep").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        home = F.when(F.col("blocks") > 1, F.floor(F.log("n") / math.log(SIZE_FACTOR))).otherwise(0).cast("int")
        rest = rest.withColumn("home", home)
        rest = rest.withColumn("size", F.explode(F.when(F.col("blocks") > 1, F.array("home", F.col("home") + 1)).otherwise(F.array("home"))))
        dealt = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
        dealt = dealt.select(
            "g", "size", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            "rep", "label", "n", "sketch", side.alias("side"), (F.col("size") > F.col("home")).alias("guest"),
        )
        return dealt.groupBy("g", "size", "i", "j").applyInArrow(lean_group(close_in_group), "a long, b long").where("a <> b").distinct()

    def merged(self, labels: DataFrame, pairs: DataFrame) -> DataFrame:
        edges = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return connected_components(edges.unionByName(self.verified(self.close(pairs))))

    def run(self) -> DataFrame:
        """(node, component) of every linked document."""
        pairs, members = self.candidates()
        if (rare := self.few_blocks()) is not None:
            pairs = pairs.unionByName(rare)
        links = self.verified(self.close(pairs)).unionByName(self.copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
        labels = connected_components(links)
        # What its smallest member does not connect, other members of a group may; only then all are compared.
        for turn in range(CENTER_ROUNDS):
            members = self.labelled(members, labels)
            if members.isEmpty():
                return labels
            labels = self.merged(labels, self.centered(members, turn))
        members = self.labelled(members, labels)
        return labels if members.isEmpty() else self.merged(labels, materialize(self.across(members), "more"))


SHINGLES = "doc_id long, shingle long"


def exploded_sets(first: bool):
    """Task function: a row for each shingle of each document; with ``first`` only so many that a linked set has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for sets in shingle_sets(batch.column("text")):
                owners = [next(ids) for _ in sets]
                if first:
                    sets = [s[: most_different(len(s), 100 * len(s) // PERCENT) + 1] for s in sets]
                owner = np.repeat(np.array([-1 if o is None else o for o in owners], np.int64), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(np.concatenate(sets).view(np.int64))], names=["doc_id", "shingle"])

    return run


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of ``docs(doc_id, text, ...)`` under shingle similarity.

    Returns doc_id, n_shingles and component_id (the smallest doc_id reachable by links) for every row. A set holds the
    distinct five-word shingles of the text, A-Z lower-cased, words cut at ASCII white space; fewer words make one
    shingle; null and empty texts have no set and link with nothing. Rows that repeat a doc_id are one node. A null
    doc_id is in no component. Other columns are not read; an empty table gives no rows.
    """
    join = _Join(docs)
    labels = join.run()
    own = join.meta.select("doc_id", F.col("n").alias("n_shingles"))
    return own.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
