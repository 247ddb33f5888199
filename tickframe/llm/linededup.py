"""Line deduplication with a once-seen and a twice-seen Bloom filter.

Each task marks its documents' line hashes in a pair of filters: a hash already in the once-seen filter goes to the
twice-seen one. The filters of two tasks merge by bits, (a1|b1, a2|b2|(a1&b1)), segment by segment; their number grows
with the corpus. The merged twice-seen filter, in which few bits are set, is folded to a bound and broadcast to test the
lines. Only lines that it holds shuffle; they are counted exactly by their text. The more distinct repeated lines a corpus
has for the bound, the more other lines pass the filter and are counted, in the limit all; texts never move for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm.storage import corpus_size, in_small_batches, materialize
from tickframe.llm.textbatch import lean, to_bytes_array

SPACE = b" \t\n\x0b\x0c\r"
SEGMENT_BITS = 1 << 20
#: Fewest bits of a filter, those for each expected line, and those (32 MB) to which the twice-seen filter is folded.
LEAST_BITS, BITS_A_LINE, BROADCAST_BITS = 1 << 20, 8, 1 << 28
#: Repeated lines are broadcast to the texts if their texts have at most so many bytes; else texts that lose lines are
#: joined with them, and a filter of this many bits at most tells which those are.
BROADCAST_BYTES, ID_BITS = 32 << 20, 1 << 28
#: Expected bytes of text for each long line.
BYTES_A_LINE = 128
PAIRS_A_FLUSH = 1 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line's key, or None when it is shorter than ``min_chars`` code points."""
    if len(line) < min_chars:
        return None
    key = line.strip(SPACE).lower()  # on bytes this lower-cases A-Z alone
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def long_keys(text: bytes, min_chars: int) -> set[bytes]:
    found = {line_key(x, min_chars) for x in text.split(b"\n")}
    found.discard(None)
    return found


def texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = to_bytes_array(column)
    raw = data[offsets[0] : offsets[-1]].tobytes()
    places = offsets - offsets[0]
    for start, end in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        yield raw[start:end]


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each hash, both within one segment, so that a segment answers alone."""
    segments = np.uint64(bits // SEGMENT_BITS)
    base = (hashes % segments) * np.uint64(SEGMENT_BITS)
    one = (hashes >> np.uint64(20)) % np.uint64(SEGMENT_BITS)
    two = (hashes >> np.uint64(42)) % np.uint64(SEGMENT_BITS)
    return np.stack([base + one, base + two])


def mark(bits: int, min_chars: int):
    """Task function: sparse (segment, once, twice) bit positions of this task's lines."""

    def rows(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
        out: dict[int, list[bytes]] = {}
        for which, at in ((0, once), (1, twice)):
            segments = at // SEGMENT_BITS
            edges = np.append(np.flatnonzero(np.diff(segments, prepend=-1)), len(at)) if len(at) else [0]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                out.setdefault(int(segments[lo]), [b"", b""])[which] = (at[lo:hi] % SEGMENT_BITS).astype(np.uint32).tobytes()
        columns = [pa.array(list(out), pa.int32()), *(pa.array([x[k] for x in out.values()], pa.binary()) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, names=["segment", "once", "twice"])

    def flush(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        unique, count = np.unique(np.array(hashes, np.uint64), return_counts=True)
        return np.unique(positions(unique, bits)).astype(np.int64), np.unique(positions(unique[count > 1], bits)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[int] = []
        for batch in batches:
            for text in texts(batch.column("text")):
                hashes.extend(xxhash.xxh3_64_intdigest(k) for k in long_keys(text, min_chars))
                if len(hashes) >= PAIRS_A_FLUSH:
                    yield from rows(*flush(hashes))
                    hashes = []
        if hashes:
            yield from rows(*flush(hashes))

    return run


def merge_segment(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold one segment's filters; a bit set by two tasks is twice-seen."""
    once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    for batch in batches:
        for a, b in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist(), strict=True):
            at = np.frombuffer(a, np.uint32)
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(b, np.uint32)] = True
    yield pa.RecordBatch.from_pydict({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())})


def held_at(held: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all bit positions of each column are set."""
    return (((held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1) == 1).all(axis=0)


def suspect_rows(ids: list, keys: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([k.decode() for k in keys], pa.string())], names=["doc_id", "key"])


def suspected(filters, bits: int, min_chars: int):
    """Task function: (doc_id, key) of each document's distinct long lines that the broadcast twice-seen filter holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(filters.value, np.uint8)
        for batch in batches:
            ids, keys, hashes = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                own = long_keys(text, min_chars)
                ids.extend([doc_id] * len(own))
                keys.extend(own)
                hashes.extend(map(xxhash.xxh3_64_intdigest, own))
            hit = np.flatnonzero(held_at(held, positions(np.array(hashes, np.uint64), bits)))
            yield suspect_rows([ids[i] for i in hit], [keys[i] for i in hit])

    return run


def rewrite(min_chars: int, repeated=None):
    """Task function: the other columns, n_lines, n_dropped and the remaining text.

    What goes is the keys of ``repeated`` (a broadcast of key to the document that keeps it), or else each row's
    DROPPED keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = repeated.value if repeated else {}
        for batch in batches:
            lines, dropped, kept = [], [], []
            ids = batch.column("doc_id").to_pylist()
            drops = [None] * len(ids) if repeated else batch.column(DROPPED).to_pylist()
            for doc_id, text, drop in zip(ids, texts(batch.column("text")), drops, strict=True):
                all_lines = text.split(b"\n")
                if drop:
                    gone = {x.encode() for x in drop}
                    out = [x for x in all_lines if line_key(x, min_chars) not in gone]
                elif last and doc_id is not None:
                    out = [x for x in all_lines if last.get(line_key(x, min_chars), doc_id) == doc_id]
                else:
                    out = all_lines
                lines.append(len(all_lines))
                dropped.append(len(all_lines) - len(out))
                kept.append(text if len(out) == len(all_lines) else b"\n".join(out))
            names = [n for n in batch.schema.names if n != DROPPED]
            added = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *added], names=[*names, "n_lines", "n_dropped", "kept_text"])

    return run


DROPPED = "__dropped_keys"


def merged_filters(docs: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """(segment, bits) of the twice-seen filter over all documents."""
    marks = docs.select("text").mapInArrow(lean(mark(bits, min_chars)), "segment int, once binary, twice binary")
    return marks.groupBy("segment").applyInArrow(merge_segment, "segment int, bits binary")


def collected(filters: DataFrame, bits: int, most: int) -> bytes:
    """A filter of ``bits`` as one run of bytes, folded to at most ``most`` bits: segments that share a place are joined.

    A folded filter answers for a hash by the same rule with fewer segments; it holds all that the whole one does.
    """
    held = np.zeros(min(bits, most) // 8, np.uint8)
    size = SEGMENT_BITS // 8
    folded = filters.withColumn("segment", F.pmod("segment", F.lit(len(held) // size))) if bits > most else filters
    for row in (folded.groupBy("segment").applyInArrow(joined_segments, "segment int, bits binary") if bits > most else folded).toLocalIterator():
        held[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return held.tobytes()


def joined_segments(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The union of the filters of segments that share a place."""
    held = np.zeros(SEGMENT_BITS // 8, np.uint8)
    for batch in batches:
        for raw in batch.column("bits"):
            held |= np.frombuffer(raw.as_buffer(), np.uint8)
    yield pa.RecordBatch.from_pydict({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([held.tobytes()], pa.binary())})


def find_suspects(docs: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """(doc_id, key) of each row's distinct long lines that the twice-seen filter holds, from one pass that moves no text."""
    filters = merged_filters(docs, bits, min_chars)
    sent = docs.sparkSession.sparkContext.broadcast(collected(filters, bits, BROADCAST_BITS))
    return materialize(docs.mapInArrow(lean(suspected(sent, min(bits, BROADCAST_BITS), min_chars)), "doc_id long, key string"), "suspects")


def set_bits(bits: int):
    """Task function: bit positions of (hash), by segment, for the once-seen side of a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(positions(batch.column("hash").to_numpy().view(np.uint64), bits)).astype(np.int64)
            segments = at // SEGMENT_BITS
            edges = np.append(np.flatnonzero(np.diff(segments, prepend=-1)), len(at))
            raw = [(at[lo:hi] % SEGMENT_BITS).astype(np.uint32).tobytes() for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
            columns = [pa.array(segments[edges[:-1]].astype(np.int32)), pa.nulls(len(raw), pa.binary()).fill_null(b""), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "once", "twice"])

    return run


def may_hold(filters, bits: int, flag: str):
    """Task function: adds whether the filter may hold each row's hash, which it takes away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(filters.value, np.uint8)
        for batch in batches:
            hit = held_at(held, positions(batch.column(flag).to_numpy().view(np.uint64), bits))
            yield batch.set_column(batch.schema.names.index(flag), flag, pa.array(hit))

    return run


def lose_lines(docs: DataFrame, drops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its DROPPED keys: the rows that lose lines, which shuffle, and all others, which do not."""
    n = drops.count()
    bits = 1 << max(LEAST_BITS, min(ID_BITS, 16 * n)).bit_length() - 1
    marks = drops.select(F.xxhash64("doc_id").alias("hash")).mapInArrow(set_bits(bits), "segment int, once binary, twice binary")
    sent = docs.sparkSession.sparkContext.broadcast(collected(marks.groupBy("segment").applyInArrow(merge_segment, "segment int, bits binary"), bits, bits))
    schema = T.StructType([*docs.schema.fields, T.StructField(DROPPED, T.BooleanType())])
    flagged = docs.withColumn(DROPPED, F.xxhash64("doc_id")).mapInArrow(may_hold(sent, bits, DROPPED), schema)
    hit = flagged.where(F.col(DROPPED)).drop(DROPPED).join(drops, "doc_id", "left").select(*docs.columns, DROPPED)
    return hit, flagged.where(~F.col(DROPPED)).withColumn(DROPPED, F.lit(None).cast("array<string>"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, bits: int | None = None) -> DataFrame:
    """Drop lines that many documents share from all but the largest doc_id that holds them.

    A line's key is the line without white space at both ends, A-Z lower-cased; keys of at least ``min_chars`` code
    points in at least ``min_docs`` documents (different doc_ids) are dropped except in the largest doc_id. Returns every
    row of ``docs`` with its columns, plus n_lines, n_dropped and kept_text. A null or empty text is one empty line. Rows
    that repeat a doc_id are one document; those of the largest doc_id all keep their lines. Rows without a doc_id are in
    no document: they keep their lines and count for none. Columns of ``docs`` named like the added ones are replaced. An
    empty table gives an empty result. To the driver come a filter of at most BROADCAST_BITS bits, and repeated lines of
    at most BROADCAST_BYTES.
    """
    docs = in_small_batches(docs).drop("n_lines", "n_dropped", "kept_text")
    if bits is None:
        expected = BITS_A_LINE * (corpus_size(docs)[1] // BYTES_A_LINE)
        bits = 1 << (max(LEAST_BITS, expected) - 1).bit_length()
    pairs = find_suspects(docs.select("doc_id", "text"), bits, min_chars)
    # Written first, so that the join with a very common line is one that Spark can split.
    counts = pairs.where("doc_id is not null").groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
    repeated = materialize(counts.where(F.col("n") >= min_docs).select("key", "last"), "repeated")
    schema = T.StructType(list(docs.schema.fields))
    for name in ("n_lines", "n_dropped"):
        schema = schema.add(name, "long")
    schema = schema.add("kept_text", "string")
    size = repeated.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        found = {r["key"].encode(): r["last"] for r in repeated.collect()}
        return docs.mapInArrow(lean(rewrite(min_chars, docs.sparkSession.sparkContext.broadcast(found))), schema)
    drops = materialize(pairs.join(repeated, "key").where("doc_id <> last").groupBy("doc_id").agg(F.collect_set("key").alias(DROPPED)), "drops")
    hit, rest = lose_lines(docs, drops)
    return hit.unionByName(rest).mapInArrow(lean(rewrite(min_chars)), schema)
