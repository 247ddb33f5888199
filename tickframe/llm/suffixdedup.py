"""Removal of byte strings that occur more than once, by external induced sorting of suffixes.

Of every ``length``-byte window one suffix is sampled, by its content alone, so that equal windows sample the same place
(as reduced suffixes are chosen by local content in induced sorting). The sampled suffixes' tuples (name of the first
bytes, name of all bytes that decide the windows induced by it, place) are dealt over buckets. Suffixes whose first name
is unique induce no repeat; those that share the second name have a common prefix over all windows they induce, which all
repeat. What is left goes down one level with its bytes: the sampled suffixes of a bucket are sorted, with the lengths of
their neighbours' common prefixes, and from their order that of the suffixes one byte to the left is induced, step by
step: each queue of suffix tuples leaves in order of (byte before, rank), and common prefixes grow by one where the byte
is the same. A window repeats where a common prefix reaches its length. Spark's shuffle is the disk behind the queues.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import bucket_count, corpus_size, in_small_batches, materialize
from tickframe.llm.textbatch import SLICE_BYTES, U64, mix, pack_planes, prefix_sums, slices, substring_hash, to_bytes_array, unpack_planes

LENGTH = 200
#: Bytes of a sampled suffix's first name.
GRAM = 100
TUPLES_A_FLUSH = 1 << 20
#: Bytes of regions that a task gathers before it hands them on.
REGION_BYTES = 16 << 20
#: Rows of a task that form one chunk; their results meet again by chunk.
CHUNK_ROWS = 1 << 14
#: Results of documents are broadcast to the texts if they are smaller than so many bytes, else joined by shuffle.
BROADCAST_BYTES = 48 << 20


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def sample(chunk: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of a slice: row, place in the row, first and last distance of their windows' starts, two names."""
    sums = prefix_sums(chunk, fold_case=False)
    rows = np.flatnonzero(np.diff(at) >= length)
    if not len(rows):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    places = np.arange(len(chunk) - gram + 1)
    names = substring_hash(sums, places, places + gram)
    lowest = window_minima(names >> U64(32) << U64(32) | places.astype(np.uint64), length - gram + 1)
    counts = (at[rows + 1] - at[rows]) - length + 1
    start = np.arange(counts.sum()) + np.repeat(at[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    owner = np.repeat(rows, counts)
    chosen = (lowest[start] & U64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(owner) != 0)]))
    last = np.append(edge[1:], len(chosen)) - 1
    place, lo, hi, row = chosen[edge], start[edge], start[last], owner[edge]
    context = mix(substring_hash(sums, lo, hi + length) + (place - lo).astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    return row, place - at[row], place - hi, place - lo, names[place], context


def sampled_parts(chunk: np.ndarray, at: np.ndarray, length: int, gram: int, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``sample`` of a slice. A row of over ``most`` bytes, which is a slice of its own, is sampled in parts of half as many:
    a part has so much of what lies beside it that all windows of the suffixes in it are whole."""
    if len(at) != 2 or len(chunk) <= most:
        yield sample(chunk, at, length, gram)
        return
    for first in range(0, len(chunk), most // 2):
        low = max(0, first - length)
        part = chunk[low : first + most // 2 + length]
        row, place, *rest = sample(part, np.array([0, len(part)]), length, gram)
        own = (place + low >= first) & (place + low < first + most // 2)
        yield (row[own], place[own] + low, *(x[own] for x in rest))


def _packed(bucket: np.ndarray, buckets: int, columns: dict[str, np.ndarray]) -> dict[str, list]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    out: dict[str, list] = {"bucket": [int(bucket[a]) for a, _ in spans]}
    for name, values in columns.items():
        values = values[order]
        out[name] = [pack_planes(values[a:b]) if values.dtype == np.int64 else values[a:b].tobytes() for a, b in spans]
    return out


def _batch(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    n = len(next(iter(columns.values())))
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns.get(k, [None] * n), kinds[t]) for k, t in fields], names=[k for k, _ in fields])


SAMPLES = "rid long, rk string, bucket int, name binary, context binary, rids binary, places binary, near binary, far binary, many binary, chunk long, starts binary, ends binary"
SPANS = "chunk long, rids binary, starts binary, ends binary"
#: Sampled suffixes to go on with: near and far are the least and most distance from a window's start to the suffix.
GROUPED = SPANS + ", names binary, near binary, far binary, wants binary"
PLACES = "rid long, names binary, places binary, near binary, far binary, wants binary"
REGIONS = "bucket int, keys binary, rids binary, places binary, low binary, high binary, wants binary, regions binary, chunk long, starts binary, ends binary"


def sample_task(buckets: int, length: int, gram: int):
    """Task function: (rid, rk) of each row, and the tuples of sampled suffixes packed by bucket."""
    shift = U64(buckets.bit_length() - 1)

    def flush(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        rid, place, near, far, name, context = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Of equal contexts one goes on, and says that there are many; the bytes of all of them go.
        first, many = one_of_each(name, context)
        yield _spans(SAMPLES, rid[many], (place - far)[many], (place - near + length)[many])
        rid, place, near, far, name, context, many = (x[first] for x in (rid, place, near, far, name, context, many))
        columns = {"name": (name >> shift).astype(np.uint32), "context": context, "rids": rid, "places": place, "near": near.astype(np.uint16), "far": far.astype(np.uint16), "many": many.astype(np.uint8)}
        yield _batch(SAMPLES, _packed((name & U64(buckets - 1)).astype(np.int64), buckets, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, parts, held = TaskContext.get().partitionId() << 36, [], 0
        for batch in batches:
            n = batch.num_rows
            yield _batch(SAMPLES, {"rid": list(range(rid, rid + n)), "rk": batch.column("rk").to_pylist()})
            data, offsets = to_bytes_array(batch.column("text"))
            for first, _, chunk, at in slices(data, offsets):
                for row, *rest in sampled_parts(chunk, at, length, gram, 2 * SLICE_BYTES):
                    parts.append((row + first + rid, *rest))
                    held += len(row)
                    if held >= TUPLES_A_FLUSH:
                        yield from flush(parts)
                        parts, held = [], 0
            rid += n
        if held:
            yield from flush(parts)

    return run


def _columns(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> list[np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {k: [np.zeros(0, t)] for k, t in kinds.items()}
    for batch in batches:
        for k, t in kinds.items():
            parts[k].extend((unpack_planes(x) if t is np.int64 else np.frombuffer(x, t)) for x in batch.column(k).to_pylist())
    return [np.concatenate(x) for x in parts.values()]


def one_of_each(*names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of one row for each distinct tuple of names, and for every row whether others have its tuple."""
    order = np.lexsort(names)
    new = np.zeros(len(order), bool)
    for x in names:
        new |= np.diff(x[order], prepend=~x[order][:1]) != 0
    kind = np.cumsum(new) - 1
    many = np.empty(len(order), bool)
    many[order] = np.bincount(kind, minlength=1)[kind] > 1
    return np.sort(order[new]), many


def _cut(chunk: np.ndarray) -> list[tuple[int, int]]:
    edges = np.append(np.flatnonzero(np.diff(chunk, prepend=-1)), len(chunk))
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def _by_chunk(schema: str, rid: np.ndarray, order: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Columns packed by chunk of rows, in the given order, which sorts by row."""
    spans = _cut(rid[order] // CHUNK_ROWS)
    out: dict[str, list] = {"chunk": [int(rid[order[a]] // CHUNK_ROWS) for a, _ in spans]}
    for name, values in ({"rids": rid} | columns).items():
        values = values[order]
        out[name] = [pack_planes(values[a:b]) if values.dtype == np.int64 else values[a:b].tobytes() for a, b in spans]
    return _batch(schema, out)


def _spans(schema: str, rid: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return _by_chunk(schema, rid, np.lexsort((start, rid)), {"starts": start, "ends": end})


def named_bucket(length: int):
    """Group function: of a bucket's tuples, the spans to remove, and the sampled suffixes to go on with."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, context, rid, place, near, far, many = _columns(batches, {"name": np.uint32, "context": np.uint64, "rids": np.int64, "places": np.int64, "near": np.uint16, "far": np.uint16, "many": np.uint8})
        order = np.lexsort((context, name))
        name, context, rid, place, near, far, many = (x[order] for x in (name, context, rid, place, near.astype(np.int64), far.astype(np.int64), many))
        if not len(name):
            return
        new_name = np.diff(name, prepend=~name[:1]) != 0
        new_context = new_name | (np.diff(context, prepend=~context[:1]) != 0)
        group, kind = np.cumsum(new_name) - 1, np.cumsum(new_context) - 1
        shared = np.bincount(kind, 1 + many)[kind] > 1
        yield _spans(GROUPED, rid[shared], (place - far)[shared], (place - near + length)[shared])
        # Other contexts under the same name may have windows in common; of a shared context one suffix is the witness.
        on = (np.bincount(group[new_context])[group] > 1) & (~shared | new_context)
        rid, place, near, far, wants = rid[on], place[on], near[on].astype(np.uint16), far[on].astype(np.uint16), (~shared[on]).astype(np.uint8)
        full = name[on].astype(np.int64) << 24 | key[0].as_py()
        yield _by_chunk(GROUPED, rid, np.lexsort((place, rid)), {"starts": place, "ends": place, "names": full, "near": near, "far": far, "wants": wants})

    return run


def rows_of_chunk(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with its merged spans."""
    r, a, b = _columns(batches, {"rids": np.int64, "starts": np.int64, "ends": np.int64})
    order = np.lexsort((a, r))
    r, a, b = r[order], a[order], b[order]
    out: dict[str, list] = {"rid": [], "starts": [], "ends": []}
    for lo, hi in _cut(r):
        p, q = a[lo:hi], np.maximum.accumulate(b[lo:hi])
        fresh = np.concatenate([[True], p[1:] > q[:-1]])
        out["rid"].append(int(r[lo]))
        out["starts"].append(pack_planes(p[fresh]))
        out["ends"].append(pack_planes(q[np.append(np.flatnonzero(fresh)[1:], len(q)) - 1]))
    yield _batch("rid long, starts binary, ends binary", out)


def places_of_chunk(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with its sampled suffixes to go on with."""
    kinds = {"rids": np.int64, "names": np.int64, "starts": np.int64, "near": np.uint16, "far": np.uint16, "wants": np.uint8}
    rid, name, place, near, far, wants = _columns(batches, kinds)
    order = np.lexsort((place, rid))
    rid, name, place, near, far, wants = (x[order] for x in (rid, name, place, near, far, wants))
    spans = _cut(rid)
    packed = {"names": name, "places": place, "near": near, "far": far, "wants": wants}
    yield _batch(PLACES, {"rid": [int(rid[a]) for a, _ in spans], **{k: [pack_planes(v[a:b]) if v.dtype == np.int64 else v[a:b].tobytes() for a, b in spans] for k, v in packed.items()}})


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the runs that begin at ``first``, run after run."""
    return np.arange(count.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)


def region_task(buckets: int, length: int, gram: int):
    """Task function: sampled suffixes with the bytes of the windows they induce, packed by bucket.

    A window whose start is up to ``half`` before the suffix holds so many bytes of it that suffixes equal in these alone
    need to meet; a window that starts earlier, so many bytes before it. So a name that many documents hold falls apart
    by what stands around it. Of equal regions one goes on, as with equal contexts.
    """
    half = (length - gram) // 2

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, own, rid, place, low, high, wants = (np.concatenate([p[k] for p in parts]) for k in range(7))
        raw = np.concatenate([p[7] for p in parts])
        size = high - low + length
        at = np.cumsum(size) - size
        first, many = one_of_each(key, own)
        gone = many & (wants == 1)
        yield _spans(REGIONS, rid[gone], (place - high)[gone], (place - low + length)[gone])
        wants = np.where(many, 0, wants)
        bucket = (mix(key) & U64(buckets - 1)).astype(np.int64)
        order = first[np.argsort(bucket[first], kind="stable")]
        spans = _cut(bucket[order])
        columns = {"keys": key, "rids": rid, "places": place, "low": low.astype(np.uint16), "high": high.astype(np.uint16), "wants": wants.astype(np.uint8)}
        out: dict[str, list] = {"bucket": [int(bucket[order[a]]) for a, _ in spans]}
        for name, values in columns.items():
            out[name] = [pack_planes(values[order[a:b]]) if values.dtype == np.int64 else values[order[a:b]].tobytes() for a, b in spans]
        out["regions"] = [raw[_ranges(at[order[a:b]], size[order[a:b]])].tobytes() for a, b in spans]
        yield _batch(REGIONS, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            data, offsets = to_bytes_array(batch.column("text"))
            rows = zip(*(batch.column(c).to_pylist() for c in ("rid", "names", "places", "near", "far", "wants")), strict=True)
            for i, (rid, names, places, near, far, wants) in enumerate(rows):
                whole = data[offsets[i] : offsets[i + 1]]
                every = (unpack_planes(places), unpack_planes(names).astype(np.uint64), np.frombuffer(near, np.uint16).astype(np.int64), np.frombuffer(far, np.uint16).astype(np.int64), np.frombuffer(wants, np.uint8))
                done = 0
                while done < len(every[0]):
                    # Suffixes are ascending: those of one stretch of the text at a time, with what their windows reach.
                    upto = int(np.searchsorted(every[0], every[0][done] + SLICE_BYTES))
                    place, name, near, far, wants = (x[done:upto] for x in every)
                    done, base = upto, max(0, int(place[0]) - 2 * length)
                    own = whole[base : int(place[-1]) + 2 * length]
                    sums = prefix_sums(own, fold_case=False)
                    for left in (False, True):
                        on = far > half if left else near <= half
                        p, lo, hi = place[on] - base, np.maximum(near[on], half + 1) if left else near[on], far[on] if left else np.minimum(far[on], half)
                        around = substring_hash(sums, p - half - 1, p) if left else substring_hash(sums, p, p + length - half)
                        key = mix(around ^ mix(name[on] << U64(1) | U64(left)))
                        same = mix(substring_hash(sums, p - hi, p - lo + length) ^ mix(lo.astype(np.uint64) << U64(16) | hi.astype(np.uint64)))
                        raw = own[_ranges(p - hi, hi - lo + length)]
                        parts.append((key, same, np.full(len(p), rid), p + base, lo, hi, wants[on], raw))
                        held += len(raw)
                    if held >= REGION_BYTES:
                        yield from flush(parts)
                        parts, held = [], 0
        if parts:
            yield from flush(parts)

    return run


def lowest_between(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of lcp[a + 1 .. b] for each pair a < b."""
    if not len(a):
        return np.zeros(0, np.int64)
    return np.minimum.reduceat(np.append(lcp, 0), np.stack([a + 1, b + 1], axis=1).ravel())[::2]


def sorted_suffixes(group: np.ndarray, raw: np.ndarray, at: np.ndarray, extent: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes raw[at : at + extent] by (group, bytes), and each one's common prefix with the one before."""
    table = np.zeros((len(at), most), np.uint8)
    table[np.repeat(np.arange(len(at)), extent), _ranges(np.zeros_like(extent), extent)] = raw[_ranges(at, extent)]
    order = np.argsort(table.view(f"S{most}").ravel(), kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    lcp = np.zeros(len(at), np.int64)
    for lo in range(1, len(at), 1 << 14):  # in parts, as a table of comparisons is large
        a, b = order[lo - 1 : lo + (1 << 14) - 1], order[lo : lo + (1 << 14)]
        a = a[: len(b)]
        differ = table[a] != table[b]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
        lcp[lo : lo + len(b)] = np.where(group[a] == group[b], np.minimum(same, np.minimum(extent[a], extent[b])), 0)
    return order, lcp


def induced_bucket(length: int):
    """Group function: sorts a bucket's sampled suffixes and induces the order of all suffixes to the left of them that
    start a window; the bytes of those windows whose common prefix with a neighbour reaches ``length`` are to go."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"keys": np.uint64, "rids": np.int64, "places": np.int64, "low": np.uint16, "high": np.uint16, "wants": np.uint8, "regions": np.uint8}
        group, rid, place, low, high, wants, raw = _columns(batches, kinds)
        low, high = low.astype(np.int64), high.astype(np.int64)
        size = high - low + length
        suffix = np.cumsum(size) - size + high  # where the sampled suffix begins
        members = np.unique(group, return_inverse=True, return_counts=True)
        group, on = members[1], np.flatnonzero(members[2][members[1]] > 1)
        if not len(on):
            return
        order, lcp = sorted_suffixes(group[on], raw, suffix[on], length - low[on], length)
        order = on[order]
        found = []
        for step in range(int(high[on].max()) + 1):
            best = np.maximum(lcp, np.append(lcp[1:], 0))
            hit = order[(best >= length) & (low[order] <= step) & (wants[order] == 1)]
            found.append((rid[hit], place[hit] - step))
            # A suffix goes on while it has a byte before, and while its common prefix can still reach the length.
            stay = np.flatnonzero((high[order] > step) & (best + high[order] - step >= length))
            if not len(stay):
                break
            lcp = np.append(0, lowest_between(lcp, stay[:-1], stay[1:]))
            order = order[stay]
            before = group[order] << 8 | raw[suffix[order] - step - 1]
            rank = np.argsort(before, kind="stable")
            joined = np.flatnonzero(np.diff(before[rank]) == 0)
            grown = np.zeros(len(rank), np.int64)
            grown[joined + 1] = 1 + lowest_between(lcp, rank[joined], rank[joined + 1])
            order, lcp = order[rank], grown
        r, start = (np.concatenate(x) for x in zip(*found, strict=True))
        yield _spans(SPANS, r, start, start + length)

    return run


def removal_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rest of each text without its removed spans."""
    for batch in batches:
        data, offsets = to_bytes_array(batch.column("text"))
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": [], "kept": []}
        for i, (starts, ends) in enumerate(zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True)):
            own = data[offsets[i] : offsets[i + 1]]
            a, b = (unpack_planes(starts), unpack_planes(ends)) if starts else (np.zeros(0, np.int64),) * 2
            raw = b"".join(own[x:y].tobytes() for x, y in zip(np.append(0, b).tolist(), np.append(a, len(own)).tolist(), strict=True))
            for k, v in zip(out, (len(own), len(own) - len(raw), len(a), hashlib.sha256(raw).hexdigest(), [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)], raw), strict=True):
                out[k].append(v)
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(out[k], t) for k, t in (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", spans), ("kept", pa.binary())))], names=["doc_id", *out])


def _with_texts(rows: DataFrame, per_row: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Texts joined with their results on the row key; results below a measured size are broadcast."""
    sizes = [F.octet_length(c) for c, kind in per_row.dtypes if kind == "binary"]
    size = per_row.agg(F.coalesce(F.sum(sum(sizes, F.lit(64))), F.lit(0))).first()[0]
    return rows.join(F.broadcast(per_row) if size <= BROADCAST_BYTES else per_row, "rk", how).select("doc_id", "text", *columns)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts elsewhere in ``docs(doc_id, text, ...)``.

    Texts are UTF-8 bytes, null is empty, strings stay within a row, and overlaps within a row count. Returns one row
    per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, spans (start, end) and kept (the
    remaining bytes). Texts shorter than ``length`` stay whole. Repeated rows repeat each other's strings; a row without
    a doc_id is one like any other. Other columns are not read; an empty table gives no rows. Very long texts are worked on
    in stretches of ``SLICE_BYTES``.
    """
    # Rows are told apart by 128 bits of doc_id and text; equal rows share the key, and their results.
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"))
    rows = in_small_batches(docs).select("doc_id", "text", key.alias("rk"))
    buckets = bucket_count(corpus_size(docs)[1])
    sampled = materialize(rows.select("rk", "text").mapInArrow(sample_task(buckets, length, gram), SAMPLES), "samples")
    keys = sampled.where("rid is not null").select("rid", "rk")
    tuples = sampled.where("bucket is not null").select("bucket", "name", "context", "rids", "places", "near", "far", "many")
    named = materialize(tuples.groupBy("bucket").applyInArrow(named_bucket(length), GROUPED), "named")
    # Rows that repeat doc_id and text share a key but are places of their own; each key is joined with its texts once.
    undecided = named.where("names is not null").groupBy("chunk").applyInArrow(places_of_chunk, PLACES).join(keys, "rid")
    undecided = materialize(undecided, "undecided")
    texts = rows.dropDuplicates(["rk"]) if keys.groupBy("rk").count().where("count > 1").limit(1).count() else rows
    regions = _with_texts(texts, undecided, PLACES.replace(" long", "").replace(" binary", "").split(", "), "inner")
    regions = materialize(regions.mapInArrow(region_task(buckets, length, gram), REGIONS), "regions")
    meeting = regions.where("bucket is not null").select("bucket", "keys", "rids", "places", "low", "high", "wants", "regions")
    induced = meeting.groupBy("bucket").applyInArrow(induced_bucket(length), SPANS)
    spans = ["chunk", "rids", "starts", "ends"]
    known = [sampled.where("chunk is not null"), named.where("names is null"), regions.where("chunk is not null")]
    removed = reduce(DataFrame.unionByName, [x.select(*spans) for x in known], induced)
    per_row = removed.groupBy("chunk").applyInArrow(rows_of_chunk, "rid long, starts binary, ends binary").join(keys, "rid")
    per_row = materialize(per_row.groupBy("rk").agg(F.min_by(F.struct("starts", "ends"), "rid").alias("s")).select("rk", "s.starts", "s.ends"), "spans")
    out = _with_texts(rows, per_row, ["starts", "ends"], "left")
    return out.mapInArrow(removal_task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary")
