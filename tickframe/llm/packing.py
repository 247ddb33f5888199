"""Best-fit packing of tokenised documents, planned on the histogram of piece lengths.

Pieces of equal length are interchangeable, so the plan needs only how many pieces each length (1 to ``capacity``) has.
Martello-Toth dominance first fixes sequences that no other choice can better, in bulk for all pieces of a length; the
rest is packed best-fit, longest first. The plan is a table of slots; every piece finds its own by its rank within its
length, which is computed by Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.storage import in_small_batches, materialize
from tickframe.llm.textbatch import NOT_SPACE, lean, slices, to_bytes_array, word_hash, word_spans

CAPACITY = 2048
#: Words whose ids a worker remembers, in about 40 bytes each.
CACHE_WORDS = 1_000_000
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
#: Pieces ranked by one task.
PIECES_A_SALT = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Texts on which a tokenizer shows what it does with case, white space and plain words.
PROBES = ["ab", "The", "WORDS", "word.", "straße", "École", "naïve,", "don", "x1", "señor", "Über", "tokenisation", "façade!?", "hello", "zzyzx", "日本", "éé", "e\u0301"]


class WordIds:
    """Ids of white-space separated words by word hash, as flat arrays.

    Words stand alone where white space ends a token (``splits``), and share ids across case where the tokenizer folds A-Z
    (``folds``); both are told by PROBES, not by the data. New words are encoded by the tokenizer. Where the probes allow
    it (``trusted``), lower-case letters with trailing punctuation are two of its words, which need none of its
    normalising and splitting rules and are encoded without them, many at once.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full, self.plain = Tokenizer.from_str(tokenizer_json), Tokenizer.from_str(tokenizer_json)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.full.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends_word[number] = token.endswith("</w>")
        self.tails: dict[str, list[int]] = {"": []}
        self.clear()
        alone = [self.ids(p) for p in PROBES]
        spaced = [(" ", "  ", "\n", "\t", " \n ")[i % 5].join(PROBES[i : i + 3]) for i in range(len(PROBES) - 2)]
        self.splits = all(self.ids(t) == sum(alone[i : i + 3], []) for i, t in enumerate(spaced)) and not self.ids(" \n")
        self.folds = all(self.ids(p.translate(ASCII_LOWER)) == ids and self.ids(p.upper() if p.isascii() else p) == ids for p, ids in zip(PROBES, alone, strict=True))
        self.trusted = self.folds
        self.trusted = self.trusted and self._encode(PROBES) == alone

    def ids(self, text: str) -> list[int]:
        return self.full.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.levels = [none, none]  # (sorted hashes, place in flat, length): all, and the recent ones
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and length of each hash's ids; length -1 if unknown."""
        place, length = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int64)
        for known, places, lengths in self.levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                place[hit], length[hit] = places[at[hit]], lengths[at[hit]]
        return place, length

    def of_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and where each row's begin and end."""
        starts, ends, before = word_spans(data, offsets, NOT_SPACE)
        # Special tokens are case-sensitive, whatever the rest is.
        hashes = word_hash(data, starts, ends, fold_case=self.folds and b"<|" not in data.tobytes())
        place, length = self.of(hashes, starts, ends, data)
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.flat[np.arange(total[-1]) + np.repeat(place - total[:-1], length)].astype("<u4")
        return ids, total[before]

    def of(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and length in ``flat`` of every word's ids."""
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.levels[0][0]) + len(self.levels[1][0]) + len(unique) > CACHE_WORDS:
            self.clear()
        place, length = self._find(unique)
        new = np.flatnonzero(length < 0)
        if len(new):
            raw = data.tobytes()
            self._learn(unique[new], [raw[starts[i] : ends[i]].decode() for i in first[new]])
            place, length = self._find(unique)
        return place[inverse], length[inverse]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found = self._encode(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        entry = hashes, self.used + np.cumsum(lengths) - lengths, lengths
        self.used += len(ids)
        self.levels[1] = self._merge(self.levels[1], entry)
        if 8 * len(self.levels[1][0]) > len(self.levels[0][0]):
            self.levels = [self._merge(*self.levels), tuple(x[:0] for x in entry)]

    @staticmethod
    def _merge(a: tuple, b: tuple) -> tuple:
        order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
        return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b, strict=True))

    def _encode(self, words: list[str]) -> list[list[int]]:
        found: list[list[int] | None] = [None] * len(words)
        cores: dict[str, list[int]] = {}
        split: list[tuple[int, str, str]] = []
        for i, word in enumerate(words):
            low = word.lower() if word.isascii() else word.translate(ASCII_LOWER)
            core = low.rstrip(PUNCTUATION)
            tail = low[len(core) :]
            if self.trusted and core.isalpha() and "'" not in tail and (core.isascii() or (core == core.lower() and is_normalized("NFC", core))):
                split.append((i, core, tail))
                cores[core] = []
                if tail not in self.tails:
                    self.tails[tail] = self.ids(tail)
        self._encode_plain(list(cores), cores)
        for i, core, tail in split:
            found[i] = cores[core] + self.tails[tail] if tail else cores[core]
        rest = [i for i, f in enumerate(found) if f is None]
        for i, e in zip(rest, self.full.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
            found[i] = e.ids
        return found

    def _encode_plain(self, words: list[str], into: dict[str, list[int]]) -> None:
        runs = [words[i : i + 256] for i in range(0, len(words), 256)]
        for run, e in zip(runs, self.plain.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False), strict=True):
            ids = e.ids
            ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(ends) != len(run):
                for word, own in zip(run, self.full.encode_batch_fast(run, add_special_tokens=False), strict=True):
                    into[word] = own.ids
                continue
            start = 0
            for word, end in zip(run, ends, strict=True):
                into[word] = ids[start:end]
                start = end


_WORKER: dict[int, WordIds] = {}


def tokenise(tokenizer, capacity: int, end_id: int):
    """Task function: the pieces of every document, cut only when longer than ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        text_json = tokenizer.value
        if (words := _WORKER.get(hash(text_json))) is None:
            words = _WORKER[hash(text_json)] = WordIds(text_json)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            doc_ids = batch.column("doc_id").to_pylist()
            for first, end, data, offsets in slices(*to_bytes_array(batch.column("text"))):
                if words.splits:
                    ids, cuts = words.of_words(data, offsets)
                else:
                    found = [words.ids(data[a:b].tobytes().decode()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                    ids, cuts = np.fromiter(chain.from_iterable(found), "<u4"), np.concatenate([[0], np.cumsum(list(map(len, found)))])
                for row in range(end - first):
                    own = np.append(ids[cuts[row] : cuts[row + 1]], np.array([end_id], "<u4")).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        for column, value in zip(out, (doc_ids[first + row], piece, start, len(cut), zlib.crc32(cut.tobytes())), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


class Plan:
    """Slots: ``count`` pieces of ``length`` go ``per`` to a sequence, from ``sequence`` on, at ``offset`` in each."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.rank: dict[int, int] = {}
        self.slots: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, per, offset
        self.sequences = 0
        self.fixed = 0  # sequences fixed by dominance
        self._reduce()
        self._best_fit()

    def _place(self, length: int, count: int, sequence: int, per: int, offset: int) -> None:
        first = self.rank.get(length, 0)
        self.slots.append((length, first, sequence, per, offset))
        self.rank[length] = first + count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def _fix(self, lengths: list[int], times: int) -> None:
        offset = 0
        for length in lengths:
            self._place(length, times, self.sequences, 1, offset)
            offset += length
        self.sequences += times
        self.fixed += times

    def _reduce(self) -> None:
        """Fix a set that dominates every other set holding its longest piece.

        A piece that fits with no other is fixed alone. Where one more piece fits at most, the longest that fits is
        best. A partner that fills the sequence exactly dominates any other choice. Where two more fit at most, the
        longest single partner dominates if no two that fit together are longer.
        """
        for length in sorted(self.left, reverse=True):
            while self.left.get(length):
                room = self.capacity - length
                sizes = sorted(self.left)
                least = next((s for s in sizes if s != length or self.left[s] > 1), None)
                if least is None or least > room:
                    self._fix([length], self.left[length])
                    continue
                if self.left.get(room, 0) > (room == length):
                    self._fix([length, room], self.left[length] // 2 if room == length else min(self.left[length], self.left[room]))
                    continue
                at = bisect_left(sizes, room + 1) - 1
                while at >= 0 and sizes[at] == length and self.left[length] < 2:
                    at -= 1
                best = sizes[at]
                two_least = self._least(2, length)
                if two_least is None or two_least > room:
                    times = self.left[length] // 2 if best == length else min(self.left[length], self.left[best])
                    self._fix([length, best], times)
                    continue
                three_least = self._least(3, length)
                if (three_least is None or three_least > room) and best != length and self._best_pair(sizes, room, length) <= best:
                    # What is taken away only leaves fewer pairs and larger sums: it holds for all pieces of both lengths.
                    self._fix([length, best], min(self.left[length], self.left[best]))
                    continue
                break

    def _least(self, k: int, beside: int) -> int | None:
        """Sum of the k shortest pieces other than one of length ``beside``."""
        total = 0
        for size in sorted(self.left):
            take = min(k, self.left[size] - (size == beside))
            total, k = total + take * size, k - take
            if not k:
                return total
        return None

    def _best_pair(self, sizes: list[int], room: int, beside: int) -> int:
        """The largest sum of two pieces that fit together."""
        best, low, high = 0, 0, len(sizes) - 1
        while low <= high:
            total = sizes[low] + sizes[high]
            if total > room:
                high -= 1
            else:
                if low != high or self.left[sizes[low]] - (sizes[low] == beside) > 1:
                    best = max(best, total)
                low += 1
        return best

    def _best_fit(self) -> None:
        open_rooms: list[int] = []
        groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)

        def put(room: int, first: int, count: int) -> None:
            if room and count:
                if room not in groups:
                    insort(open_rooms, room)
                groups.setdefault(room, []).append((first, count))

        for length in sorted(self.left, reverse=True):
            while count := self.left.get(length, 0):
                at = bisect_left(open_rooms, length)
                if at < len(open_rooms):
                    room = open_rooms[at]
                    first, n = groups[room].pop()
                    if not groups[room]:
                        del groups[room]
                        open_rooms.pop(at)
                else:
                    room, first, n = self.capacity, self.sequences, -(-count // (self.capacity // length))
                    self.sequences += n
                per = room // length
                full = min(n, count // per)
                if full:
                    self._place(length, full * per, first, per, self.capacity - room)
                    put(room - per * length, first, full)
                if full < n:
                    rest = self.left.get(length, 0)
                    if rest:
                        self._place(length, rest, first + full, rest, self.capacity - room)
                        put(room - rest * length, first + full, 1)
                        full += 1
                    put(room, first + full, n - full)


def place(plan):
    """Task function: sequence and offset of each piece from its length and its rank within the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, slots = plan.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            slot = slots[np.searchsorted(key, length << 44 | rank, "right") - 1]
            within = rank - slot[:, 1]
            per = slot[:, 3]
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(slot[:, 2] + within // per), pa.array(slot[:, 4] + within % per * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pack ``docs(doc_id, text, ...)`` into few sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document's ids are the
    tokenizer's without special tokens, then ``end_id``; null and empty texts are ``end_id`` alone. Rows that repeat a
    doc_id are packed as documents of their own. Other columns are not read; an empty table gives no rows. What reaches
    the driver is the histogram of piece lengths, ``capacity`` numbers at most, and the plan has a few slots for each
    length. Any tokenizer of the ``tokenizers`` package will do: one that keeps case or joins words across white space is
    given whole words or whole texts, which is slower. A row without a doc_id is packed like any other.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    pieces = materialize(in_small_batches(docs).select("doc_id", "text").mapInArrow(lean(tokenise(sc.broadcast(tokenizer_json), capacity, end_id)), PIECES), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], PIECES + ", sequence_id long, offset long")
    plan = Plan(counts, capacity)
    slots = np.array(sorted(plan.slots), np.int64)
    sent = sc.broadcast((slots[:, 0] << 44 | slots[:, 1], slots))
    # Ranks within a length: pieces of one length are dealt over salts, and each salt starts after the ones before it.
    salts = max(64, -(-sum(counts.values()) // PIECES_A_SALT))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    bases = sizes.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("own", own).join(bases, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("own") - 1)
    return ranked.mapInArrow(lean(place(sent)), PIECES + ", sequence_id long, offset long")
