"""Language-model scores from a subword lattice.

The model draws pieces independently, so a text's probability is the sum over all of its segmentations. White space is
the piece vocabulary's word mark, hence a text's lattice falls apart into one lattice per word, and a word's marginal
log-probability is computed once, by a log-space forward recursion over its bytes. The pieces are those of an existing
subword vocabulary, weighted by its own scores, and every word of the training documents as a piece of its own, weighted
by its count. A word is one such piece or spelled by the vocabulary's; the share of words to be spelled is that of tokens
that were new when they came (Witten-Bell).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.linededup import texts
from tickframe.llm.storage import bucket_count, corpus_size, in_small_batches, materialize
from tickframe.llm.suffixdedup import _batch, _packed
from tickframe.llm.textbatch import (
    NOT_SPACE,
    U64,
    prefix_sums,
    slices,
    substring_hash,
    to_bytes_array,
    unpack_planes,
    word_hash,
    word_spans,
)

MARK = "▁".encode()
#: The most frequent words, whose scores every task holds; all others are joined by shuffle.
HEAD_WORDS = 200_000
WORDS_A_FLUSH = 400_000
#: Words and bytes handled at once by the lattice; a longer word is walked window by window of so many bytes.
LATTICE_WORDS, LATTICE_BYTES = 10_000, 1 << 17
CHUNK_ROWS = 1 << 14
LN10 = float(np.log(10.0))


class Pieces:
    """A piece vocabulary; every byte is a piece, so that any word has a path."""

    def __init__(self, pieces: list[bytes]):
        self.longest = max(map(len, pieces))
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        hashes = substring_hash(prefix_sums(np.frombuffer(b"".join(pieces), np.uint8), fold_case=False), offsets[:-1], offsets[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        #: For each 16-bit hash prefix, where its hashes begin.
        self.starts = np.searchsorted(self.hashes >> U64(48), np.arange(65537, dtype=np.uint64))
        self.deepest = int(np.diff(self.starts).max())

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 for none."""
        at = self.starts[(hashes >> U64(48)).astype(np.int64)]
        found = np.full(len(hashes), -1, np.int64)
        for k in range(self.deepest):
            place = np.minimum(at + k, len(self.hashes) - 1)
            hit = self.hashes[place] == hashes
            found[hit] = self.order[place[hit]]
        return found


def read_pieces(model_path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model and their log-weights. Scores that are ranks weight by Zipf's law."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    weights: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        score = max(model.get_score(i), -1e6)
        piece = bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).encode()
        weight = 1e-6 if model.is_byte(i) else 1.0 / (2.7 - score)
        weights[piece] = max(weights.get(piece, 0.0), weight)
    for b in range(256):
        weights.setdefault(bytes([b]), 1e-6)
    total = sum(weights.values())
    return list(weights), np.log(np.array(list(weights.values())) / total)


class Lattice:
    """Edges (start, end, piece) of the lattices of many texts; node i of text w is flat place first[w] + i."""

    def __init__(self, texts: list[bytes], pieces: Pieces):
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        self.first = begin + np.arange(len(texts))
        self.last = self.first + sizes
        self.nodes = len(data) + len(texts)
        text = np.repeat(np.arange(len(texts)), sizes)
        places = np.arange(len(data))
        sums = prefix_sums(data, fold_case=False)
        start, end, piece, level = [], [], [], []
        for n in range(1, pieces.longest + 1):
            at = places[places + n <= ends[text]] if len(places) else places
            found = pieces.find(substring_hash(sums, at, at + n))
            at, found = at[found >= 0], found[found >= 0]
            start.append(at + text[at])
            end.append(at + text[at] + n)
            piece.append(found)
            level.append(at - begin[text[at]] + n)
        self.start, self.end, self.piece, self.level = (np.concatenate(x) for x in (start, end, piece, level))

    def forward(self, log_weight: np.ndarray, value: np.ndarray) -> None:
        """Add the log-space sums over all paths into ``value``, one level of nodes at a time."""
        order = np.lexsort((self.end, self.level))
        level, into, out_of = self.level[order], self.end[order], self.start[order]
        weight = log_weight[self.piece[order]]
        cuts = np.append(np.flatnonzero(np.diff(level, prepend=-1)), len(level))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            score = value[out_of[lo:hi]] + weight[lo:hi]
            edge = np.flatnonzero(np.diff(into[lo:hi], prepend=-1))
            top = np.maximum(np.maximum.reduceat(score, edge), -1e300)
            spread = np.repeat(top, np.diff(edge, append=hi - lo))
            nodes = into[lo:hi][edge]
            value[nodes] = np.logaddexp(value[nodes], top + np.log(np.add.reduceat(np.exp(score - spread), edge)))


def long_marginal(text: bytes, pieces: Pieces, log_weight: np.ndarray, window: int = LATTICE_BYTES) -> float:
    """Natural log-probability of one text of any length: windows of edges, of which only the last nodes are carried."""
    carried = np.full(pieces.longest, -np.inf)
    carried[0] = 0.0
    for at in range(0, len(text), window):
        part = text[at : at + window + pieces.longest - 1]
        lattice = Lattice([part], pieces)
        own = lattice.start < window
        lattice.start, lattice.end, lattice.piece, lattice.level = (x[own] for x in (lattice.start, lattice.end, lattice.piece, lattice.level))
        value = np.full(max(lattice.nodes, window + pieces.longest), -np.inf)
        value[: len(carried)] = carried
        with np.errstate(divide="ignore"):
            lattice.forward(log_weight, value)
        carried = value[window : window + pieces.longest]
    return float(value[len(text) - at]) if text else 0.0


def marginals(words: list[bytes], pieces: Pieces, log_weight: np.ndarray, window: int = LATTICE_BYTES) -> np.ndarray:
    """Natural log-probability of each marked word over all segmentations."""
    marked = [MARK + w for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    out = np.empty(len(words))
    long = sizes > window
    for i in np.flatnonzero(long):
        out[i] = long_marginal(marked[i], pieces, log_weight, window)
    short = np.flatnonzero(~long)
    turn = np.maximum(np.cumsum(sizes[short]) // window, np.arange(len(short)) // LATTICE_WORDS)
    for own in np.split(short, np.flatnonzero(np.diff(turn)) + 1):
        lattice = Lattice([marked[i] for i in own], pieces)
        value = np.full(lattice.nodes, -np.inf)
        value[lattice.first] = 0.0
        lattice.forward(log_weight, value)
        out[own] = value[lattice.last]
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 1, F.lit(False))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, training count, documents' count) of a task; held-out documents' words count zero in training."""

    def rows(train: Counter, test: Counter) -> pa.RecordBatch:
        words = list(train | test)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64())], names=["word", "c"])

    train, test = Counter(), Counter()
    for batch in batches:
        for text, held in zip(texts(batch.column("text")), batch.column("held_out").to_pylist(), strict=True):
            (test if held else train).update(text.lower().split())
            if len(train) + len(test) > WORDS_A_FLUSH:
                yield rows(train, test)
                train, test = Counter(), Counter()
    yield rows(train, test)


LEXICON = "bucket int, hash long, c long, lp double"


def score_words(sent, buckets: int):
    """Task function: (bucket, hash, c, log-probability) of each word, by its lattice and as a piece of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, log_weight, log_spelled, total = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, LATTICE_WORDS):
                part = batch.slice(at, LATTICE_WORDS)
                words = part.column("word").to_pylist()
                with np.errstate(divide="ignore"):
                    whole = np.log(part.column("c").to_numpy() / total)
                lp = np.logaddexp(log_spelled + marginals(words, pieces, log_weight), whole)
                offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                hashes = word_hash(np.frombuffer(b"".join(words), np.uint8), offsets[:-1], offsets[1:])
                bucket = (hashes & U64(buckets - 1)).astype(np.int32)
                columns = [pa.array(bucket), pa.array(hashes.view(np.int64)), part.column("c"), pa.array(lp)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "hash", "c", "lp"])

    return run


PARTS = "chunk long, rid long, doc_id long, held_out boolean, n long, known long, base double, lp double, bucket int, hashes binary, rids binary"


def score_head(head, buckets: int, base_of):
    """Task function: each row's sums over frequent words, and its other words' hashes packed by bucket."""
    names = [x.split()[0] for x in PARTS.split(", ")]
    types = [pa.int64()] * 3 + [pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]

    def batch_of(columns: dict[str, object], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in zip(names, types, strict=True)], names=names)

    def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, rid = (np.concatenate(x) for x in zip(*parts, strict=True))
        packed = _packed((hashes & U64(buckets - 1)).astype(np.int64), buckets, {"hashes": hashes, "rids": rid})
        return batch_of(packed, len(packed["bucket"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, lps = head.value
        bases = base_of(counts)
        rid, parts, held = TaskContext.get().partitionId() << 36, [], 0
        for batch in batches:
            data, offsets = to_bytes_array(batch.column("text"))
            for first, end, chunk, at in slices(data, offsets):
                starts, ends, before = word_spans(chunk, at, NOT_SPACE)
                words = word_hash(chunk, starts, ends)
                place = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
                hit = known[place] == words if len(known) else np.zeros(len(words), bool)
                rows = np.arange(rid + first, rid + end)
                owner = np.repeat(rows, np.diff(before))
                sums = [np.bincount((owner - rows[0])[hit], w[place[hit]] if w is not None else None, minlength=len(rows)) for w in (bases, lps, (counts > 0).astype(np.float64))]
                part = batch.slice(first, end - first)
                yield batch_of({"chunk": rows // CHUNK_ROWS, "rid": rows, "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n": np.diff(before), "known": sums[2].astype(np.int64), "base": sums[0], "lp": sums[1]}, len(rows))
                parts.append((words[~hit], owner[~hit]))
                held += int((~hit).sum())
                if held >= 1 << 20:
                    yield flush(parts)
                    parts, held = [], 0
            rid += batch.num_rows
        if held:
            yield flush(parts)

    return run


TAIL = "chunk long, rids binary, known binary, base binary, lp binary"


def score_tail(base_of):
    """Cogroup function: the sums of a bucket's rare words, packed by chunk of rows."""

    def run(packed: pa.Table, lexicon: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in packed.column("hashes").to_pylist())])
        rid = np.concatenate([np.zeros(0, np.int64), *(unpack_planes(x) for x in packed.column("rids").to_pylist())])
        if not len(hashes):
            return pa.Table.from_batches([_batch(TAIL, {"chunk": []})])
        known = lexicon.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(known)
        place = order[np.searchsorted(known[order], hashes)]
        c, lp = lexicon.column("c").to_numpy()[place], lexicon.column("lp").to_numpy()[place]
        rows, at = np.unique(rid, return_inverse=True)
        sums = np.bincount(at, c > 0).astype(np.int64), np.bincount(at, base_of(c)), np.bincount(at, lp)
        chunk = rows // CHUNK_ROWS
        edges = np.append(np.flatnonzero(np.diff(chunk, prepend=-1)), len(chunk))
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        return pa.Table.from_batches([_batch(TAIL, {"chunk": [int(chunk[a]) for a, _ in spans], **{k: [v[a:b].tobytes() for a, b in spans] for k, v in zip(("rids", "known", "base", "lp"), (rows, *sums), strict=True)}})])

    return run


def add_parts(end_base: float, end_lp: float, end_known: int, train_tokens: int):
    """Cogroup function: rows of a chunk with the sums of all buckets and of the end token."""

    def run(rows: pa.Table, tail: pa.Table) -> pa.Table:
        rid = rows.column("rid").to_numpy()
        order = np.argsort(rid)
        sums = [rows.column("known").to_numpy().astype(np.float64), rows.column("base").to_numpy().copy(), rows.column("lp").to_numpy().copy()]
        sums = [s.copy() for s in sums]
        for r, *found in zip(*(tail.column(c).to_pylist() for c in ("rids", "known", "base", "lp")), strict=True):
            at = order[np.searchsorted(rid[order], np.frombuffer(r, np.int64))]
            for total, raw, kind in zip(sums, found, (np.int64, np.float64, np.float64), strict=True):
                total[at] += np.frombuffer(raw, kind)
        n = rows.column("n").to_numpy() + 1
        return pa.table({
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"), "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(sums[0].astype(np.int64) + end_known), "train_tokens": pa.array(np.full(len(n), train_tokens)),
            "base_score": pa.array(sums[1] + end_base), "score": pa.array((sums[2] + end_lp) / LN10), "score_per_token": pa.array((sums[2] + end_lp) / LN10 / n),
        })

    return run


class BaseScore:
    """log10 of a token's smoothed share of the training tokens."""

    def __init__(self, tokens: int, distinct: int):
        self.total = tokens + 0.5 * (distinct + 1)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / self.total)


def score_documents(docs: DataFrame, model_path: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """Score every row of ``docs(doc_id, text, ...)`` by the lattice model and by the word-count base.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text: its
    words' marginals and one end) and score_per_token. Tokens are the words cut at ASCII white space, A-Z lower-cased, then one end; null
    and empty texts are an end alone. Rows with crc32(doc_id) mod 5 = 1 are only scored; rows without a doc_id are
    learnt from. Repeated rows each count and get their row. Other columns are not read; an empty table gives no rows.
    To the driver come the ``head_words`` most frequent words' numbers, whatever the corpus; all other words' counts and
    probabilities stay in Spark and meet the texts in a join.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = in_small_batches(docs).select("doc_id", held_out().alias("held_out"), "text")
    buckets = bucket_count(corpus_size(docs)[1])
    words = materialize(rows.select("text", "held_out").mapInArrow(count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = rows.where("not held_out").count()
    tokens, distinct = totals["n"] + ends, totals["v"] + (ends > 0)
    base = BaseScore(tokens, distinct)

    # A word piece weighs c / total, and spelled words share a count of one for each distinct token.
    pieces, prior = read_pieces(model_path)
    total = tokens + distinct + 1.0
    sent = sc.broadcast((Pieces(pieces), prior, np.log((distinct + 0.5) / total), total))
    end_lp = float(np.log((ends + 0.5) / total))
    lexicon = materialize(words.mapInArrow(score_words(sent, buckets), LEXICON), "lexicon")
    head = lexicon.select("hash", "c", "lp").orderBy(F.desc("c"), "hash").limit(head_words).toArrow()
    known = head.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(known)
    table = sc.broadcast((known[order], head.column("c").to_numpy()[order], head.column("lp").to_numpy()[order]))
    parts = materialize(rows.mapInArrow(score_head(table, buckets, base), PARTS), "parts")
    rare = parts.where("bucket is not null").select("bucket", "hashes", "rids")
    tail = rare.groupBy("bucket").cogroup(lexicon.groupBy("bucket")).applyInArrow(score_tail(base), TAIL)
    own = parts.where("rid is not null").select("chunk", "rid", "doc_id", "held_out", "n", "known", "base", "lp")
    end = add_parts(float(base(np.array([ends]))[0]), end_lp, int(ends > 0), tokens)
    return own.groupBy("chunk").cogroup(tail.groupBy("chunk")).applyInArrow(end, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, score_per_token double")
