"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The pattern's matches never run from a character that is not white space into a space or line end, nor from an ASCII
letter or digit into another kind of ASCII character. A text cut at such places has the same matches on both sides, so long
texts are encoded in pieces of about ``PIECE_CHARS`` characters, whatever their length.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickframe.llm.storage import in_small_batches
from tickframe.llm.textbatch import lean

#: Characters after which a text is cut at the next safe boundary.
PIECE_CHARS = 1 << 18
#: Ids, or decoded bytes, that one Arrow batch gathers before it is handed on.
BATCH_IDS = 1 << 20
#: Places that lie between two matches: before a space or line end, or where an ASCII letter or digit ends.
BOUNDARY = regex.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-z])(?=[\x00-@\[-`{-\x7F])|(?<=[0-9])(?=[\x00-/:-\x7F])")

#: Runs of the pattern's white space that the library's own matcher has no stack for. All but the last character of such a
#: run, or all of it at a text's end, is one match.
LONG_RUN = regex.compile("[\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]{4096,}")

_ENCODINGS: dict[tuple[int, str], tiktoken.Encoding] = {}


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read once where the job is built; tasks get them by broadcast, so only there must it lie."""
    return Path(path).read_bytes()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


def encoding(raw: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding, built once for each worker process."""
    key = (hash(raw), pattern)
    if key not in _ENCODINGS:
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=parse_ranks(raw), special_tokens={})
    return _ENCODINGS[key]


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of at least ``limit`` characters, cut at safe boundaries only; short texts are one piece.

    A stretch without such a boundary, as one word of millions of letters, stays in one piece.
    """
    at = 0
    while len(text) - at > limit:
        cut = BOUNDARY.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def encode_text(enc: tiktoken.Encoding, text: str, limit: int = PIECE_CHARS) -> np.ndarray:
    """All ids of a text, special tokens' strings being ordinary text."""
    parts, at = [np.zeros(0, np.int32)], 0

    def add(part: str) -> None:
        parts.extend(enc.encode_to_numpy(piece, allowed_special=set(), disallowed_special=()).astype(np.int32) for piece in safe_pieces(part, limit) if piece)

    for run in LONG_RUN.finditer(text) if len(text) >= 4096 else ():
        add(text[at : run.start()])
        at = run.end() - (run.end() < len(text))
        parts.append(np.array(enc._encode_single_piece(text[run.start() : at]), np.int32))
    add(text[at:] if at else text)
    return np.concatenate(parts)


def encode_task(ranks: Broadcast, pattern: str, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            first, ids, held = 0, [], 0
            texts = batch.column("text")
            for row in range(batch.num_rows):
                ids.append(encode_text(enc, texts[row].as_py() or "", limit))
                held += len(ids[-1])
                if held >= BATCH_IDS or row == batch.num_rows - 1:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(ids)), column], names=["doc_id", "ids"])
                    first, ids, held = row + 1, [], 0

    return run


def decode_task(ranks: Broadcast, others: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sorted((rank, token) for token, rank in parse_ranks(ranks.value).items())
        size = table[-1][0] + 1 if table else 0
        width = np.full(size, -1, np.int64)
        width[[rank for rank, _ in table]] = [len(token) for _, token in table]
        start = np.concatenate([[0], np.cumsum(np.maximum(width, 0))])
        pool = np.frombuffer(b"".join(token for _, token in table), np.uint8)
        for batch in batches:
            column, first, texts, held = batch.column("ids"), 0, [], 0
            for row in range(batch.num_rows):
                ids = column[row].values
                ids = np.zeros(0, np.int64) if ids is None else ids.to_numpy(zero_copy_only=False).astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= size or (width[ids] < 0).any()):
                    raise ValueError("an id has no token in the rank file")
                # Long texts are put together in slices, as the places take eight bytes for each byte.
                slices = (ids[i : i + PIECE_CHARS] for i in range(0, len(ids), PIECE_CHARS))
                texts.append(b"".join(pool[np.repeat(start[x] - (np.cumsum(width[x]) - width[x]), width[x]) + np.arange(int(width[x].sum()))].tobytes() for x in slices))
                held += len(texts[-1])
                if held >= BATCH_IDS or row == batch.num_rows - 1:
                    kept = [batch.column(n).slice(first, len(texts)) for n in others]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.binary())], names=[*others, "decoded"])
                    first, texts, held = row + 1, [], 0

    return run


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, ids) of every row of ``docs(doc_id, text, ...)``: the ids that tiktoken gives each match of ``pattern``.

    Null and empty texts have no ids; rows without a doc_id and repeated rows each get their row; other columns are not
    read, whatever their names; an empty table gives no rows. Nothing shuffles. A text's ids are one value, four bytes each,
    so a text may have up to some 500 million.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return in_small_batches(docs).select("doc_id", "text").mapInArrow(lean(encode_task(ranks, pattern, piece_chars)), schema)


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with its array ``ids`` turned back to raw bytes in ``decoded``, which is replaced where it was there.

    Bytes need not be whole characters: any cut of a text's ids decodes. A null array is empty; an id without a token in
    the rank file is an error.
    """
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])
    return encoded.select(*[f.name for f in kept]).mapInArrow(lean(decode_task(ranks, [f.name for f in kept])), schema)
