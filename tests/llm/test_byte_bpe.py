"""Byte-level BPE against tiktoken on whole texts, against merging by rank in plain Python, and round trips."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickframe.llm import bytebpe
from tickframe.llm.queries import QUERIES, vocabulary_path

RANKS = vocabulary_path("byte_bpe_50k.tiktoken")
RAW = bytebpe.read_ranks(RANKS)
ENC = bytebpe.encoding(RAW, public_tokenizers.PATTERN)
PARTS = ["a", "B", "'s", "'ll", "'", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "é", "字", "1", "²", "!", "😀", "\r\n", "x'", "don't", "’s", "​", "\x00", "~", "{", "@", "`", "<|endoftext|>"]


def merged(piece: bytes, ranks: dict) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def test_cuts_change_nothing():
    import regex

    draw, ranks, pattern = random.Random(5), bytebpe.parse_ranks(RAW), regex.compile(public_tokenizers.PATTERN)
    for n in range(3000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(40)))
        pieces = list(bytebpe.safe_pieces(text, 1))
        assert "".join(pieces) == text
        ids = bytebpe.encode_text(ENC, text, 1).tolist()
        assert ids == ENC.encode_ordinary(text)
        if n < 300 and "\x1c" not in text:
            assert ids == [i for m in pattern.findall(text) for i in merged(m.encode(), ranks)]


@pytest.mark.parametrize("run", [" " * 1_000_000, "\n" * 300_000, "　" * 100_000, "x" * 400_000, "字" * 200_000, "!?" * 200_000, "ab1" * 200_000])
def test_long_runs(run):
    ids = bytebpe.encode_text(ENC, f"one {run} two{run}")
    assert ENC.decode(ids.tolist()) == f"one {run} two{run}"
    # What stands around a run, and how the run ends, is as in a short one.
    if run[0] in " \n　":
        for tail in ("", "a", " a", "!"):
            whole, short = bytebpe.encode_text(ENC, f"a{run}{tail}"), ENC.encode_ordinary(f"a{run[:4000]}{tail}")
            assert whole[0] == short[0] and (not tail or whole[-1] == short[-1])


def test_query_against_the_library(spark, docs, rows, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(map(tuple, QUERIES["op12_byte_bpe"](spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    want = []
    for row in rows:
        ids = ENC.encode_ordinary(row[1] or "")
        want.append((row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()))
    assert found == sorted(want)


def test_real_outputs_and_odd_rows(spark):
    docs = spark.createDataFrame([(None, "no id"), (1, None), (1, None), (2, "emoji 😀")], "doc_id long, text string").withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit("mine"))
    encoded = bytebpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, piece_chars=2)
    assert encoded.columns == ["doc_id", "ids"] and encoded.where("size(ids) = 0").count() == 2
    back = bytebpe.decode_documents(encoded.withColumn("decoded", F.lit("mine")), RANKS)
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in back.collect()) == [(0, "no id"), (1, ""), (1, ""), (2, "emoji 😀")]
    # Part of a text's ids decodes to part of its bytes, also within a character; a null array is empty.
    first = encoded.where("doc_id = 2").select(F.expr("slice(ids, 1, size(ids) - 1) AS ids")).union(spark.sql("SELECT CAST(null AS array<int>)"))
    found = sorted(bytes(r["decoded"]) for r in bytebpe.decode_documents(first, RANKS).collect())
    assert found[0] == b"" and "emoji 😀".encode().startswith(found[1]) and 6 <= len(found[1]) < 10
    assert bytebpe.decode_documents(bytebpe.encode_documents(docs.where("false"), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0
    with pytest.raises(Exception, match="no token"):
        bytebpe.decode_documents(spark.sql("SELECT array(999999) AS ids"), RANKS).collect()
