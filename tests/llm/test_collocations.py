"""Collocations against brute force, and edge cases of the parse."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickframe.llm import collocations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def phrases(rows, most):
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                counts.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts


def brute(rows, most=3, least=10, top=2000, cover=50):
    f = phrases(rows, most)
    n = Counter()
    for (lang, p), c in f.items():
        n[lang] += c * (len(p) == 1)
    candidates = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    scored = []
    for (lang, p), a in candidates.items():
        score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        if not any(o == lang and len(q) > len(p) and 100 * c >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (o, q), c in candidates.items()):
            scored.append((lang, -score, -a, " ".join(p).encode(), l, r))
    out, ranks = [], Counter()
    for lang, score, a, p, l, r in sorted(scored):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], p.decode(), -a, l, r, n[lang], -score))
    return out


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(seed, documents=300):
    draw = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "東京", "x", "a\x00b", "'", "--", "straße", "\x1f"]
    ends = [" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\r\n", "; ", "\x0b"]
    texts = ["".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randrange(40))) for _ in range(documents)]
    texts += [" ".join(["same"] * 3000), " ".join(f"w{i % 700}" for i in range(5000)) + " new york city", "New York City", "new york city" * 2, "x" * 100_000 + " new york"]
    rows = [(draw.choice(["en", "de", None]), t) for t in texts]
    return [*rows, ("en", None), ("fr", ""), (None, " \t."), *rows[:50]]


@pytest.mark.parametrize(("seed", "most", "least", "top", "spacing", "longest"), [(1, 3, 10, 2000, 16, 256), (2, 3, 3, 20, 2, 8), (3, 2, 4, 50, 1, 1), (4, 4, 3, 2000, 5, 3), (5, 5, 2, 30, 3, 64)])
def test_against_brute_force(spark, monkeypatch, seed, most, least, top, spacing, longest):
    rows = made(seed)
    monkeypatch.setattr(collocations, "SPACING", spacing)
    monkeypatch.setattr(collocations, "LONGEST", longest)
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("f", F.lit("mine")).withColumn("rank", F.lit(1)).withColumn("chunk", F.lit("mine")).repartition(5)
    assert found(collocations.mine_collocations(df, most, least, top)) == sorted(brute(rows, most, least, top))


@pytest.mark.parametrize("overlap", [1, 2, 3])
def test_chunks_end_with_their_row_and_are_short(overlap):
    text = np.frombuffer((" ".join(f"w{i * i % 911}" for i in range(4000)) + "\nshort one two\n" + "same " * 2000).encode(), np.uint8)
    starts, ends = collocations.edges(~collocations.WORD_END[text])
    row = np.cumsum(text == 10)[starts]
    first = collocations.cuts(collocations.word_hash(text, starts, ends), row, overlap)
    assert first[0] == 0 and (np.diff(first) > 0).all() and set(np.flatnonzero(np.diff(row) > 0) + 1) <= set(first)
    assert np.diff(np.append(first, len(starts))).max() < collocations.LONGEST + overlap
    assert all(row[c] == row[c + overlap - 1] for c in first if c and row[c] == row[c - 1])


def test_exact_arithmetic_and_ties(spark, monkeypatch):
    """Products past 64 bits, and the lower of two equal cuts."""
    big = 3_000_000_000
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1), ("en", 1, "c", 40), ("en", 2, "b c", 40), ("en", 3, "a b c", 12)]
    often = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    n = 2 * big + 41
    monkeypatch.setattr(collocations, "phrase_tables", lambda *_: (spark.createDataFrame([("en", n)], "lang string, n long"), often))
    got = {r["phrase"]: (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in collocations.mine_collocations(often).collect()}
    assert got["a b"] == (big - 1, big, big + 1, n, 10**6 * (big - 1) ** 2 // (big * (big + 1)))
    # Both cuts of "a b c" score 0: the earliest counts.
    assert got["a b c"] == (12, big, 40, n, 10**6 * 144 // (big * 40))


def test_full_filter_and_its_segments(spark, monkeypatch):
    rows = made(6)
    want = sorted(brute(rows, 3, 4))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for name, value in (("MOST_BITS", 8), ("SEGMENT_BITS", 64)):
        with monkeypatch.context() as patch:
            patch.setattr(collocations, name, value)
            assert found(collocations.mine_collocations(df, 3, 4)) == want
    often = spark.createDataFrame([("en", f"w{i} w{i + 1}") for i in range(500)], "lang string, phrase string")
    monkeypatch.setattr(collocations, "SEGMENT_BITS", 1024)
    known = collocations.frequent_filter(often, 2)

    def hashes(words):
        data, _ = collocations.lines(pa.array([words]))
        starts, ends = collocations.edges((data != 32) & (data != 10))
        return collocations.phrase_hash(collocations.word_hash(data, starts, ends), np.repeat(collocations.seeds(["en"]), len(starts)), 2)

    assert known.has(hashes(" ".join(f"w{i}" for i in range(501)))).all()
    assert known.has(hashes(" ".join(f"v{i}" for i in range(501)))).mean() < 0.1


def test_no_words(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine_collocations(empty).count() == 0
    assert collocations.mine_collocations(spark.createDataFrame([(None, None), ("en", "..."), ("en", "few words")], "lang string, text string")).count() == 0
    with pytest.raises(ValueError):
        collocations.mine_collocations(empty, most_words=1)
