"""Very long texts are worked on in stretches, and large corpora by filters that move no text."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from test_text_operators import brute_lines, counted, line_rows
from tickframe.llm import linededup, suffixdedup, textbatch, toxicity


def test_word_hashes_in_blocks(monkeypatch):
    draw = random.Random(2)
    text = b" ".join(bytes(draw.choice(b"abcXYZ\xc3\xa9") for _ in range(draw.choice([1, 3, 7, 500, 600, 5000]))) for _ in range(300))
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = textbatch.word_spans(data, np.array([0, len(data)]), textbatch.NOT_SPACE)
    for fold in (True, False):
        want = textbatch.word_hash(data, starts, ends, fold)
        for size in (1, 64, 4096):
            monkeypatch.setattr(textbatch, "SLICE_BYTES", size)
            assert (textbatch.word_hash(data, starts, ends, fold) == want).all()
        monkeypatch.undo()
    assert len(textbatch.word_hash(data, starts[:0], ends[:0])) == 0


@pytest.mark.parametrize("most", [400, 1000, 1 << 20])
def test_samples_in_parts(most):
    """The sampled suffixes of a long row do not depend on where it is cut."""
    draw = random.Random(4)
    text = np.frombuffer(bytes(draw.choice(b"ab") for _ in range(4000)) + b"x" * 3000 + bytes(draw.choice(b"abcdefgh") for _ in range(9000)), np.uint8)
    whole = suffixdedup.sample(text, np.array([0, len(text)]), 60, 30)
    parts = [np.concatenate(x) for x in zip(*suffixdedup.sampled_parts(text, np.array([0, len(text)]), 60, 30, most))]
    rows = lambda columns: sorted(zip(*(c.tolist() for c in columns)))
    assert rows(whole) == rows(parts) and len(whole[0]) > 100


def test_remove_repeats_in_stretches(docs, monkeypatch):
    before = counted(suffixdedup.remove_repeats(docs).drop("spans", "kept").collect())
    monkeypatch.setattr(suffixdedup, "SLICE_BYTES", 3000)
    monkeypatch.setattr(suffixdedup, "REGION_BYTES", 1 << 16)
    assert counted(suffixdedup.remove_repeats(docs).drop("spans", "kept").collect()) == before


def test_rows_are_told_apart_by_id_and_text(spark):
    """Equal texts under other ids, and an id with other texts, keep results of their own."""
    draw = random.Random(8)
    body = "".join(draw.choice("abcdefgh ") for _ in range(300))
    rows = [(1, body), (2, body + "x"), (1, body + "y"), (None, body), (None, "short"), (1, body)]
    found = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in found) == [(0, 5, 0), (0, 300, 300), (1, 300, 300), (1, 300, 300), (1, 301, 300), (2, 301, 300)]


def test_no_text_moves_for_a_large_filter(spark, monkeypatch):
    """A filter of many segments, folded into one: the pass that finds suspects has no exchange, and results are whole."""
    plans = []
    kept = linededup.materialize

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return kept(df, name)

    monkeypatch.setattr(linededup, "materialize", watched)
    monkeypatch.setattr(linededup, "BROADCAST_BITS", linededup.SEGMENT_BITS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = linededup.dedup_lines(docs, bits=1 << 24)
    suspects = next(p for name, p in plans if name == "suspects")
    assert "Exchange" not in suspects and "Join" not in suspects and suspects.count("MapInArrow") == 1
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert line_rows(found) == brute_lines([tuple(r) for r in docs.collect()], 5)


def test_folded_filters_hold_all_that_whole_ones_do(spark):
    lines = [f"line number {i} that is long enough to be counted as one" for i in range(400)]
    rows = spark.createDataFrame([(d, "\n".join(lines[d : d + 200])) for d in (0, 100, 200)], "doc_id long, text string").repartition(3)
    bits = 8 * linededup.SEGMENT_BITS
    filters = linededup.merged_filters(rows, bits, 40)
    hashes = np.array([linededup.xxhash.xxh3_64_intdigest(x.encode()) for x in lines[100:300]], np.uint64)
    for most in (bits, 2 * linededup.SEGMENT_BITS, linededup.SEGMENT_BITS):
        held = np.frombuffer(linededup.collected(filters, bits, most), np.uint8)
        assert len(held) == most // 8 and linededup.held_at(held, linededup.positions(hashes, most)).all()
        others = np.array([linededup.xxhash.xxh3_64_intdigest(str(i).encode()) for i in range(2000)], np.uint64)
        assert linededup.held_at(held, linededup.positions(others, most)).mean() < 0.01


# toxicity's features and lexicon


def test_toxic_features_by_hand():
    lexicon = {"idiot": 3.0, "trash": 2.5}
    names = toxicity.FEATURES
    row = dict(zip(names, toxicity.features("You are an IDIOT, pure trash! 1d10t tr@sh... Your fault", lexicon)))
    # Words: You are an IDIOT pure trash 1d10t tr sh Your fault.
    assert row["lexicon_hits"] == 2 and row["lexicon_distinct"] == 2 and row["lexicon_weight"] == 5.5 and row["lexicon_rate"] == 2 / 11
    assert row["second_person_rate"] == 2 / 11 and row["near_second_person"] == 2 / 11
    assert row["shout_rate"] == 1 / 11 and row["obfuscated_hits"] == 2 and row["log_words"] == pytest.approx(np.log1p(11))
    text = "You are an IDIOT, pure trash! 1d10t tr@sh... Your fault"
    letters, marks = sum(c.isalpha() for c in text), sum(not c.isalnum() and c != " " for c in text)
    assert row["caps_rate"] == sum(c.isupper() for c in text) / letters and row["punctuation_rate"] == marks / len(text) and row["exclaim_rate"] == 1 / len(text)
    assert not any(toxicity.features("", lexicon)) and not any(toxicity.features(" \n", lexicon)[:4])
    far = "you " + "word " * 8 + "idiot"
    assert dict(zip(names, toxicity.features(far, lexicon)))["near_second_person"] == 0


def test_letters_end_where_they_are_said_to():
    assert not any(c.isalnum() or c.isspace() or c != c.lower() for c in map(chr, range(toxicity.MOST_LETTERS, 0x110000)))


def brute_features(text, lexicon):
    """The same features, word by word."""
    words = re.findall(r"[^\W_]+", text)
    low = [toxicity.fold(w) for w in words]
    n = max(1, len(words))
    at, you = ([i for i, w in enumerate(low) if w in kind] for kind in (lexicon, toxicity.SECOND_PERSON))
    near = sum(any(abs(i - j) <= 5 for j in you) for i in at)
    hidden = 0
    for raw in text.split():
        plain = re.sub(r"[^\w]", "", toxicity.fold(raw.strip(".,;:!?\"'()")).translate(toxicity.LOOKALIKES))
        hidden += plain in lexicon and plain != toxicity.fold(raw.strip(".,;:!?\"'()#*%&$"))
    found, raw, n_bytes = {low[i] for i in at}, text.encode(), max(1, len(text.encode()))
    n_letters = max(1, sum(b >= 0x80 or chr(b).isalpha() for b in raw))
    return [
        len(at) / n, len(at), len(found), sum(lexicon[w] for w in found), len(you) / n, near / n,
        sum(65 <= b <= 90 for b in raw) / n_letters, sum(len(w) > 2 and w.isupper() for w in words) / n,
        sum(0x20 < b < 0x7F and not chr(b).isalnum() for b in raw) / n_bytes, raw.count(b"!") / n_bytes, hidden / n, hidden, np.log1p(len(words)),
    ]


@pytest.mark.parametrize("stretch", [3, 1 << 19])
def test_toxic_features_against_brute_force(rows, monkeypatch, stretch):
    monkeypatch.setattr(toxicity, "SLICE_BYTES", stretch)
    draw, texts = random.Random(5), [r[1] or "" for r in rows if stretch > 3 or len(r[1] or "") < 3000]
    words = sorted({w for t in texts for w in toxicity.WORD.findall(toxicity.fold(t))})
    lexicon = {w: draw.uniform(2.5, 6) for w in draw.sample(words, 300) + ["idiot", "stoss", "you", "z" * 700]}
    odd = ["1d10t", "(tr@sh)", "\u0130d\u0130OT", "\u0130D\u0130OT!", "IDIOT", "id_iot", "i-d-i-o-t", "$toss#", "st0$$!", "YOU", "u", "\u01c5AB", "ABC\u01c4", "z" * 700, "Z" * 699, "\u00c9COLE", "...", "\u3000", "\u0391\u03a3", "\U0001f600", "\n", "word,", "1d10t." + "_" * 600, "z-" * 700]
    texts += [draw.choice(["", " "]).join(draw.choice(odd) + draw.choice([" ", "", "\u00a0"]) for _ in range(draw.randrange(40))) for _ in range(200)]
    column = pa.array([None, *texts, ""])
    data, offsets = textbatch.to_bytes_array(column)
    got = np.concatenate([toxicity.feature_rows(chunk, at, toxicity.Lexicon(lexicon)) for _, _, chunk, at in textbatch.slices(data, offsets)])
    np.testing.assert_allclose(got, [brute_features(t, lexicon) for t in column.fill_null("").to_pylist()], rtol=1e-12)
    assert (got[:, toxicity.FEATURES.index("obfuscated_hits")] > 0).sum() > 20
    assert not toxicity.feature_rows(data, offsets, toxicity.Lexicon({}))[:, :4].any()


def test_lexicon_and_sample_against_brute_force(spark):
    import math
    from collections import Counter

    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [(r["doc_id"], r["text"], labels[r["doc_id"]]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if labels.get(r["doc_id"]) is not None]
    rows += [(10_000 + i, f"common vile{i % 3} plain", i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    counts = Counter(r[2] for r in rows)
    pos, neg = Counter(), Counter()
    for _, text, toxic in rows:
        (pos if toxic else neg).update({w.lower() for w in toxicity.WORD.findall(text or "")})
    least = max(min(5, counts[1]), counts[1] // 200)
    odds = {w: math.log((c + 0.5) / (counts[1] + 1)) - math.log((neg[w] + 0.5) / (counts[0] + 1)) for w, c in pos.items() if c >= least}
    want = {w: o for w, o in odds.items() if o > 2.5}
    found = toxicity.learn_lexicon(frame, dict(counts))
    assert found.keys() == want.keys() and all(abs(found[w] - want[w]) < 1e-9 for w in want)
    sample = toxicity.fitting_sample(frame, dict(counts), 40).groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()
    for r in sample:
        assert r["n"] <= 45 and 0.4 < r["w"] / counts[r["toxic"]] < 1.8
    whole = toxicity.fitting_sample(frame, dict(counts), 10_000)
    assert whole.count() == len(rows) and whole.where("weight <> 1").count() == 0
