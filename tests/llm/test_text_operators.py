"""The operators against brute force, over the smallest corpus and edge cases."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickframe.llm import fmindex, latticelm, linededup, lsm, packing, paritysketch, pii, suffixdedup, toxicity
from tickframe.llm.components import connected_components
from tickframe.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def utf8(text) -> bytes:
    return (text or "").encode()


def counted(rows) -> Counter:
    return Counter(map(tuple, rows))


# decontamination


def hits(text, windows):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", utf8(text).lower())
    hit, items = set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if (found := windows.get(tuple(words[i : i + n]))) is not None:
                hit.update(range(i, i + n))
                items |= found
    return len(words), len(hit), len(items), sha(",".join(sorted(items)).encode()), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize(("block_words", "most_hits"), [(1 << 20, 10), (400, 100_000), (400, 0)])
def test_decontaminate(spark, docs, rows, block_words, most_hits, monkeypatch):
    monkeypatch.setattr(fmindex, "BROADCAST_HITS", most_hits)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "one two three four"), (901, "lambda"), (902, None), (903, "..."), (None, "alpha"), (900, "gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"), (904, "école")]
    windows = defaultdict(set)
    for item, text in items:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", utf8(text).lower())
        if item is not None and words:
            for i in range(max(1, len(words) - 12)):
                windows[tuple(words[i : i + 13])].add(str(item))
    found = fmindex.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    assert counted(found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == counted((r[0], *hits(r[1], windows)) for r in rows)
    assert found.where("n_hit <> aggregate(spans, 0, (a, s) -> a + s.end - s.start)").count() == 0


def test_decontaminate_empty(spark, docs, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert fmindex.decontaminate(docs, bench).where("n_hit > 0").count() == 0
    assert fmindex.decontaminate(empty, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


# repeated strings


@pytest.mark.parametrize(("length", "gram"), [(200, 100), (40, 20)])
def test_remove_repeats(docs, rows, length, gram):
    texts = [utf8(r[1]) for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    want = []
    for row, t in zip(rows, texts, strict=True):
        mark = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i] += 1
                mark[i + length] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        want.append((row[0], len(t), int(gone.sum()), spans, sha(np.frombuffer(t, np.uint8)[~gone].tobytes())))
    assert counted(suffixdedup.remove_repeats(docs, length, gram).drop("spans", "kept").collect()) == counted(want)


def test_remove_repeats_shuffled_join(docs, monkeypatch):
    before = counted(suffixdedup.remove_repeats(docs).drop("spans", "kept").collect())
    monkeypatch.setattr(suffixdedup, "BROADCAST_BYTES", -1)
    assert counted(suffixdedup.remove_repeats(docs).drop("spans", "kept").collect()) == before


def test_remove_repeats_empty(empty):
    assert suffixdedup.remove_repeats(empty).count() == 0


# near duplicates


def shingles(text):
    words = utf8(text).lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return counted((r[0], len(sets[r[0]]), find(r[0])) for r in rows)


def near_rows():
    """Chains and stars of near copies at and around the similarity, in every size."""
    rng = np.random.default_rng(5)
    out, number = [], 2_000_000
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 50, 80, 130, 260, 400, 900]:
        for _ in range(3):
            words = [f"v{x}" for x in rng.integers(0, 400, size + 4)]
            for k in range(6):
                out.append((number, " ".join(words), "en", "near", 0))
                number += 1
                for _ in range(max(1, size // (40 - 6 * k))):
                    words[rng.integers(0, len(words))] = f"n{rng.integers(0, 1 << 30)}"
                if k == 3:
                    words = words[: max(5, int(len(words) * 0.77))]
    return out


@pytest.mark.parametrize("least_blocks", [None, 2])
def test_near_duplicates(spark, rows, monkeypatch, least_blocks):
    every = rows + near_rows()
    if least_blocks:  # so few blocks that sets fall short of them
        monkeypatch.setattr(paritysketch, "block_count", lambda band: least_blocks)
    frame = spark.createDataFrame(every, "doc_id long, text string, lang string, n string, rep string").repartition(5)
    assert counted(paritysketch.near_duplicates(frame).collect()) == brute_components(every)


def test_near_duplicates_with_frequent_keys_last(spark, monkeypatch):
    monkeypatch.setattr(paritysketch, "SAMPLE_EVERY", 1)
    monkeypatch.setattr(paritysketch, "OFTEN", 2)
    every = near_rows()
    assert counted(paritysketch.near_duplicates(spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long")).collect()) == brute_components(every)


def test_near_duplicates_with_hot_keys(spark, rows, monkeypatch):
    for name, value in (("SAMPLE_EVERY", 1), ("OFTEN", 2), ("HOT", 3), ("SALTS", 3), ("CENTER_ROUNDS", 2)):
        monkeypatch.setattr(paritysketch, name, value)
    every = rows + near_rows()
    frame = spark.createDataFrame(every, "doc_id long, text string, a string, b string, g string").repartition(3)
    assert counted(paritysketch.near_duplicates(frame).collect()) == brute_components(every)


def test_long_words_are_told_apart():
    """Two words that the polynomial hash cannot tell apart, whatever its base."""
    thue = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = (bytes(97 + (x ^ flip) for x in thue) for flip in (0, 1))
    column = pa.array([one.decode(), two.decode(), (one + b" x").decode()])
    sets = [s for part in paritysketch.shingle_sets(column) for s in part]
    assert sets[0][0] != sets[1][0]
    assert len(set(fmindex.word_hashes(column)[0])) == 3


@pytest.mark.parametrize("rounds", [0, 1])
def test_near_duplicates_in_large_groups(spark, monkeypatch, rounds):
    monkeypatch.setattr(paritysketch, "CENTER_ROUNDS", rounds)
    monkeypatch.setattr(paritysketch, "GROUP_BLOCK", 4)
    monkeypatch.setattr(paritysketch, "BROADCAST_IDS", 3)
    every = near_rows()
    assert counted(paritysketch.near_duplicates(spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long")).collect()) == brute_components(every)


def test_near_duplicates_empty(empty):
    assert paritysketch.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(5, 5), (None, 3), (100, 7)]
    want = {i: i // 20 * 20 for i in range(60)} | {100: 0}
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# toxicity


def test_toxicity(spark, docs, rows, empty):
    texts = [r[1] for r in rows]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scored = toxicity.score_toxicity(corpus, labels.unionByName(labels.limit(5))).select("doc_id", "held_out", "score", "predicted").toPandas()
    assert len(scored) == corpus.count() and scored.score.between(0, 1).all()
    assert (scored.predicted == (scored.score >= 0.7)).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored.doc_id]).all()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = scored[scored.held_out & scored.doc_id.isin(list(truth))]
    good, bad = (held[[truth[i] == k for i in held.doc_id]].score.to_numpy() for k in (0, 1))
    assert (bad[:, None] > good[None, :]).mean() > 0.8
    none = toxicity.score_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.count() == len(texts) and none.where("score <> 0.5 or predicted <> 0").count() == 0
    assert toxicity.score_toxicity(empty, labels).count() == 0


@pytest.mark.parametrize("fit_rows", [100, 50_000])
def test_toxicity_of_a_rare_class(spark, fit_rows):
    """A few toxic rows among thousands are all fitted on, whatever the bound; columns with the model's names stay."""
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words, 30)) + (" vile filthy scum you rotten" if i % 300 == 7 else "")) for i in range(4000)]
    frame = spark.createDataFrame([*rows, (None, "vile filthy scum you rotten"), (9000, None), (9001, "")], "doc_id long, text string").repartition(4)
    names = ["features", "probability", "prediction", "rawPrediction", "calibrated", "raw", "caps_rate", "toxic", "weight", "given"]
    for name in [*names, "score"]:
        frame = frame.withColumn(name, F.lit("mine"))
    labels = spark.createDataFrame([(i, int(i % 300 == 7)) for i, _ in rows], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(frame, labels, fit_rows=fit_rows)
    assert scored.columns == ["doc_id", *names, "held_out", "score", "predicted"]
    assert all(scored.where(f"{n} <> 'mine'").count() == 0 for n in names)
    found = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert len(found) == 4003
    toxic = [found[i] for i, _ in rows if i % 300 == 7]
    clean = [found[i] for i, _ in rows if i % 300 != 7]
    assert min(toxic) > max(clean) and min(toxic) >= 0.7 and max(clean) < 0.7 and found[None] >= 0.7


def test_toxicity_with_one_class(spark):
    frame = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "doc_id long, text string")
    ids = [i for i in range(8) if zlib.crc32(str(i).encode()) % 3 != 1]
    for toxic in (0, 1):
        labels = spark.createDataFrame([(i, toxic) for i in range(8)], "doc_id long, toxic int")
        want = (len(ids) * toxic + 1) / (len(ids) + 2)
        assert {r["score"] for r in toxicity.score_toxicity(frame, labels).collect()} == {want}


def test_toxicity_never_learns_from_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    flipped = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(corpus, x).collect()) for x in (labels, flipped))
    assert one == two


# packing


def test_packing(docs, rows, empty):
    from pathlib import Path

    from tokenizers import Tokenizer

    text = Path(vocabulary_path("word_bpe_49k.json")).read_text(encoding="utf-8")
    tokenizer = Tokenizer.from_str(text)
    want = Counter()
    for row in rows:
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            cut = ids[start : start + 2048]
            want[row[0], piece, start, len(cut), zlib.crc32(cut.tobytes())] += 1
    found = packing.pack_documents(docs, text).collect()
    assert counted(r[:5] for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in found) // 2048) + 1
    assert packing.pack_documents(empty, text).count() == 0


def test_packing_with_a_tokenizer_that_keeps_case(spark):
    from pathlib import Path

    from conftest import edge_rows
    from tokenizers import Tokenizer

    text = Path(vocabulary_path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    tokenizer, rows = Tokenizer.from_str(text), edge_rows(1)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = counted(packing.pack_documents(frame, text).select("doc_id", "piece", "ids_crc32").collect())
    want = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r[0], k, zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048)))
    assert found == want


def test_plans_have_few_slots():
    for counts in ({1000: 20_000, 900: 20_000, 500: 60_000}, {n: 10**9 + n * 7919 % 1000 for n in range(1, 2049)}):
        plan = packing.Plan(counts, 2048)
        assert len(plan.slots) < 3 * 2048
        assert plan.sequences >= -(-sum(k * n for k, n in counts.items()) // 2048)


def best_possible(sizes, capacity):
    """Fewest bins, by trying everything."""
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + sizes[i] <= capacity:
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


def test_dominance_keeps_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(150):
        capacity = 30
        sizes = sorted(rng.integers(3, 31, rng.integers(1, 10)).tolist(), reverse=True)
        plan = packing.Plan(dict(Counter(sizes)), capacity)
        used, placed = Counter(), Counter()
        totals = Counter(sizes)
        slots = sorted(plan.slots)
        for k, (length, first, sequence, per, offset) in enumerate(slots):
            last = slots[k + 1][1] if k + 1 < len(slots) and slots[k + 1][0] == length else totals[length]
            for rank in range(first, last):
                used[sequence + (rank - first) // per] += length
                placed[length] += 1
        assert placed == totals and max(used.values()) <= capacity and len(used) == plan.sequences
        only = packing.Plan.__new__(packing.Plan)
        only.capacity, only.left, only.rank, only.slots, only.sequences, only.fixed = capacity, dict(Counter(sizes)), {}, [], 0, 0
        only._reduce()
        rest = sorted(Counter(only.left).elements(), reverse=True)
        assert only.fixed + best_possible(rest, capacity) == best_possible(sizes, capacity)


# exact duplicates


@pytest.mark.parametrize("digest", [lsm.sha256, lambda text: F.substring(F.unhex(F.sha2(text, 256)), 1, 1)])
def test_exact_dedup(docs, rows, digest):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    ids, sizes = {}, Counter(norm)
    for row, t in zip(rows, norm, strict=True):
        ids[t] = min(ids.get(t, row[0]), row[0])
    want = counted((r[0], ids[t], sizes[t], r[0] == ids[t], sha(t.encode())) for r, t in zip(rows, norm, strict=True))
    assert counted(lsm.exact_dedup(docs, digest=digest).collect()) == want


def test_exact_dedup_shuffled_filter(docs, empty, monkeypatch):
    before = counted(lsm.exact_dedup(docs).collect())
    for name, value in (("BROADCAST_KEYS", 0), ("BROADCAST_BITMAPS", 0), ("BITS_A_KEY", 4096)):
        monkeypatch.setattr(lsm, name, value)
    assert counted(lsm.exact_dedup(docs).collect()) == before
    assert lsm.exact_dedup(empty).count() == 0


def test_exact_dedup_without_doc_ids(spark):
    rows = [(None, "alone"), (None, "pair"), (None, "pair"), (3, "with"), (None, "with"), (5, None), (None, ""), (7, "x"), (7, "x"), (None, None)]
    found = lsm.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    keep = {"alone": (None, 1), "pair": (None, 2), "with": (3, 2), "": (5, 3), "x": (7, 2)}
    want = counted((i, *keep[t or ""], i == keep[t or ""][0], sha(utf8(t))) for i, t in rows)
    assert counted(found.collect()) == want


def test_index_compacts_in_steps(spark):
    index = lsm.DigestIndex(spark)
    parts = [[("a", 5), ("b", 2)], [("a", 3), ("a", 9), ("c", 1)], *([(f"d{i}", i), ("c", 50 - i)] for i in range(2, 18))]
    for part in parts:
        index.flush(spark.createDataFrame(part, "digest string, doc_id long").select(F.encode("digest", "utf-8").alias("digest"), "doc_id"))
    assert [len(x) for x in index.levels] == [2, 0, 1]  # 18 runs, four merged at a time
    digests = Counter(d for part in parts for d, _ in part)
    want = counted((d.encode(), min(i for part in parts for e, i in part if e == d), n) for d, n in digests.items())
    before = counted((bytes(r[0]), *r[1:]) for r in index.table().collect())
    index.compact()
    assert before == want == counted((bytes(r[0]), *r[1:]) for r in index.table().collect())
    assert [len(x) for x in index.levels] == [0, 0, 0, 1]


def test_filter_misses_no_digest(spark):
    keys = spark.range(5000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    tested = lsm.BitmapFilter(keys.where("hex(digest) < '80'")).test(keys)
    right = F.expr("hex(digest) < '80'")
    assert tested.count() == 5000 and tested.where(right & ~F.col("maybe")).count() == 0
    assert tested.where(~right & F.col("maybe")).count() < 400
    assert lsm.BitmapFilter(keys.where("false")).test(keys).where("maybe").count() == 0


# language model


def test_lm_scores(docs, rows, empty):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [[*utf8(r[1]).lower().split(), b""] for r in rows]
    counts = Counter(t for r, ts in zip(rows, tokens, strict=True) if not held(r[0]) for t in ts)
    n, v = sum(counts.values()), len(counts)
    found = latticelm.score_documents(docs, vocabulary_path("piece_bpe_32k.model"), head_words=50).collect()
    want = Counter()
    for r, ts in zip(rows, tokens, strict=True):
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        want[r[0], held(r[0]), len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 4)] += 1
    assert Counter((*r[:5], round(r["base_score"], 4)) for r in found) == want
    pieces, prior = latticelm.read_pieces(vocabulary_path("piece_bpe_32k.model"))
    weights, spelled = dict(zip(pieces, np.exp(prior), strict=True)), math.log((v + 0.5) / (n + v + 1))
    longest = max(map(len, pieces))

    @functools.cache
    def log_p(word):
        text = latticelm.MARK + word
        paths = [(1.0, 0)]  # mantissa and exponent, as long words underflow
        for end in range(1, len(text) + 1):
            found = [(paths[at], weights.get(text[at:end], 0)) for at in range(max(0, end - longest), end)]
            top = max(e for (_, e), w in found if w)
            mantissa, shift = math.frexp(sum(math.ldexp(m * w, e - top) for (m, e), w in found if w))
            paths.append((mantissa, shift + top))
        m, e = paths[-1]
        return np.logaddexp(spelled + math.log(m) + e * math.log(2), math.log(counts[word] / (n + v + 1)) if counts[word] else -math.inf)

    end = math.log((counts[b""] + 0.5) / (n + v + 1))
    scores = Counter()
    for r, ts in zip(rows, tokens, strict=True):
        scores[r[0], round((sum(map(log_p, ts[:-1])) + end) / math.log(10), 4)] += 1
    assert Counter((r["doc_id"], round(r["score"], 4)) for r in found) == scores
    other = {r["doc_id"]: r["score"] for r in latticelm.score_documents(docs, vocabulary_path("piece_bpe_32k.model")).collect()}
    assert all(math.isclose(r["score"], other[r["doc_id"]], rel_tol=1e-9) for r in found)
    assert latticelm.score_documents(empty, vocabulary_path("piece_bpe_32k.model")).count() == 0


def test_lattice_sums_all_segmentations():
    texts = [latticelm.MARK, b"a", b"b", b"ab", b"aba", latticelm.MARK + b"a", *(bytes([x]) for x in latticelm.MARK)]
    weights = np.log(np.linspace(0.05, 0.2, len(texts)))
    pieces = latticelm.Pieces(texts)

    def total(word):
        if not word:
            return 1.0
        return sum(math.exp(w) * total(word[len(t) :]) for t, w in zip(texts, weights, strict=True) if word.startswith(t))

    words = [b"a", b"abab", b"bbaba", b"", b"abaabaab" * 3, b"ab" * 500, b"abaab" * 300]
    for window in (1 << 18, 64, 5):
        found = latticelm.marginals(words, pieces, weights, window)
        assert np.allclose(np.exp(found[:5]), [total(latticelm.MARK + w) for w in words[:5]])
        assert np.allclose(found, latticelm.marginals(words, pieces, weights))


# lines


def brute_lines(rows, min_docs):
    strip = b" \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for r in rows:
        for key in {x.strip(strip).lower() for x in utf8(r[1]).split(b"\n")}:
            if len(key.decode()) >= 40 and r[0] is not None:
                holders[key].add(r[0])
    dropped = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    want = []
    for r in rows:
        lines = utf8(r[1]).split(b"\n")
        kept = [x for x in lines if r[0] is None or dropped.get(x.strip(strip).lower(), r[0]) == r[0]]
        want.append((r[0], len(lines), len(lines) - len(kept), sha(b"\n".join(kept))))
    return counted(want)


def line_rows(found):
    return counted(found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect())


@pytest.mark.parametrize("way", ["broadcast", "small filter", "folded filter", "joined"])
def test_line_dedup(docs, rows, empty, way, monkeypatch):
    if way == "folded filter":
        monkeypatch.setattr(linededup, "BROADCAST_BITS", linededup.SEGMENT_BITS)
    if way == "joined":
        monkeypatch.setattr(linededup, "BROADCAST_BYTES", -1)
    want = brute_lines(rows, 3)
    found = linededup.dedup_lines(docs, min_docs=3, bits=1 << 22 if way == "folded filter" else 1 << 20 if way == "small filter" else None)
    assert line_rows(found) == want
    assert found.where("drop <> 'clash'").count() == 0 and any(w[2] for w in want)
    assert linededup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("most", [None, -1])
def test_line_dedup_without_repeats_and_of_repeated_documents(spark, monkeypatch, most):
    """Tasks without a repeat, of one row or of none; a doc_id counts once however many rows it has; null counts never."""
    if most:
        monkeypatch.setattr(linededup, "BROADCAST_BYTES", most)
    schema = "doc_id long, text string"
    plain = [(i, f"a line of {i} that is long enough to count, and differs\nshort") for i in range(6)]
    assert line_rows(linededup.dedup_lines(spark.createDataFrame(plain, schema).repartition(12), min_docs=3)) == brute_lines(plain, 3)
    common = "this very line is long enough and stands in many documents"
    one_short = [(1, common), (1, common), (2, common), (3, common), (4, common), (None, common), (None, common)]
    for rows in (one_short, [*one_short, (5, common + "\nmore"), (5, common)]):
        found = linededup.dedup_lines(spark.createDataFrame(rows, schema).repartition(3))
        assert line_rows(found) == brute_lines(rows, 5)


# personal data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_spans(text):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    counts, spans = [], []
    for kind, pattern in kinds.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {"email": lambda: True, "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d), "phone": lambda d=digits: 9 <= len(d) <= 15}
            if fits[kind]():
                found.append(f"{kind}:{m.start()}:{m.end()}")
        counts.append(len(found))
        spans += found
    return (*counts, sha(",".join(spans).encode())), ",".join(spans)


def test_personal_data(docs, rows, empty):
    want = {r[0]: brute_spans(r[1]) for r in rows}
    found = pii.find_personal_data(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    for r in found:
        assert r[1:6] == want[r["doc_id"]][0] and r["spans"].startswith(want[r["doc_id"]][1])
    assert pii.find_personal_data(empty).count() == 0


def test_disclosing_terms(spark):
    filler = "common words stand here in every one of these texts"
    rows = [(i, f"note {i} by Zaphodine of dept{i % 3}{'xyz'[i % 3]}: write to boss@corp.example, thanks. {filler}") for i in range(6)]
    rows += [(10 + i, f"number {i} says only this. {filler}") for i in range(30)] + [(50, "Once more ZAPHODINE, with no address."), (51, None), (52, "")]
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    marked = {i: [(s["kind"], rows_text[s["start"] : s["end"]].lower()) for s in found[i]["span_list"] if s["kind"] in ("generalise", "remove")] for i, rows_text in rows if rows_text}
    assert all(any(w == "zaphodine" for _, w in marked[i]) for i in (*range(6), 50))
    assert not any(marked[i] for i in range(10, 40))
    assert not any(w in ("common", "words", "corp", "boss") for spans in marked.values() for _, w in spans)
    assert found[0]["n_email"] == 1 and found[51]["spans"] == ""


def test_terms_disclose_values_that_occur_once(spark):
    """Values of one kind, and of one mail host, are pooled; one context, and copies of it, give nothing away."""
    mails = [(i, f"note {i} from Zaphodine to a{i}@host{i}.example on day {i * i}, once only {chr(97 + i) * 5}") for i in range(5)]
    hosts = [(20 + i, f"item {i} of Trillianne with b{i}@{'corp' if i < 4 else f'other{i}'}.example in week {i * 7}") for i in range(14)]
    hosts = [(i, t if "@corp" in t else t.replace("Trillianne", "Marvinus" + "abcdefghijklmn"[i - 20])) for i, t in hosts]
    copies = [(50 + i, "the same text of Slartibart has c@copy.example each time") for i in range(4)]
    plain = [(100 + i, f"number {i} says nothing of anyone at all") for i in range(60)]
    plain += [(200, "Once more ZAPHODINE, with no address."), (201, "and Trillianne, and Slartibart as well")]
    rows = [*mails, *hosts, *copies, *plain]
    found = {r["doc_id"]: r["span_list"] for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    marked = {i: {text[s["start"] : s["end"]].lower() for s in found[i] if s["kind"] in ("generalise", "remove")} for i, text in rows}
    assert all("zaphodine" in marked[i] for i in (*range(5), 200))
    assert all("trillianne" in marked[i] for i in (*range(20, 24), 201))
    assert not any(w.startswith(("slartibart", "marvinus")) or len(set(w)) == 1 for words in marked.values() for w in words)
    assert not any(marked[100 + i] for i in range(60))
