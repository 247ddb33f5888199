"""The pipeline against brute force, stage by stage, and edge cases of all operators."""

from collections import Counter, defaultdict
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF, edge_rows
from test_text_operators import brute_components, counted, hits, brute_lines, utf8
from tickframe.llm.queries import QUERIES

corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def phrases(spark):
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", utf8(r["text"]).lower())
        for i in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[i : i + 13])].add(str(r["item_id"]))
    return windows


def test_stages_against_brute_force(spark, tmp_path):
    assert list(STAGES) == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        tables[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or docs.columns == columns
    every = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    toxic = {r["doc_id"] for r in QUERIES["op4_toxicity"](spark, SF).where("predicted = 1").collect()}
    kept = {r["doc_id"]: r["text"] for r in tables["toxicity"].collect()}
    assert kept == {i: t for i, t in every.items() if i not in toxic} and len(kept) > len(every) // 2
    lines = tables["line_dedup"].withColumns({"kept_text": F.coalesce("text", F.lit(""))})
    want = brute_lines(list(kept.items()), 5)
    assert Counter((r[0], r[3]) for r in want.elements()) == Counter(map(tuple, lines.select("doc_id", F.sha2("kept_text", 256)).collect()))
    assert tables["line_dedup"].where("n_chars <> length(coalesce(text, ''))").count() == 0
    rows = [(r["doc_id"], r["text"]) for r in tables["line_dedup"].collect()]
    firsts = {i for i, _, component in brute_components(rows) if i == component}
    left = {r["doc_id"]: r["text"] for r in tables["near_duplicates"].collect()}
    assert left == {i: t for i, t in rows if i in firsts} and len(left) < len(rows)
    windows = phrases(spark)
    clean = {r["doc_id"] for r in tables["decontamination"].collect()}
    assert clean == {i for i, t in left.items() if not hits(t, windows)[-1]}
    pieces = tables["packing"].collect()
    assert {r["doc_id"] for r in pieces} == clean
    used = Counter()
    for r in pieces:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 1
    packed = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert counted(packed.select(key).collect()) == counted(tables["packing"].select(key).collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_odd_tables(spark, name):
    """Null ids and texts, repeated rows, columns with clashing names, and a table without rows."""
    rows = [*edge_rows(10), (None, "no id", "en", None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("features", F.lit("mine")).withColumn("piece", F.lit("mine"))
    out = STAGES[name](spark, docs, SF)
    last = name == "packing"
    assert last or out.columns == corpus_pipeline.COLUMNS
    ids = Counter(r[0] for r in rows)
    found = Counter(r["doc_id"] for r in (out.where("piece = 0") if last else out).collect())
    assert not found - ids and (name in ("near_duplicates", "decontamination") or found == ids) and found[None] == 2
    assert STAGES[name](spark, docs.where("false"), SF).count() == 0


def test_operators_keep_rows_without_ids(spark, tmp_path):
    """Every query gives each row its row, also those without an id, and the texts of such rows count."""
    rows = [*edge_rows(10), (None, "no id", "en", None, None), (None, "no id", "en", None, None), (None, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    ids = Counter(r[0] for r in rows)
    for name, query in QUERIES.items():
        if name in ("op9_url_filter", "op11_whitening", "op13_collocations"):  # other tables, or rows of their own
            continue
        out = query(spark, str(tmp_path))
        found = out.where("piece = 0") if name == "op5_pack" else out
        assert Counter(r["doc_id"] for r in found.select("doc_id").collect()) == ids, name
    dedup = QUERIES["op6_exact_dedup"](spark, str(tmp_path)).where("doc_id is null").collect()
    assert sorted((r["keep_id"] or -1, r["group_size"], r["kept"]) for r in dedup) == [(-1, 2, True), (-1, 2, True), (10, 4, False)]
