"""The corpus operators applied to the tables with production parameters, and DuckDB SQL where it can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.bytebpe import decode_documents, encode_documents
from tickframe.llm.collocations import mine_collocations
from tickframe.llm.fmindex import decontaminate
from tickframe.llm.latticelm import score_documents
from tickframe.llm.linededup import dedup_lines
from tickframe.llm.lsm import exact_dedup
from tickframe.llm.packing import pack_documents
from tickframe.llm.paritysketch import near_duplicates
from tickframe.llm.pii import find_personal_data
from tickframe.llm.suffixdedup import remove_repeats
from tickframe.llm.textbatch import lean
from tickframe.llm.toxicity import score_toxicity
from tickframe.llm.urlfilter import apply_rules
from tickframe.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

#: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans", "kept")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Path(vocabulary_path("word_bpe_49k.json")).read_text(encoding="utf-8")
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(str(rule) for rule in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")
    return apply_rules(table(spark, sf_dir, "pages"), rules)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents")).drop("span_list")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: SHA-256 of each row's ids as decimals joined by spaces, in slices, as a text may have millions."""
    for batch in batches:
        digests = []
        for row in batch.column("ids"):
            ids, digest = row.values.to_numpy(), hashlib.sha256()
            for i in range(0, len(ids), 1 << 16):
                digest.update((" " if i else "").encode() + " ".join(map(str, ids[i : i + (1 << 16)].tolist())).encode())
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(r.values) for r in batch.column("ids")], pa.int64()), pa.array(digests, pa.string()), batch.column("decoded_sha256")], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary_path("byte_bpe_50k.tiktoken")
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    digested = decoded.select("doc_id", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
    return digested.mapInArrow(lean(id_digests), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
     q AS (SELECT DISTINCT item, n, p FROM (SELECT item, least(len(w), 13) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS p FROM b WHERE len(w) > 0)),
     o AS (SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS p, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n),
     h AS (SELECT r, i, n, item FROM o JOIN q USING (n, p)),
     k AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
     t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN k USING (r) LEFT JOIN t USING (r)
"""

OP2_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents),
     w AS (SELECT r, unnest(range(1, octet_length(b) - 198)) AS i, unnest(list_transform(range(1, octet_length(b) - 198), lambda i: md5(b[i:i + 199]))) AS h FROM d WHERE octet_length(b) >= 200),
     g AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
     s AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step FROM w SEMI JOIN g USING (h)),
     n AS (SELECT r, sum(least(coalesce(step, 200), 200)) AS n_removed, count(*) FILTER (step IS NULL OR step > 200) AS n_spans FROM s GROUP BY r),
     u AS (SELECT r, i, sum(CASE WHEN step IS NULL OR step > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM s),
     x AS (SELECT r, k, min(i) AS lo, max(i) + 200 AS hi FROM u GROUP BY r, k),
     y AS (SELECT r, k, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY k), 1) AS a, lo AS e FROM x UNION ALL SELECT r, max(k) + 1, max(hi), NULL FROM x GROUP BY r),
     z AS (SELECT r, string_agg(hex(b[a:coalesce(e, octet_length(b) + 1) - 1]), '' ORDER BY k) AS kept FROM y JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN kept IS NULL THEN b ELSE unhex(kept) END) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN z USING (r)
"""

OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) > 0),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
     e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
     r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
     m AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON node = d.doc_id
"""

OP6_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

OP8_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
     k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     g AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
     m AS (SELECT k.*, g.last IS NOT NULL AND k.doc_id <> g.last AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP9_SQL = r"""
WITH p AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     q AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
     r(h, pre, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
     m AS (SELECT q.*, h || pre AS rule, verdict, row_number() OVER (PARTITION BY page_id, url ORDER BY length(h || pre) DESC NULLS LAST) AS k
           FROM q LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre))
SELECT page_id, url, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k) GROUP BY ALL),
     n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
     c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
     u AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y FROM c, (VALUES (1), (2)) t(j) WHERE j < k),
     s AS (SELECT u.lang, u.phrase, a, x.f AS l, y.f AS r, j, CAST(a AS HUGEINT) * a * 1000000 // (CAST(x.f AS HUGEINT) * y.f) AS score FROM u JOIN f x ON x.lang = u.lang AND x.phrase = u.x JOIN f y ON y.lang = u.lang AND y.phrase = u.y),
     b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
     o AS (SELECT lang, array_to_string(w[j:j + 1], ' ') AS phrase, max(a) AS longest FROM c, (VALUES (1), (2)) t(j) WHERE k = 3 GROUP BY ALL),
     k AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 50 * a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM k JOIN n USING (lang) QUALIFY rank <= 2000
"""

QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_toxicity": op4_toxicity,
    "op5_pack": op5_pack,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = {
    "op1_decontaminate": OP1_SQL, "op2_suffix_dedup": OP2_SQL, "op3_ngram_jaccard": OP3_SQL,
    "op6_exact_dedup": OP6_SQL, "op8_line_dedup": OP8_SQL, "op9_url_filter": OP9_SQL,
    "op13_collocations": OP13_SQL,
}
