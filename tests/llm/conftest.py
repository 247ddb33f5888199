import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def long_text() -> str:
    words = [f"w{i * i % 997}x{i % 13}" for i in range(60_000)]
    return " ".join(words)


def edge_rows(first: int) -> list[tuple]:
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    texts = [
        None, "", " \t\n\r\x0b\x0c ", "one", "one two three four", "One TWO three four", base, base + " ", base.upper(), base + " phi", base.replace(" ", "\n"),
        "x" * 5000, ("ab" * 300) + "\n" + ("ab" * 300), "École ÉCOLE école İstanbul straße ΑΣ ǅ", "emoji 😀 text 😀 text", "a\x00b nul", "\n\n\n", "line " * 12 + "\n" + "line " * 12, "<|endoftext|> <|ENDOFTEXT|>x don't 'S 12,000.50",
        "mail a.b+c@ex-am.ple.org and _d@e.f, 1.2.3.4.5.6.7.8, 300.1.1.1, 4111 1111 1111 1111, 4111-1111-1111-1112, +49 (30) 1234-5678.", "a@b.c_d@e.f 007.08.1.255 x1.1.1.1y",
        long_text(),
    ]
    rows = [(first + i, t, "en", "edge", 0) for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[0]]  # repeated rows


@pytest.fixture(scope="session")
def rows():
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return [tuple(r.values()) for r in table] + edge_rows(1_000_000)


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The smallest corpus and hand-built edge cases, with columns whose names clash with the operators' own."""
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "n", "rank", "end", "digest", "copies", "n_lines", "kept_text", "spans", "score", "drop"):
        frame = frame.withColumn(name, F.lit("clash"))
    frame.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
