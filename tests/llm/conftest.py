import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark):
    """The small documents, as a list of (doc_id, text, source)."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return [(r["doc_id"], r["text"], r["source"]) for r in rows]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, schema=SCHEMA):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and long texts, repeated rows and ids."""
    long = " ".join(f"w{i % 5000}x{i}" for i in range(60_000))
    rows = [
        (1, "", "a"), (2, None, "b"), (3, long, "c"), (4, "a b c", None), (4, "a b c", None), (4, "other text of the same id", "d"),
        (None, "no id at all", "e"), (None, None, None), (5, " \t\n ", "f"), (6, "é" * 300, "g"), (7, "x  y\n\nz ", "h"),
    ]
    return make_docs(rows)
