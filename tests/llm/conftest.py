import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, schema=DOCUMENTS):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def stored(spark):
    def read(name, folder="/root/testdata/sf0.001"):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return read
