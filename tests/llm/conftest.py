import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NASTY = [(900, None), (901, ""), (902, " \t\n"), (903, "a"), (903, "a"), (903, "b c"), (None, "no id"), (None, None), (904, "émile ñandú 日本 " * 40), (905, "long " * 30_000)]


@pytest.fixture
def docs(spark):
    """Documents of the contract's columns from (doc_id, text) or (doc_id, text, source)."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def nasty():
    """NULLs, empty and very long texts, ties and repeated rows."""
    return list(NASTY)


@pytest.fixture
def folder(docs, tmp_path):
    """Write documents where a query reads them."""
    def write(rows):
        docs(rows).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write
