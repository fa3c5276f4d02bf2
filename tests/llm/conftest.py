import pytest

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.fixture
def tables(spark, tmp_path):
    """Write tables and return their folder; those not given are empty."""

    def write(extra: str = "", **rows):
        for name, schema in SCHEMAS.items():
            given = [tuple(r) for r in rows.get(name, [])]
            if extra:
                schema += f", {extra} string"
                given = [(*r, "x") for r in given]
            spark.createDataFrame(given, schema).coalesce(2).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def documents(tables):
    """A folder whose `documents` have these texts, with ids from 0."""

    def write(*texts, sources=None, ids=None, extra=""):
        rows = [
            (i if ids is None else ids[i], t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)
        ]
        return tables(documents=rows, extra=extra)

    return write
