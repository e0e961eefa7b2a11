import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with an extra clashing column."""
    from tillweave.llm import frames

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        frames.ready(spark)
        return frames.store(spark.createDataFrame(full, DOCUMENTS).selectExpr("*", "1 AS score", "'x' AS tokens", "0 AS at"), "test")

    return make
