import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def frame(spark):
    """Documents from (doc_id, text[, source]) rows."""

    def make(rows, schema=DOC_SCHEMA):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
