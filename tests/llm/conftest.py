import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table of texts; ids count from 0 unless given."""
    def make(texts, ids=None, source="s", extra=False):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in zip(ids, texts)]
        df = spark.createDataFrame(rows, COLUMNS)
        if extra:  # names that operators use inside
            for c in ("id", "node", "token", "size", "_id", "_row", "queue", "n", "key", "kept"):
                df = df.withColumn(c, df.doc_id)
        return df
    return make
