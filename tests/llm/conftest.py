import pytest


@pytest.fixture(scope="session")
def documents_of(spark):
    """A documents table from texts or (doc_id, text) rows, with columns whose names clash with internal ones."""

    def make(rows):
        rows = [row if isinstance(row, tuple) else (at, row) for at, row in enumerate(rows)]
        full = [(i, t, "en", "s", 0 if t is None else len(t), "x", 1, "y", 2) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, node string, component int, ranges string, row_key int"
        return spark.createDataFrame(full, schema)

    return make


def rows_of(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]
