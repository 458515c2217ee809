import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text[, lang, source]) rows, with further columns whose names clash."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, keep_id string, size string, h int, n int, "
        "kept string, shard int, spans int, low string, bands int, _text int")

    def make(rows, parts=3):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), "x", "y", 1, 2, "z", 3, 4, "w", 5, 6) for r in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make
