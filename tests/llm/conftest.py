import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a documents table of (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] + (None, None))[:2], len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)
