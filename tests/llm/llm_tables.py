import pytest

# columns whose names the operators also use, to see that nothing clashes
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, _id long, _text string, "
          "_digest string, node long, component_id long")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with other columns of clashing names."""
    def build(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 1, 0.5, True, 7, "other", "d", 3, 9) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build


EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "word"), (4, "word"), (None, "word"), (5, "ä" * 50_000), (6, "x y " * 30_000)]


@pytest.fixture
def edge():
    """Nulls, blanks, repeated rows, a missing id and very long texts."""
    return list(EDGE)
