import pytest

from cohortloom.llm.common import ship

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, source), with columns that clash with inner names."""
    ship(spark)

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 1, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, f"{DOCUMENTS}, node long, key string, digest string, hash string")

    return make
