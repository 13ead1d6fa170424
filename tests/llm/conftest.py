import pytest

#: Names that operators use inside or return; as extra columns of an input they must do no harm.
CLASHES = "_rid _run _id _digest _sha _row rid id key tkey h n size source_size target copies score kept marks class_id".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents, with extra columns, from (doc_id, text[, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, *(["x"] * len(CLASHES))) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"
