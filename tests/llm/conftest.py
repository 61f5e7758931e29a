import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents-like rows from texts; ids ascend unless given."""
    def make(texts, ids=None, **cols):
        ids = list(range(len(texts))) if ids is None else ids
        names = ["doc_id", "text", *cols]
        rows = [tuple(r) for r in zip(ids, texts, *cols.values())]
        schema = "doc_id bigint, text string" + "".join(f", {c} string" for c in cols)
        return spark.createDataFrame(rows, schema).repartition(3) if rows else spark.createDataFrame([], schema)
    return make
