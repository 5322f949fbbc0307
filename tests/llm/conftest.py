import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, over several partitions."""

    def build(*rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        return spark.createDataFrame(full, schema).repartition(parts)

    return build
