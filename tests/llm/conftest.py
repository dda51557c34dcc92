import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""
    def build(rows, schema=DOCS):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, schema)
    return build


@pytest.fixture
def clashing(documents):
    """The same with more columns, whose names the operators use themselves."""
    def build(rows):
        from pyspark.sql import functions as F

        extra = ("digest", "kept", "row", "hash", "position", "cut", "batch", "n", "set_id",
                 "n_tokens", "group", "score", "text_id", "key", "n_lines", "keeper", "part")
        return documents(rows).select("*", *(F.lit(1).alias(c) for c in extra))
    return build
