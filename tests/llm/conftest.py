import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table with columns whose names the operators use themselves."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOC_SCHEMA)
        if extra:
            for name in ("key", "node", "shingle", "items", "place", "_text", "kept", "bin", "item", "n_words", "score"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make
