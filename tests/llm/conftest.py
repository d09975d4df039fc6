import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) rows."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], *(list(r[2:]) + [None, None])[:2], len(r[1] or "")) for r in rows], DOCS)

    return make


EDGE_TEXTS = [None, "", " ", "\n\t ", "one", "a b c", "Straße über élan", "x" * 3000, "word " * 4000,
              "  led  by   spaces \n \n", "中文 字 😀 <|endoftext|>", "tab\tsep\x0bvt \x1c odd\x00nul"]


@pytest.fixture(scope="session")
def edge_docs(docs_of):
    """Edge texts, each twice, with ties in doc_id, null ids and null columns."""
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(100 + i, t) for i, t in enumerate(EDGE_TEXTS)]
    return docs_of(rows + [(3, "\n\t "), (None, "no id here"), (None, None)])


@pytest.fixture(scope="session")
def empty_docs(docs_of, spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def with_clashes():
    """Adds columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def add(df, *names):
        return df.select("*", *[F.lit("clash").alias(n) for n in names if n not in df.columns])

    return add
