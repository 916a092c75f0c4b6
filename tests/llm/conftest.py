import duckdb
import pytest

from siteledger.llm.common import prepare

LLM_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
# Columns whose names the operators use for themselves.
CLASHES = ("key", "digest", "row", "th", "id", "h", "spans", "score", "kept", "block", "rest", "own", "size", "doc")


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture
def duck():
    def connect(sf_dir):
        con = duckdb.connect()
        for name in LLM_TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        return con
    return connect


@pytest.fixture
def documents(spark):
    """Frame of (doc_id, text) with the columns of documents and others of clashing names."""
    def make(*rows):
        data = [(i, t, "en", None, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t in rows]
        return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                     + ", ".join(f"`{c}` string" for c in CLASHES))
    return make


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i}" for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(80))
    return documents((1, None), (2, ""), (3, "  \n\t "), (None, "null id here it is"), (None, None), (4, "one"),
                     (5, "Ä ß 漢 ▁ \x00 end"), (6, long), (7, long + " tail"), (8, "same text of five words"),
                     (8, "same text of five words"), (9, "same  text of five words"), (10, "a " * 400),
                     (11, "x y z " + passage + " u v w"), (12, passage + " other end of it"), (13, "B" * 5000))
