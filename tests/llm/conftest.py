import pytest

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source), with columns whose names clash with results."""
    full = [(*r, *("en", "src0")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
    return spark.createDataFrame(
        [(*r, 0, "mine", -1, "row") for r in full], SCHEMA + ", shard string, component_id long, row string"
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
