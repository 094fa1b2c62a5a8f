from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf(spark):
    yield SF
    from tallywright.llm.common import release

    release(spark)


@pytest.fixture(scope="session")
def texts(spark):
    """{doc_id: text} of the small documents table."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture
def frame(spark):
    """A frame of documents with columns whose names the operators use themselves."""

    def make(rows, extra: bool = True):
        kind = "doc_id long, text string" + (", n long, kept boolean, ids string, quality string, repeats string, private string" if extra else "")
        filler = (7, False, "x", "x", "x", "x") if extra else ()
        return spark.createDataFrame([(i, t, *filler) for i, t in rows], kind)

    return make
