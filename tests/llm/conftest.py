import os

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, note string, __own string"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = HERE


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with extra columns."""

    def build(rows):
        rows = [(*r, "a")[:3] for r in rows]
        return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows], DOCS)

    return build
