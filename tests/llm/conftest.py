import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session", autouse=True)
def worker_path():
    """Workers import the operators from the repository."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ["PYTHONPATH"] = top + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture()
def documents(spark):
    """Documents frame from (doc_id, text) pairs, with extra columns whose names clash with the operators' own."""

    def make(rows):
        rows = [(i, t, "en", "src0" if i is None else f"src{i % 3}", len(t or ""), "x", 1.0, 7) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, c string, score double, size int")

    return make
