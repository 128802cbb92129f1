import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from gridloom.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = ship(local_session(4, shuffle_partitions=4, app="tests"))
    session.sparkContext.setLogLevel("ERROR")
    yield session


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def make(texts, **columns):
        rows = [(i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["src0"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def as_table(tmp_path):
    """Writes frames as a driver's folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
