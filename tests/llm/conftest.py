from __future__ import annotations

import pytest

from cropweave.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture
def shared(tmp_path):
    """A folder for tables in between, as spark.checkpoint.dir names one on a cluster."""
    return f"file://{tmp_path}/shared"


@pytest.fixture
def documents(spark):
    """Rows as documents has them: (doc_id, text), some more columns with odd names beside."""

    def make(rows):
        wide = [(i, t, None, "src0", None, "x", 1.5) for i, t in rows]
        return spark.createDataFrame(
            wide,
            "doc_id long, text string, lang string, source string, n_chars long, key string, predicted double",
        )

    return make
