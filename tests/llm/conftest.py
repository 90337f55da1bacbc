from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def build(rows, schema=DOCS):
        width = len(schema.split(","))
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        return spark.createDataFrame(full, schema)
    return build
