import os

import pytest

#: Small tables with nulls, empty and repeated rows, and columns whose names operators use themselves.
EXTRA = {"fp": 1, "n": 2, "spans": "x", "Group": 3, "a.b": 4}


@pytest.fixture
def rows(spark):
    """``rows(schema, data)``: a table with the extra columns, also when there is no data."""

    def make(schema, data):
        width = len(schema.split(","))
        full = schema + ", fp int, n int, spans string, Group int, `a.b` int"
        return spark.createDataFrame([(*r[:width], *EXTRA.values()) for r in data], full)

    return make


@pytest.fixture(scope="session")
def texts(sf_dir):
    import pyarrow.parquet as pq

    t = pq.read_table(os.path.join(sf_dir, "documents.parquet"), columns=["doc_id", "text", "lang"])
    return list(zip(*(t[c].to_pylist() for c in t.column_names), strict=True))
