from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starlens.session import configure, local_session  # noqa: E402
from starlens.sources.schemas import SCHEMAS  # noqa: E402
from starlens.sources.star import Star  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="starlens-tests")
    configure(s)
    yield s
    s.stop()


def make_star(spark, **rows) -> Star:
    """A star from hand-made rows; tables not given are empty.  Rows are
    tuples in schema order or dicts."""
    tables = {}
    for name, schema in SCHEMAS.items():
        data = rows.get(name, [])
        data = [tuple(r.get(f) for f in schema.names) if isinstance(r, dict) else tuple(r) for r in data]
        tables[name] = spark.createDataFrame(data, schema)
    return Star(spark, tables)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
