from __future__ import annotations

import datetime as dt
import tempfile
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session(
        "tidemark-tests",
        master="local[*]",
        **{"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "8",
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tm-warehouse-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def d(n: int) -> dt.datetime:
    """Day ``n`` as a naive timestamp (d(1) = 2024-01-01)."""
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n - 1)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
