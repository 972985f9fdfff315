from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from emporia.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="emporia-test-ckpt-")
    session = build_session(
        "local[4]",
        app_name="emporia-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.checkpoint.dir": ckpt,
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="emporia-test-wh-"),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="emporia-test-")


def rows(df, *cols):
    """Rows as sorted tuples (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
