import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (in the given column order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def one(df, col):
    return [r[0] for r in df.select(col).collect()]
