import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bazaar.session import build_session
    wh = tempfile.mkdtemp(prefix="bazaar-test-wh-")
    s = build_session("local[4]", app="bazaar-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
