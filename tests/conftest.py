import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deliverylens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("deliverylens-tests", cores="*", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    """Collected rows as plain tuples, in the DataFrame's order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
