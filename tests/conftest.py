import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ripplekit.plans.lineage import drop_scratch  # noqa: E402
from ripplekit.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="ripplekit-tests", shuffle_partitions=4)
    yield s
    drop_scratch(s)
    s.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

