import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelcast.session import get_spark
    s = get_spark("panelcast-tests", master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def make_panel(spark, rows, schema="series string, period date, x double"):
    return spark.createDataFrame(rows, schema)
