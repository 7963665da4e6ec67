import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hirescope.session import get_spark
    s = get_spark("hirescope-tests", master="local[4]", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="hs-wh-")})
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
