import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clientincome.session import local_session

    s = local_session("*", **{"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ci-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def inputs_small(spark):
    from clientincome.sources.fixtures import load_inputs

    return load_inputs(spark, SF_SMALL)
