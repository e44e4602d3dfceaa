import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment's Spark defaults when it
    # names one; rentscope.session.checkpoint_root only creates a folder when
    # the setting is absent.
    from rentscope.session import checkpoint_root, get_spark
    s = get_spark("local[4]", app="rentscope-tests", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()
