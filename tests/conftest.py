import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowframe.session import get_spark
    # tiny segments and few blocks so every ordered operator crosses many segment
    # and block boundaries even on small inputs
    s = get_spark("local[4]", shuffle_partitions=8, **{
        "flowframe.order.segmentRows": "16", "flowframe.order.blocks": "8"})
    yield s
