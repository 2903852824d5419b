import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marquee.session import local_session, remove_scratch
    s = local_session(cpus="*", shuffle_partitions=8, app="marquee-tests",
                      folder=str(tmp_path_factory.mktemp("spark")))
    yield s
    remove_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from marquee.oracle.compare import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def star_small(spark):
    from marquee.sources.star import star_catalogue
    return star_catalogue(spark, SF_SMALL)
