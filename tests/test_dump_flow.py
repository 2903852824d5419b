"""End to end through the dumps: every question gives the same rows when the
catalogue is read back from tab-separated dumps instead of derived in place."""

import pytest

from marquee.__main__ import question_keys
from marquee.plans.registry import QUERIES
from marquee.sources import tsv
from marquee.sources.catalogue import TABLES
from marquee.sources.star import star_catalogue
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    star = star_catalogue(spark, SF_SMALL)
    folder = str(tmp_path_factory.mktemp("dumps"))
    for t in TABLES:
        tsv.write_dump(star[t], t, folder)
    return star, tsv.load_catalogue(spark, folder)


@pytest.mark.parametrize("key", question_keys())
def test_same_answers_from_dumps(both, key):
    star, dumped = both
    a = sorted(map(str, QUERIES[key](star).collect()))
    b = sorted(map(str, QUERIES[key](dumped).collect()))
    assert a == b, key
