"""Every registered query of the engine against its SQL, on the smallest tables."""

import pytest

from isallobar.plans.queries import ORACLES, QUERIES
from tests.compare import connection, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


def test_stream_tracks_as_the_batch_does(spark):
    rows = [sorted(map(tuple, QUERIES[n](spark, SF).collect())) for n in ("track_fronts", "stream_tracking")]
    assert rows[0] == rows[1] and len(rows[0]) > 10


def test_inference_gives_probabilities(spark):
    found = QUERIES["model_inference"](spark, SF)
    assert found.count() == 24 * 48 * 2
    assert found.groupBy("r", "c").agg({"p": "sum"}).where("`sum(p)` > 1.0001 OR `sum(p)` < 0").count() == 0
