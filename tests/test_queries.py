"""All registered queries against their SQL."""

import compare
import pytest

from qualitymart.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, sf_dir, name):
    ok, message = compare.check(name, spark, duck, sf_dir)
    assert ok, message


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 120
