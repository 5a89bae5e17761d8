"""Every registered query beside its SQL twin, on the smallest data."""

import pytest

from check_twins import compare, oracle
from conftest import SF_DIR
from tabularium.catalog import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_twin(spark, con, name):
    problem, rows = compare(spark, con, name, QUERIES[name], SF_DIR)
    assert problem is None, problem
    if name != "q14_freshness":
        assert rows > 0


def test_names():
    for name in QUERIES:
        assert "pipeline" not in name
        assert name.split("_")[0].rstrip("0123456789") in {"io", "p", "j", "a", "w", "o", "u", "f", "t", "n", "q", "e", "m", "st", "x"}
