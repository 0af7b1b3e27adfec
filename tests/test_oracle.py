"""Every queries() key equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from cohortlift.plans.registry import QUERIES
from support import SMALL
from oracle_check import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SMALL, key, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "audience_size" in df.columns and "conversions_watched_video" in df.columns


def test_oracle_is_independent_of_the_p_values_code():
    import ast

    import cohortlift.plans.oracle as O

    nodes = list(ast.walk(ast.parse(open(O.__file__).read())))
    names = [n.module or "" for n in nodes if isinstance(n, ast.ImportFrom)]
    names += [a.name for n in nodes if isinstance(n, ast.Import | ast.ImportFrom) for a in n.names]
    assert not [n for n in names if n.split(".")[-1] in ("stats", "significance")]
