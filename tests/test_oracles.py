"""Every registered query on the smallest data set: against its check SQL, or for rows only."""

import pytest

from tests.check import compare, connect

from medtable.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        error, _ = compare(df, con, ORACLES[name])
        assert error is None, error
    else:
        assert df.count() > 0


def test_every_query_has_a_check():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e
    assert e.entry(spark).limit(1).count() == 1
    assert e.queries().keys() >= QUERIES.keys() and e.oracle_sql().keys() >= ORACLES.keys()


def test_training_queries_come_with_their_subpackage():
    import importlib.util

    import __spark_entry__ as e

    more = e.queries().keys() - QUERIES.keys()
    if importlib.util.find_spec("medtable.llm"):
        assert {n.split("_")[0] for n in more if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)}
        assert ("pipeline" in more) == bool(importlib.util.find_spec("corpus_pipeline"))
    else:
        assert not more
