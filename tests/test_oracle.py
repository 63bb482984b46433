"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import compare
import oracle_queries
import __spark_entry__ as entry
from cardwarden.plans import registry
from cardwarden.session import on_store, scratch, use_checkpoint_dir

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.QUERIES, oracle_queries.oracle()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    before = stored_folders(spark)
    with scratch(spark):
        df = QUERIES[name](spark, FOLDER)
        assert compare.differences(df, con, ORACLE[name]) is None
    assert stored_folders(spark) == before


def stored_folders(spark):
    path, files = on_store(spark, use_checkpoint_dir(spark))
    return {x.getPath().getName() for x in files.listStatus(path)} if files.exists(path) else set()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
