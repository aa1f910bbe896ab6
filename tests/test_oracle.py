"""Every registered query gives the same rows as its SQL."""

import pytest

import __spark_entry__ as contract
import workload.oracles
from workload.queries import QUERIES
from tests.oracle_check import connect, differences

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(workload.oracles.ORACLES) <= set(ORACLES)
    assert len(QUERIES) == 60


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, db, name):
    assert differences(contract.queries()[name](spark, sf_dir), db, ORACLES[name]) is None


def test_entry_answers_the_flagship_question(spark):
    result = contract.entry(spark)
    assert "exec_date" in result.columns
    assert result.count() == 15


def test_tables_may_be_folders_of_files(spark, tmp_path_factory):
    """The layout of a large table: many files, of which a feed sees each one."""
    from workload import fixtures as fx

    small, folder = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("folders"))
    for name in ("events", "customer"):
        frame = fx.table(spark, small, name).repartition(6)
        frame.write.parquet(f"{folder}/{name}.parquet")
    for name in ("stream_failed_jobs", "stream_blocked_events", "blocked_events_store"):
        got, expected = contract.queries()[name](spark, folder), contract.queries()[name](spark, small)
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
