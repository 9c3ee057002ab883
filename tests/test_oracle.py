"""Every registered query against DuckDB on the smallest given tables."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect

import __spark_entry__ as driver
from corpusmill.workload import queries as workload

# Queries SQL cannot say, and where they are checked instead.
WITHOUT_SQL = {
    "job_files_to_prompts": "test_jobs",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(workload.registered()))
def test_matches_sql(spark, con, sf_dir, name):
    ok, text = compare(spark, con, name, sf_dir)
    assert ok, text


def test_only_these_lack_sql():
    assert set(workload.registered()) - set(workload.oracles()) == set(WITHOUT_SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(workload.registered()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["query_id", "n_passages", "prompt"]
