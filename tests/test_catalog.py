"""Every registered query against its SQL twin, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from moodlens.plans import catalog
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, con, sf_dir, name):
    problem = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir)
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    df = entry_module.entry(spark)
    assert df.columns == ["Emotion", "Rank", "Word", "Weight"]
    assert df.count() > 0
