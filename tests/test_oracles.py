"""Every query equals its SQL on the driver's tables."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import compare, duck
from oracles import load_oracles
from placefolio.plans import registry

QUERIES, ORACLES = registry.QUERIES, load_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(df, con, load_oracles(sf_dir)[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    if not os.path.isdir(entry_module.SMOKE_DIR):
        pytest.skip("no smoke data")
    rows = entry_module.entry(spark).collect()
    assert {r["menu_status"] for r in rows} >= {"no_website", "menu_extracted", "source_found_no_items"}
