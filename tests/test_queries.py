import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry
from larderlens.plans.oracle import ORACLE
from larderlens.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf, name):
    assert compare(spark, con, sf, QUERIES[name], ORACLE[name]) is None


def test_flagship(spark):
    assert entry(spark).count() == 111


def test_golden_totals(spark, sf):
    allergens = {r.name: r.recipes for r in QUERIES["allergen_list"](spark, sf).collect()}
    assert allergens == {"peanuts": 372, "tree_nuts": 503, "dairy": 708, "egg": 317}
    tags = {r.name: r.recipes for r in QUERIES["dietary_tag_list"](spark, sf).collect()}
    assert tags == {"vegetarian": 974, "vegan": 427, "gluten_free": 1024, "contains_raw_egg": 292}
    assert QUERIES["recipe_ingredient_bridge"](spark, sf).count() == 5806
