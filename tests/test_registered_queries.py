"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from vendue.checks.compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Steps of other queries in the list; with TEST_ALL=1 they run on their own as well.
STEPS = {
    "best_rank_items", "best_rank_clicks", "best_rank_counts", "best_rank_frame", "product_list", "unique_members",
    "orders_demo", "segment_counts", "segment_cube", "segment_score", "segment_rank", "attribute_one_day", "full_items",
    "search_best_items", "known_clicks", "search_best_click_log", "search_best_buy_log", "search_signals",
    "search_model_features", "basket_rows", "item_frequency", "brand_top", "brand_new", "related_brands", "similar_top",
    "fp_growth_rules", "index_users", "item_similarity", "categorise", "read_item_views_loose", "global_row_number",
    "global_rank", "rules_for", "explode_visit_orders", "evaluate_mae_factorised",
}
SKIPPED = set() if os.environ.get("TEST_ALL") else STEPS

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql().keys() - SKIPPED))
def test_equals_sql(spark, con, name):
    assert difference(registered.queries()[name](spark, SF_DIR), con, registered.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(registered.queries().keys() - registered.oracle_sql().keys() - SKIPPED))
def test_runs(spark, name):
    assert registered.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_names():
    assert SKIPPED <= registered.queries().keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()
