import importlib

import pytest

import check

entry = importlib.import_module("__spark_entry__")
SF_DIR = "/root/testdata/sf0.01"
SAMPLE = [
    "role_volume", "usage_grid", "campaign_grid_users", "keyword_features", "feature_assembly", "medians",
    "split_train_test", "woe_table", "gini_exact_lines", "threshold_sweep", "variable_roles", "name_scores",
]


def test_registry():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names
    assert len(names) > 90


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "account_key" and frame.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    con = check.database(SF_DIR)
    assert check.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None
