"""Every registered query against its SQL, and the driver contract."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from serpscope.plans.catalog import QUERIES as OWN

# Other subpackages test their own queries.
QUERIES = {n: q for n, q in entry.queries().items() if n in OWN}
SQL = {n: s for n, s in entry.oracle_sql().items() if n in OWN}


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, data, name):
    assert compare(spark, con, QUERIES[name], SQL[name], data) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_registry_is_consistent():
    assert set(SQL) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(SQL)) == [
        "collinearity_vif",
        "feature_attribution",
        "importance_ranking",
        "model_record",
        "promote_if_better",
        "score_batch",
        "score_outliers",
        "segment_outliers",
        "top_importances",
        "train_outlier_model",
        "train_quality_model",
        "tune_quality_model",
    ]
