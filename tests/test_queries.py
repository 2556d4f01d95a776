"""Every query that has an SQL answer gives that answer on the smallest data."""

import pytest

import __spark_entry__ as entry
from millrace import registry
from tests.compare import differences, oracle_connection
from tests.conftest import SF_DIR

SQL = entry.oracle_sql()
QUERIES = entry.queries()
# These train a model and are covered by test_model.
TRAINED = {
    "ml_train", "ml_score", "ev_importance", "sink_predictions", "ts_failure_train",
    "ts_failure_score", "adv_risk_radar", "ml_score_incoming",
}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_is_checked():
    assert set(registry.queries()) - set(SQL) == TRAINED
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, oracle, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle, SQL[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
