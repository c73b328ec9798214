"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import difference, oracle_connection

from __spark_entry__ import entry
from tallywatch.plans.catalog import QUERIES
from tallywatch.plans.oracle import ORACLE

ROWS_ONLY = {"train_score_logreg", "train_score_gbt"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, connection, name):
    frame = QUERIES[name](spark, sf_dir).toPandas()
    assert difference(frame, connection.sql(ORACLE[name]).df()) is None
