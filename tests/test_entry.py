"""The registered queries: contract, and equality with the oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

from .oracle_compare import connect, difference

FOLDER = entry.SMOKE_FOLDER
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 19


def test_every_query_has_an_oracle():
    """But for those of the optional package that SQL cannot express; its own tests cover them."""
    optional = {*entry.corpus.queries(), "pipeline"} if entry.corpus else set()
    assert set(entry.queries()) - optional == set(entry.oracle_sql()) - optional
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, name):
    con = connect(FOLDER)
    assert difference(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize(
    "name",
    [
        "star_audit_checks", "star_purchase_rate_by_segment", "star_cost_per_purchase_by_segment",
        "check_orphan_orders_customer", "check_order_value_vs_solvent_customers", "check_user_turns_without_answer",
        "audit_checks", "fault_audit_checks", "hire_rate_by_channel", "cost_per_hire_by_channel", "key_conditions",
    ],
)
def test_query_equals_oracle_when_no_side_is_small(spark, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        con = connect(FOLDER)
        assert difference(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.set(key, before)
