"""Every registered query: equal to its oracle, and a plan fit for big tables."""

import re

import pytest

from checks.compare import differences
from checks.oracle import oracle_queries
from checks.queries import registered_queries

from .conftest import SF_DIR


def test_every_query_has_an_oracle():
    assert set(registered_queries()) == set(oracle_queries())


def test_queries_equal_their_oracle(spark):
    assert differences(spark, SF_DIR) == {}


@pytest.mark.parametrize("name", sorted(registered_queries()))
def test_plan(spark, name):
    df = registered_queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "Python" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # Columns that no query reads are pruned from the scans.
    for scan in re.findall(r"ReadSchema: struct<(.*?)>", plan):
        assert "props" not in scan and "l_tax" not in scan


def test_queries_bring_the_settings_they_are_written_for(spark):
    """A session that was made elsewhere has no limit on generated methods, so the JVM would interpret the widest stages."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    try:
        registered_queries()["net_list"](spark, SF_DIR)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "9000")
        registered_queries()["net_list"](spark, SF_DIR)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.set(key, "8000")


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_net_list_carries_only_what_its_reader_asks_for(spark):
    """Holidays are worked out for a day label that no reader of the list sees."""
    plan = _optimized(registered_queries()["net_list_view"](spark, SF_DIR))
    assert "dayofweek" not in plan.lower()


def test_two_months_are_summed_in_one_pass_over_the_net_list(spark):
    scans = {n: _optimized(registered_queries()[n](spark, SF_DIR)).count("Relation") for n in ("net_list_month", "net_list_view")}
    assert scans["net_list_month"] == scans["net_list_view"]
