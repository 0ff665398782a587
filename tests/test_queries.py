"""Every registered query against its SQL counterpart."""

import pytest

from checks import compare, oracle, queries


def test_every_query_has_a_counterpart():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.fixture(scope="module")
def con(small):
    return compare.tables(small)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, con, small, name):
    good, text = compare.compare(spark, con, name, small)
    assert good, text


@pytest.mark.parametrize("name", ["movement_union", "client_pull", "classify_payouts", "invoiced_summary", "fn_date"])
def test_session_time_zone_does_not_matter(spark, con, small, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        good, text = compare.compare(spark, con, name, small)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert good, text
