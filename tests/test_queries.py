"""Every named query against its SQL twin on the smallest input, and what its plan may not hold."""

import pytest
from compare import compare, duck

import __spark_entry__ as driver
from farebox.plans.oracle import ORACLE as SQL
from farebox.plans.queries import QUERIES as BATCH
from farebox.plans.streams import STREAMS

QUERIES = {**BATCH, **STREAMS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name, capsys):
    problem, _, _, df = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert problem is None, problem
    df.explain("formatted")
    plan = capsys.readouterr().out
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


def test_rollup_reads_prune(spark, sf_dir, capsys):
    QUERIES["rollup_date_range_scan"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert "EqualTo(borough,ASIA)" in plan and "GreaterThanOrEqual(pickup_date" in plan


def test_trip_reads_prune_columns(spark, sf_dir, capsys):
    QUERIES["borough_counts"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "fare_amount" not in plan and "trip_id" not in plan


def test_first_documents_keep_only_what_is_shown(spark, sf_dir, capsys):
    QUERIES["list_trips"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_dictionary_is_a_hash_aggregate(spark, sf_dir, capsys):
    QUERIES["borough_dictionary"](spark, sf_dir).explain("formatted")
    assert "SortAggregate" not in capsys.readouterr().out
