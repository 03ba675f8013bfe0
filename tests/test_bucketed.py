"""Joins of bucketed feeds: no exchange, and the same rows as without buckets."""

import pytest

from tallyweave.operators import matching
from tallyweave.operators.facts import facts_by_joins
from tallyweave.plans import operations
from tallyweave.plans.catalogue import SHAPES, Inputs
from tallyweave.sources.bucketed import bucket_count, write_bucketed
from tallyweave.sources.order_feeds import read_orders

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, read_orders(spark, SF))


@pytest.fixture(scope="module")
def stored(inputs):
    tables = write_bucketed(inputs.unfiltered, 3)
    yield tables
    tables.drop()


@pytest.mark.parametrize("shape", list(SHAPES))
def test_joins_of_buckets_need_no_exchange(inputs, stored, shape):
    found = SHAPES[shape](stored.feeds())
    assert "Exchange" not in plan_of(found)
    assert "Exchange" in plan_of(SHAPES[shape](inputs.unfiltered))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, SHAPES[shape](inputs.unfiltered).collect()))


def test_facts_from_buckets_need_no_exchange_but_the_union_of_ids(inputs):
    tables = write_bucketed(operations.typed_feeds(inputs.raw), 4)
    facts = facts_by_joins(operations.cut_feeds(tables.feeds(), inputs.as_of), inputs.as_of)
    # The ids of three tables are stacked, and a union has no layout of its own.
    assert plan_of(facts).count("Exchange hashpartitioning") <= 1
    assert facts.count() == inputs.facts.count()
    tables.drop()


def test_repeated_ids_of_a_bucketed_feed_need_no_exchange(stored):
    assert "Exchange" not in plan_of(matching.repeated(stored.feeds()["gateway"]))


def test_dropped_tables_are_gone(spark, inputs):
    tables = write_bucketed({"gateway": inputs.unfiltered["gateway"]}, 2)
    tables.drop()
    assert not spark.catalog.tableExists(tables.tables["gateway"])


def test_bucket_counts_double():
    assert [bucket_count(n, 100) for n in (0, 100, 101, 200, 201, 1000)] == [1, 1, 2, 2, 4, 16]


def test_a_repeated_ledger_id_is_refused(inputs):
    feeds = inputs.unfiltered
    twice = feeds | {"internal": feeds["internal"].union(feeds["internal"].limit(1))}
    with pytest.raises(Exception, match="internal holds a repeated transaction_id"):
        matching.matched_ledger_gateway(twice).collect()
