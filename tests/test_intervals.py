"""States merged along cutoffs against plain aggregation, and the plan behind them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from payments import Payments
from tallyweave.operators.facts import snapshot_facts
from tallyweave.operators.intervals import decomposed, prefix_merged
from tallyweave.plans.operations import cut_feeds, run_operations, snapshot_comparison, typed_feeds

EXPRESSIONS = {
    "rows": "count(amount)", "label": "CASE WHEN min(name) = max(name) THEN min(name) WHEN count(name) > 0 THEN 'several' ELSE 'none' END",
    "excess": "sum(amount) - max(amount)", "latest": "max(seen)",
}
CUTOFFS = [f"TIMESTAMP_NTZ '2026-01-{day:02d} 00:00:00'" for day in range(2, 26)]


def test_states_behind_expressions():
    states, over = decomposed({"a": "sum(x) - max(x)", "b": "coalesce(max(y), 'maximal')"})
    assert states == {"_sum_x": ("sum", "x"), "_max_x": ("max", "x"), "_max_y": ("max", "y")}
    assert over == {"a": "_sum_x - _max_x", "b": "coalesce(_max_y, 'maximal')"}


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(8)
    rows = [
        ("hot" if n % 3 == 0 else f"t{rng.randrange(40)}", rng.choice([None, "a", "b"]), f"{rng.randrange(10000)}.25", f"2026-01-{rng.randrange(1, 29):02d} {rng.choice(['00:00:00', '11:30:00'])}")
        for n in range(1500)
    ]
    text = spark.createDataFrame(rows, "id string, name string, amount string, seen string")
    return text.selectExpr("id", "name", "CAST(amount AS DECIMAL(18,2)) AS amount", "CAST(seen AS TIMESTAMP_NTZ) AS seen").repartition(5)


def test_merged_states_equal_aggregates_at_every_cutoff(spark, events):
    merged = prefix_merged(events, "id", "seen", CUTOFFS, EXPRESSIONS)
    plain = None
    for cutoff in CUTOFFS:
        at = events.filter(f"seen <= {cutoff}").selectExpr(f"{cutoff} AS as_of", "*").groupBy("as_of", "id")
        one = at.agg(*[F.expr(f"{e} AS {n}") for n, e in EXPRESSIONS.items()])
        plain = one if plain is None else plain.union(one)
    assert merged.dtypes == plain.dtypes
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, plain.collect()))


def test_events_are_not_copied_before_the_shuffle(spark, events):
    plan = prefix_merged(events, "id", "seen", CUTOFFS, EXPRESSIONS)._jdf.queryExecution().executedPlan().toString()
    above, below = re.split(r"Exchange hashpartitioning\(id", plan, maxsplit=1)
    assert "Generate" in above and "Generate" not in below and "Expand" not in below
    assert "partial_sum" in below


def test_rows_of_a_hot_key_are_as_few_as_cutoffs(spark, events):
    from tallyweave.operators.intervals import states_by_interval

    states, _ = decomposed(EXPRESSIONS)
    added = states_by_interval(events.filter("id = 'hot'"), "id", "seen", CUTOFFS, states)
    assert added.count() == len(CUTOFFS)


def test_many_snapshots_equal_single_runs(spark):
    feeds = Payments().add("late", bank=[{"settled_at": "2026-01-20T00:00:00"}]).feeds(spark)
    cutoffs = [f"2026-01-{day:02d}" for day in range(1, 25)]
    rows = sorted(snapshot_comparison(spark, feeds, cutoffs).collect(), key=lambda r: r.as_of)
    assert len(rows) == 24
    for cutoff in (cutoffs[0], cutoffs[11], cutoffs[-1]):
        (single,) = run_operations(**feeds, as_of=cutoff).tables["summary"].collect()
        assert tuple(rows[cutoffs.index(cutoff)])[1:] == tuple(single)


def test_no_event_before_any_cutoff(spark):
    feeds = cut_feeds(typed_feeds(Payments().feeds(spark)), "2026-02-10")
    assert snapshot_facts(feeds, ["2001-01-01", "2002-01-01"]).count() == 0
