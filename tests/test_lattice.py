"""Dimensions rolled up from the finest cells, and fingerprints per key range."""

import re

import pytest

from tallyweave.operators.audit import table_fingerprint
from tallyweave.operators.durable import stored
from tallyweave.operators.hash_tree import FAN, hash_tree, range_borders, range_number, tree_difference
from tallyweave.operators.lattice import by_dimension, cell_estimate, cell_share, finest_cells
from tallyweave.functions import aggregates
from tallyweave.plans import catalogue

MEASURES = {"n": "count(*)", "many": "count_if(x > 5)", "total": "coalesce(CAST(sum(x) AS DECIMAL(38,2)), CAST(0 AS DECIMAL(38,2)))"}
COLUMNS = ["a", "b"]
MARKS = {"no_a": "grouping(a)", "no_b": "grouping(b)"}


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.range(600).selectExpr("IF(id % 7 = 0, NULL, id % 3) AS a", "CAST(id % 2 AS STRING) AS b", "IF(id % 11 = 0, NULL, CAST(id AS DECIMAL(18,2))) AS x")
    return table.repartition(3)


def rolled(table, share, total=True):
    return by_dimension(table, COLUMNS, MEASURES, MARKS, total=total, share=share)


@pytest.mark.parametrize("total", [True, False])
def test_cells_give_what_rows_give(rows, total):
    by_rows, by_cells = (rolled(rows, share, total) for share in (1.0, 0.0))
    assert by_rows.dtypes == by_cells.dtypes
    assert sorted(map(str, by_rows.collect())) == sorted(map(str, by_cells.collect()))
    assert rolled(rows.where("false"), 0.0).count() == rolled(rows.where("false"), 1.0).count()


def test_only_cells_are_expanded_where_that_pays(rows):
    def below_expand(table):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        return plan[plan.index("Expand") :]

    estimate = rows.agg(*aggregates(cell_estimate(COLUMNS))).first().asDict()
    assert finest_cells(rows, COLUMNS, MEASURES).count() == 8
    assert estimate["rows"] == 600 and abs(estimate["cells"] - 8) <= 1  # it is an estimate
    assert "Aggregate" in below_expand(rolled(rows, cell_share(estimate)))
    assert "Aggregate" not in below_expand(rolled(rows, 0.9))
    assert cell_share({}) == cell_share(None) == cell_share({"rows": 0, "cells": 0}) == 1.0


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(9000).selectExpr("concat('t', id) AS key", "id AS value", "IF(id % 5 = 0, NULL, 'x') AS label")


def test_ranges_are_even_and_repeat(spark, table):
    borders = range_borders(table, "key")
    assert borders == range_borders(table.repartition(7), "key") and len(borders) == FAN * FAN - 1
    placed = table.selectExpr("key", f"{range_number('key', borders)} AS node").collect()
    assert all(r.node == sum(b <= r.key for b in borders) for r in placed)
    sizes = [r.rows for r in hash_tree(table, "key", borders).where("level = 2").collect()]
    assert sum(sizes) == 9000 and len(sizes) == FAN * FAN and max(sizes) < 4 * 9000 / FAN**2


def test_difference_finds_exactly_the_changed_ranges(spark, table):
    borders = range_borders(table, "key")
    before = hash_tree(table, "key", borders)
    assert tree_difference(before, hash_tree(table.repartition(5), "key", borders), borders).isEmpty()
    after = table.where("key <> 't17'").selectExpr("key", "IF(key IN ('t4000', 't8999'), value + 1, value) AS value", "label")
    after = after.union(spark.createDataFrame([("a first", 1, None), (None, 2, "x")], "key string, value long, label string"))
    keys = ["t17", "t4000", "t8999", "a first", ""]
    for level, width in ((2, 1), (1, FAN), (0, FAN * FAN)):
        found = tree_difference(before, hash_tree(after, "key", borders), borders, level).collect()
        assert {r.node for r in found} == {sum(b <= k for b in borders) // width for k in keys}
        assert sum(r.rows_after - r.rows_before for r in found) == 1
        for r in found:
            assert any((r.from_key is None or r.from_key <= k) and (r.until_key is None or k < r.until_key) for k in keys)


def test_small_and_empty_tables(table):
    few = table.limit(3)
    borders = range_borders(few, "key")
    assert len(borders) <= 3 and hash_tree(few, "key", borders).where("level = 0").first().rows == 3
    none = table.where("false")
    assert range_borders(none, "key") == [] and hash_tree(none, "key", []).count() == 0
    assert tree_difference(hash_tree(none, "key", []), hash_tree(few, "key", []), []).first().rows_after == 3


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few orders, among them a repeated key and a null one."""
    path = str(tmp_path_factory.mktemp("orders"))
    spark.range(4001).selectExpr(
        "IF(id = 4000, NULL, id % 3990) AS o_orderkey", "id % 50 AS o_custkey", "CAST(1000 + id % 700 AS DOUBLE) AS o_totalprice",
        "TIMESTAMP_NTZ'1995-01-01 00:00:00' + make_dt_interval(CAST(id % 900 AS INT)) AS o_orderdate",
    ).write.parquet(f"{path}/orders.parquet")
    return path


def test_versions_are_compared_without_matching_the_feeds_again(spark, folder):
    facts = catalogue.Inputs(spark, catalogue.read_orders(spark, folder)).facts
    found = catalogue.queries()["fingerprint_difference"](spark, folder)
    assert not [f for f in found.inputFiles() if "orders.parquet" in f]
    key = "transaction_id"
    borders = range_borders(facts, key)
    marked = facts.selectExpr(f"{range_number(key, borders)} AS node", f"left(md5(concat('change', {key})), 3) AS mark").collect()
    assert {r.node for r in found.collect()} == {r.node for r in marked if r.mark is not None and r.mark <= "003"}


def test_hashing_a_row_of_facts_is_compiled_by_the_jvm(spark, folder, capsys):
    """HotSpot only interprets methods above 8000 bytes of bytecode."""
    facts = stored(catalogue.Inputs(spark, catalogue.read_orders(spark, folder)).facts, "facts")
    for table in (table_fingerprint(facts, "facts"), hash_tree(facts, "transaction_id", ["T000000100", "T000000200"])):
        table.collect()  # the adaptive plan is compiled as it runs
        capsys.readouterr()
        table.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000
