"""Repeated keys by compressed bitmaps against a plain count."""

import random
from collections import Counter

import pytest

from tallyweave.operators import repeats


@pytest.fixture(scope="module")
def feed(spark):
    rng = random.Random(2)
    keys = [f"id{k}" for k in range(4000)] + ["hot"] * 2000 + [f"id{rng.randrange(400)}" for _ in range(60)] + [None, None, "", " id1"]
    rng.shuffle(keys)
    return spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "id string, amount long").repartition(6)


def plain(feed):
    return {k: n for k, n in Counter(r.id for r in feed.collect()).items() if n > 1 and k is not None}


@pytest.mark.parametrize("few", [repeats.FEW, 0])
@pytest.mark.parametrize("cells", [repeats.BLOCK_CELLS, 50])
def test_repeated_keys_equal_a_plain_count(feed, monkeypatch, few, cells):
    monkeypatch.setattr(repeats, "FEW", few)
    monkeypatch.setattr(repeats, "BLOCK_CELLS", cells)
    assert {r.id: r.rows for r in repeats.repeated_keys(feed, "id").collect()} == plain(feed)


def test_only_repeated_rows_are_suspected(feed):
    found = repeats.suspected(feed, "id").collect()
    repeated = plain(feed)
    assert len(found) == sum(repeated.values()) and {r.id for r in found} == set(repeated)


def test_bitmaps_are_few_rows_whatever_the_keys(feed):
    hashes = feed.filter("id IS NOT NULL").selectExpr("xxhash64(id) AS _hash")
    sent = hashes.mapInArrow(repeats._bitmaps(4), repeats._BITMAP)
    assert sent.count() <= 6 * 4
    size = sent.selectExpr("sum(length(once) + length(twice)) AS bytes").first().bytes
    assert size <= 4 * feed.select("id").distinct().count() * 1.6
    plan = repeats.repeated_keys(feed, "id")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan


def test_clashing_hashes_cost_only_work(spark):
    import numpy as np

    same = np.array([7, 7, 9], np.uint64)
    batch = repeats._packed(same, 1)
    assert batch.column("once").to_pylist() == [np.array([9], np.uint32).tobytes()]
    assert batch.column("twice").to_pylist() == [np.array([7], np.uint32).tobytes()]


def test_no_rows(feed):
    assert repeats.repeated_keys(feed.filter("false"), "id").collect() == []
    assert repeats.repeated_keys(feed.filter("id IS NULL"), "id").collect() == []
