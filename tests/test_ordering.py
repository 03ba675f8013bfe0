"""Global ranks and quantiles against brute force, with hot ties."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from payments import by_id
from tallyweave.operators.durable import shared_folder
from tallyweave.operators.ordering import quantiles_by_count, ranked, sliced_by


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small partitions must not be merged here: ranks have to hold across slices."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, before)


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all rows share one score."""
    rng = random.Random(5)
    rows = [(f"t{n:05d}", 330.0 if n % 3 == 0 else float(rng.randrange(200, 460))) for n in range(6000)]
    rng.shuffle(rows)
    return rows


def test_rank_equals_position_in_the_full_order(spark, scores):
    df = spark.createDataFrame(scores, "id string, score double").repartition(7)
    got = by_id(ranked(df, [F.col("score").desc(), F.col("id").asc()], "place"), "id")
    expected = sorted(scores, key=lambda r: (-r[1], r[0]))
    assert [got[i].place for i, _ in expected] == list(range(1, len(scores) + 1))


def test_hot_score_is_split_over_slices(spark, scores):
    df = spark.createDataFrame(scores, "id string, score double")
    slices = sliced_by(df, F.col("score").desc(), F.col("id").asc())
    assert slices.filter("score = 330").select("_slice").distinct().count() > 1


def test_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, score double")
    assert ranked(empty, [F.col("score").desc(), F.col("id").asc()], "place").collect() == []


def test_quantiles_equal_linear_interpolation(spark):
    rng = random.Random(9)
    values = {
        "hot": [86400] * 700 + [rng.randrange(1, 10**6) for _ in range(300)],
        "one": [42],
        "two": [10, 20],
        "spread": [rng.randrange(1, 10**9) for _ in range(501)],
    }
    rows = [(g, v) for g, vs in values.items() for v in vs]
    counts = spark.createDataFrame(rows, "g string, v long").groupBy("g", "v").agg(F.count("*").alias("n"))
    got = by_id(quantiles_by_count(counts, "g", "v", "n", {"median": 0.5, "p95": 0.95}), "g")
    for group, vs in values.items():
        assert got[group].median == pytest.approx(np.quantile(vs, 0.5), rel=1e-12)
        assert got[group].p95 == pytest.approx(np.quantile(vs, 0.95), rel=1e-12)


def test_quantiles_of_wide_values(spark):
    """Microseconds over years, on both sides of zero, where all three rounds decide; a third of the rows share one value."""
    rng = random.Random(13)
    values = {
        "wide": [rng.randrange(-(2**50), 2**50) for _ in range(400)] + [2**47 + 3] * 200,
        "near": [2**45 + rng.randrange(3_000_000) for _ in range(333)],
        "below": [-5, -4, -4, -(2**40), -(2**40) - 1],
        "edge": [2**59 - 1, -(2**59), 0],
    }
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("wide", None), (None, 7), ("empty", None)]
    counts = spark.createDataFrame(rows, "g string, v long").groupBy("g", "v").agg(F.count("*").alias("n"))
    got = by_id(quantiles_by_count(counts, "g", "v", "n", {"median": 0.5, "p95": 0.95}), "g")
    assert set(got) == set(values)
    for group, vs in values.items():
        assert got[group].median == pytest.approx(np.quantile(vs, 0.5), rel=1e-12)
        assert got[group].p95 == pytest.approx(np.quantile(vs, 0.95), rel=1e-12)
    assert quantiles_by_count(counts.where("false"), "g", "v", "n", {"median": 0.5}).count() == 0


def test_checkpoints_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named
    assert shared_folder(spark)
