import random

import pytest
from pyspark.sql import functions as F

from deadhead.config import Tuning
from deadhead.functions.cost import leg_cost, leg_hours
from deadhead.functions.geo import road_miles
from deadhead.functions.tables import all_pairs, dense_id, expanding_join, fill_from, grid, look_up_slots


@pytest.mark.parametrize(
    "miles,hours",
    [(50.0, 50 / 30), (50.01, 1.6672), (100.0, 2.667), (100.01, 2.667 + 0.01 / 65), (0.0, 0.33), (5.0, 0.33), (None, None)],
)
def test_leg_hours_at_the_joints(spark, miles, hours):
    got = spark.createDataFrame([(miles,)], "m double").select(leg_hours(F.col("m"))).first()[0]
    assert got == (None if hours is None else pytest.approx(hours))


def test_leg_cost_of_missing_rates_or_legs_is_zero(spark):
    df = spark.createDataFrame([(10.0, None), (None, 2.0), (30.0, 2.0)], "m double, r double")
    got = [r[0] for r in df.select(leg_cost(F.col("m"), F.col("r"), F.col("r"), F.col("r"))).collect()]
    assert got == [0.0, 0.0, pytest.approx(30 * 2 + 30 * 0.4 + 2 + 1.0 * 2)]


def test_road_miles_scales_a_degree_of_the_equator(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, None, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(road_miles(*[F.col(c) for c in "abcd"])).collect()]
    assert got == [pytest.approx(6371010 * 3.141592653589793 / 180 * 1.2 / 1.6 / 1000), None]


def test_fill_from_keeps_values_and_unmatched_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None), (None, None)], "k string, v double")
    lookup = spark.createDataFrame([("a", 9.0, 9.0), ("b", None, 5.0), (None, 7.0, 7.0)], "k string, x double, y double")
    got = {r.k: r.v for r in fill_from(df, lookup, ["k"], "v", "x", "y").collect()}
    assert got == {"a": 1.0, "b": 5.0, "c": None, None: None}


def test_dense_id_numbers_in_order_without_one_partition(spark):
    values = list(range(5000))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v % 7, v) for v in values], "a long, b long").repartition(6)
    numbered = dense_id(df, ["a", "b"], "n")
    rows = numbered.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 5001))
    assert [(r.a, r.b) for r in rows] == sorted((v % 7, v) for v in values)


def test_dense_id_of_nothing(spark):
    assert dense_id(spark.createDataFrame([], "a long"), ["a"], "n").count() == 0


@pytest.mark.parametrize("pairs_per_task", [1, 72, 200, 10_000])
def test_expanding_join_equals_plain_join_with_a_hot_key(spark, pairs_per_task):
    rng = random.Random(1)
    left = [(0 if rng.random() < 0.4 else rng.randrange(5), i) for i in range(60)] + [(None, 99)]
    right = [(0 if rng.random() < 0.4 else rng.randrange(5), i) for i in range(40)] + [(None, 99)]
    ldf = spark.createDataFrame(left, "x long, i long")
    rdf = spark.createDataFrame(right, "y long, j long")
    tuning = Tuning(pairs_per_task=pairs_per_task)
    got = expanding_join(ldf, rdf, [("x", "y")], F.col("i") != F.col("j"), tuning)
    assert got.columns == ["x", "i", "y", "j"]
    want = sorted((a, i, b, j) for a, i in left for b, j in right if a is not None and a == b and i != j)
    assert sorted(tuple(r) for r in got.collect()) == want
    # an explicit number of partitions, which adaptive execution does not merge
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("REPARTITION_BY_NUM" in plan) == (pairs_per_task <= 200)


@pytest.mark.parametrize("pairs_per_task", [7, 10_000])
def test_all_pairs(spark, pairs_per_task):
    left = spark.range(30).withColumnRenamed("id", "a")
    right = spark.range(7).withColumnRenamed("id", "b")
    tuning = Tuning(pairs_per_task=pairs_per_task)
    for x, y in ((left, right), (right, left)):
        got = all_pairs(x, y, tuning)
        assert sorted(tuple(r) for r in got.collect()) == sorted((p, q) for p in range(x.count()) for q in range(y.count()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(("n_left", "n_right", "tasks"), [(2_000, 2_000, 8), (1_000_000, 100_000, 100_000), (500_000, 300, 300)])
def test_grid_repeats_few_rows(n_left, n_right, tasks):
    own, other = grid(n_left, n_right, tasks)
    assert n_left * other + n_right * own <= 0.05 * n_left * n_right
    assert own * other >= tasks


def test_look_up_slots_equals_separate_joins(spark):
    rows = spark.createDataFrame([(1, 10, 20), (1, 10, 20), (2, None, 20), (3, 11, None), (4, 99, 10), (5, None, None)], "id int, a int, b int")
    lookup = spark.createDataFrame([(10, "x"), (10, "y"), (20, "z"), (20, None), (11, "w"), (None, "never")], "k int, v string")
    got = look_up_slots(rows, [["a"], ["b"]], lookup, ["k"], [{"v": "va"}, {"v": "vb"}])
    assert got.columns == ["id", "a", "b", "va", "vb"]
    want = rows
    for c in "ab":
        want = want.join(lookup.select(F.col("k").alias(c), F.col("v").alias(f"v{c}")), c, "left")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # the look-up, and back to the rows
    assert "atleastnnonnulls" in plan  # slots without a key are not joined
