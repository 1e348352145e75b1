"""Ordered features against brute force, also when innings are cut into many pieces."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from creaseline.functions.pressure import pressure_index, pressure_level
from creaseline.operators import innings

BALL = "match_id string, inning string, over_num int, ball_num int, runs_total int, wicket_kind string"


@pytest.fixture(scope="module")
def balls(spark):
    rnd = random.Random(7)
    rows = []
    for match, inning, overs, per_over in (("m1", "A", 3, 40), ("m1", "B", 20, 6), ("m2", "A", 1, 1), ("m2", None, 30, 1)):
        for o in range(overs):
            for b in range(1, per_over + 1):
                rows.append((match, inning, o, b, rnd.randint(0, 6), rnd.choice([None, None, None, "bowled"])))
    rows += [("m3", "A", None, 1, 4, None), ("m3", "A", 0, None, 3, None), ("m3", "A", 0, 1, 2, None)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, BALL)


def key(r):
    return (r.match_id, r.inning or "", -1 if r.over_num is None else r.over_num, -1 if r.ball_num is None else r.ball_num)


@pytest.mark.parametrize("piece, large", [(6, 0), (7, 0), (16, 0), (4096, 0), (16, 100), (16, 1 << 18)])
def test_running_and_rolling(balls, monkeypatch, piece, large):
    monkeypatch.setattr(innings, "PIECE", piece)
    monkeypatch.setattr(innings, "LARGE", large)
    order = Window.partitionBy("match_id", "inning").orderBy("over_num", "ball_num")
    want = balls.withColumn("c", F.sum("runs_total").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("r", F.avg("runs_total").over(order.rowsBetween(-5, 0)))
    expected = {key(r): (r.c, r.r) for r in want.collect()}
    assert {key(r): r.cumulative_runs for r in innings.cumulative_runs(balls).collect()} == {k: v[0] for k, v in expected.items()}
    rolled = innings.rolling_avg_runs(balls).collect()
    assert len(rolled) == len(expected) and {key(r): r.rolling_avg_runs for r in rolled} == {k: v[1] for k, v in expected.items()}


@pytest.mark.parametrize("piece, large", [(5, 0), (4096, 0), (5, 100), (5, 1 << 18)])
def test_stands(balls, monkeypatch, piece, large):
    monkeypatch.setattr(innings, "PIECE", piece)
    monkeypatch.setattr(innings, "LARGE", large)
    expected, stand = {}, {}
    for r in sorted(balls.collect(), key=key):
        group = (r.match_id, r.inning)
        n = stand.setdefault(group, 1)
        runs, faced = expected.get((*group, n), (0, 0))
        expected[(*group, n)] = (runs + r.runs_total, faced + 1)
        if r.wicket_kind:
            stand[group] = n + 1
    got = {(r.match_id, r.inning, r.stand_no): (r.stand_runs, r.stand_balls) for r in innings.stands(balls).collect()}
    assert got == expected


@pytest.mark.parametrize("feature", [innings.cumulative_runs, innings.rolling_avg_runs, innings.stands])
def test_one_exchange_and_one_sort(balls, feature):
    plan = feature(balls)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1 and "Join" not in plan


def test_rolling_limits(balls):
    with pytest.raises(ValueError):
        innings.rolling_avg_runs(balls, 0)


def test_momentum_first_over_is_steady(spark):
    rows = spark.createDataFrame([("m", "A", 0, 5), ("m", "A", 1, 9), ("m", "A", 2, 9), ("m", "A", 3, 1)],
                                 "match_id string, inning string, over_num int, over_runs int")
    got = [r.momentum_shift for r in innings.momentum_shifts(rows).orderBy("over_num").collect()]
    assert got == ["steady", "accelerating", "steady", "decelerating"]


@pytest.mark.parametrize("args, index, level", [
    ((8.0, 8.0, 0, 120, 120), 1.0, "Medium"), ((8.0, 4.0, 5, 60, 120), 1.5, "Medium"), ((8.0, 0.05, 0, 120, 120), 80.0, "High"),
    ((8.0, 0.0, 9, 10, 120), 0.0, "Low"), ((8.0, 6.0, 2, 10, 0), 0.0, "Low"), ((8.0, 16.0, 1, 118, 120), 0.54, "Low")])
def test_pressure(spark, args, index, level):
    row = spark.range(1).select(pressure_index(*[F.lit(a) for a in args]).alias("i")).withColumn("l", pressure_level("i")).first()
    assert (row.i, row.l) == (index, level)
