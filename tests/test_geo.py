"""Projection and path lengths."""

import math
import random

import pytest
from pyspark.sql import functions as F

from maillage.operators.geo import lambert93, path_lengths, row_length


def test_projection_of_known_points(spark):
    """The origin of the projection, and Paris and Nice as published by the survey office
    to the metre."""
    points = spark.createDataFrame(
        [(3.0, 46.5), (2.3522, 48.8566), (7.2620, 43.7102)], "lon double, lat double"
    )
    x, y = lambert93(F.col("lon"), F.col("lat"))
    got = points.select(x, y).collect()
    assert (got[0][0], got[0][1]) == (pytest.approx(700_000), pytest.approx(6_600_000))
    assert got[1][0] == pytest.approx(652_469, abs=3) and got[1][1] == pytest.approx(6_862_035, abs=3)
    assert got[2][0] == pytest.approx(1_043_000, abs=900)


def test_one_degree_of_latitude_is_about_111_km(spark):
    df = spark.createDataFrame(
        [(1, i, 3.0, 46.0 + i / 10) for i in range(11)], "p int, seq int, lon double, lat double"
    )
    km = path_lengths(df, path=["p"]).agg(F.sum("distance_km")).first()[0]
    assert float(km) == pytest.approx(111.1, abs=0.3)


@pytest.fixture(scope="module")
def walk(spark):
    rng = random.Random(5)
    rows = [
        (p, part, s, 2 + rng.random(), 46 + rng.random(), f"c{p}")
        for p in range(3)
        for part in range(2)
        for s in range(1 + 13 * p)
    ]
    return spark.createDataFrame(rows, "p int, part int, seq int, lon double, lat double, c string")


def test_cutting_into_stretches_changes_nothing(walk):
    def lengths(chunk):
        parts = path_lengths(walk, path=["p", "part"], keep=["c"], chunk=chunk)
        total = parts.groupBy("p", "part", "c").agg(F.sum("distance_km").alias("km"))
        return {(r.p, r.part, r.c): r.km for r in total.collect()}

    whole = lengths(1000)
    assert len(whole) == 6
    for chunk in (1, 2, 5, 13, 26):
        assert lengths(chunk) == whole


def test_lengths_equal_the_sum_of_the_steps(walk):
    x, y = lambert93(F.col("lon"), F.col("lat"))
    points = walk.select("p", "part", "seq", x.alias("x"), y.alias("y")).collect()
    by_path = {}
    for r in sorted(points, key=lambda r: r.seq):
        by_path.setdefault((r.p, r.part), []).append((r.x, r.y))
    got = path_lengths(walk, path=["p", "part"], chunk=4).groupBy("p", "part").agg(
        F.sum("distance_km").alias("km")
    )
    for row in got.collect():
        line = by_path[(row.p, row.part)]
        want = sum(math.dist(a, b) for a, b in zip(line, line[1:])) / 1000
        assert float(row.km or 0) == pytest.approx(want, abs=1e-6)


def test_no_task_holds_a_whole_long_path(walk):
    plan = path_lengths(walk, path=["p", "part"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(p" in plan and "_stretch" in plan


def test_lengths_within_the_row(walk):
    paths = walk.groupBy("p", "part").agg(F.sort_array(F.collect_list(F.struct("seq", "lon", "lat"))).alias("v"))
    inside = paths.select("p", "part", row_length(F.col("v")).alias("km"))
    assert "Window" not in inside._jdf.queryExecution().executedPlan().toString()
    parts = path_lengths(walk, path=["p", "part"]).groupBy("p", "part").agg(F.sum("distance_km").alias("km"))
    assert {tuple(r) for r in inside.collect()} == {tuple(r) for r in parts.collect()}
    few = walk.sparkSession.sql("SELECT CAST(NULL AS array<struct<lon:double,lat:double>>) a UNION ALL SELECT array() UNION ALL SELECT array(named_struct('lon', 2D, 'lat', 46D))")
    assert sorted(str(r[0]) for r in few.select(row_length(F.col("a"))).collect()) == ["None", "None", "None"]
