"""Aggregation operators against hand-made and brute-force results."""

import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maillage.operators.rollup import (
    any_values,
    distinct_counts,
    matched_counts,
    mean_per_group,
    mean_per_year,
    presence_score,
    roll_up,
    totals_by,
)
from tests.conftest import SESSION


def test_roll_up_gives_null_without_facts_and_sums_both_sides(frame, rows):
    members = frame(
        "area string, grp string, pop int", ("a", "g", 10), ("b", "g", 20), ("c", "h", 5), ("d", None, 1)
    )
    facts = frame("area string, id int", ("a", 1), ("a", 2), ("b", None), ("x", 9))
    counts = totals_by(facts, "area", n=F.count("id"))
    got = roll_up(members, counts, area="area", group="grp", sums=["n", "pop"])
    assert rows(got) == [(None, None, 1), ("g", 2, 30), ("h", None, 5)]


def test_roll_up_total_is_the_fact_total(spark, rows):
    members = spark.range(50).select("id", (F.col("id") % 7).alias("grp"))
    facts = spark.range(10_000).select((F.col("id") * F.col("id") % 50).alias("id"))
    per_area = totals_by(facts, "id", n=F.count("*"))
    got = roll_up(members, per_area, area="id", group="grp", sums=["n"])
    assert got.agg(F.sum("n")).first()[0] == 10_000
    assert got.count() == 7


def test_mean_per_group_is_the_mean_of_the_joined_rows(frame, rows):
    members = frame("area string, grp string", ("a", "g"), ("b", "g"), ("c", "h"))
    facts = frame("area string, d double", ("a", 1.0), ("a", 2.0), ("b", 6.0), ("b", None))
    got = mean_per_group(members, facts, area="area", group="grp", measure="d")
    assert rows(got) == [("g", 9.0, 3), ("h", None, None)]


def test_mean_per_year_counts_years_once(frame, rows):
    facts = frame(
        "k string, y int, q double",
        ("a", 2019, 1.0),
        ("a", 2019, 2.0),
        ("a", 2020, 3.0),
        ("a", None, 4.0),
        ("b", 2019, None),
    )
    got = mean_per_year(facts, key="k", year="y", measure="q")
    assert rows(got) == [("a", 5.0), ("b", None)]


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.sampled_from(["1", "2", "3", None]), max_size=30),
    st.lists(st.tuples(st.sampled_from(["1", "2", "4", None]), st.sampled_from("xyz")), max_size=30),
)
def test_matched_counts_equal_the_join(fact_keys, members):
    facts = SESSION.createDataFrame([(k,) for k in fact_keys], "k string")
    table = SESSION.createDataFrame(members, "k string, grp string")
    want = defaultdict(int)
    for key in fact_keys:
        for other, group in members:
            if key is not None and key == other:
                want[group] += 1
    got = matched_counts(facts, table, key="k", group="grp")
    assert {r["grp"]: r["n"] for r in got.collect()} == dict(want)


def test_matched_counts_once_per_fact(frame, rows):
    facts = frame("k string", ("1",), ("1",), ("2",))
    members = frame("k string, grp string", ("1", "x"), ("1", "a"), ("2", "x"), ("2", "x"))
    args = {"key": "k", "group": "grp"}
    assert rows(matched_counts(facts, members, **args)) == [("a", 2), ("x", 4)]
    assert rows(matched_counts(facts, members, dedupe=True, **args)) == [("a", 2), ("x", 1)]


def test_presence_score(frame, rows):
    facts = frame(
        "area string, flood string, fire string, quake string",
        ("a", "1", "0", None),
        ("b", "0.6", "N/A - unknown", "0"),
        ("c", "0", "0", "0.4"),
    )
    members = frame("area string, grp string", ("a", "g"), ("b", "g"), ("c", "h"), ("d", "i"))
    got = presence_score(
        facts, members, area="area", group="grp", categories=["flood", "fire", "quake"], score="s"
    )
    assert rows(got) == [("g", 1), ("h", 0)]


def test_distinct_counts_equal_plain_distinct_counts(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice("pqr"), rng.randrange(9))
            for _ in range(300)]
    df = spark.createDataFrame(data, "k string, c1 string, c2 string, v int")
    got = distinct_counts(
        df, "k", distinct={"n1": "c1", "n2": "c2"}, sums={"total": "v"}, rows="n"
    ).select("k", "n", "n1", "n2", "total")
    want = df.groupBy("k").agg(
        F.count("*"), F.countDistinct("c1"), F.countDistinct("c2"), F.sum("v")
    )
    assert rows(got) == rows(want)


def test_any_values_skip_nulls(frame, rows):
    df = frame("k string, a string, b int", ("x", None, 2), ("x", "v", None), ("y", None, None))
    assert rows(any_values(df, "k", columns=["a", "b"])) == [("x", "v", 2), ("y", None, None)]


def test_sums_of_decimals_do_not_depend_on_the_order(spark):
    values = [(0.1,), (1e9,), (-1e9,), (0.2,), (0.3,)] * 50
    sums = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame(values, "v double").repartition(7)
        sums.add(df.agg(F.sum(F.col("v").cast("decimal(24,6)"))).first()[0])
    assert len(sums) == 1
