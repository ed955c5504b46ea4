"""Lookups: filling, matching, members and rules."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maillage.operators.lookup import (
    drop_members,
    fill_missing,
    first_match,
    hot_keys,
    keep_by_rule_table,
    keep_by_rules,
    keep_members,
    match_by_name_and_prefix,
    spread_join,
)
from tests.conftest import SESSION

MISSING = F.col("insee").isNull() | (F.col("insee") == "0")


def fill(facts, communes, **options):
    return fill_missing(
        facts,
        communes,
        key=("cp", "code_postal"),
        target="insee",
        value="code_insee",
        missing=MISSING,
        **options,
    )


@pytest.fixture
def communes(frame):
    return frame(
        "code_insee string, code_postal string, nom string",
        ("01002", "01100", "A"),
        ("01001", "01100", "B"),
        ("02001", "02100", "A"),
        ("03001", None, "C"),
    )


def test_first_match_is_the_smallest_not_the_first_in_file(communes, rows):
    assert rows(first_match(communes, "code_postal", "code_insee")) == [
        ("01100", "01001"),
        ("02100", "02001"),
    ]


def test_fill_missing(frame, communes, rows):
    facts = frame(
        "id int, insee string, cp string",
        (1, "09009", "01100"),
        (2, None, "01100"),
        (3, "0", "02100"),
        (4, None, "99999"),
        (5, None, None),
        (6, "09009", None),
    )
    assert rows(fill(facts, communes)) == [
        (1, "09009", "01100"),
        (2, "01001", "01100"),
        (3, "02001", "02100"),
        (4, None, "99999"),
        (5, None, None),
        (6, "09009", None),
    ]
    assert rows(fill(facts, communes, bypass=True)) == rows(fill(facts, communes))
    kept = rows(fill(facts, communes, keep_unmatched=True))
    assert kept[2] == (3, "02001", "02100") and kept[3] == (4, None, "99999")


def test_fill_missing_keeps_the_number_of_rows(spark, communes):
    facts = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise(F.lit("05005")).alias("insee"),
        F.lit("01100").alias("cp"),
    )
    filled = fill(facts, communes)
    assert filled.count() == 1000
    assert filled.where("insee = '01001'").count() == 334


def test_name_and_prefix_match_fans_out_and_keeps_the_rest(frame, communes, rows):
    facts = frame(
        "id int, commune string, cp string",
        (1, "A", "01999"),
        (2, "A", "02100"),
        (3, "A", "03000"),
        (4, None, "01100"),
        (5, "B", None),
    )
    both = communes.union(communes.where("code_insee = '02001'").withColumn("code_insee", F.lit("02002")))
    matched = match_by_name_and_prefix(
        facts,
        both,
        name=("commune", "nom"),
        code=("cp", "code_postal"),
        take={"insee": F.col("code_insee")},
    )
    assert rows(matched.select("id", "insee")) == [
        (1, "01002"),
        (2, "02001"),
        (2, "02002"),
        (3, None),
        (4, None),
        (5, None),
    ]


def test_members_and_nulls(frame, rows):
    df = frame("k string, n int", ("a", 1), ("b", 2), (None, 3), ("a", 4))
    members = frame("m string", ("a",), ("a",), (None,))
    assert rows(keep_members(df, "k", members, "m")) == [("a", 1), ("a", 4)]
    assert rows(drop_members(df, "k", members, "m")) == [(None, 3), ("b", 2)]


def test_join_keys_must_have_one_type(frame):
    left, right = frame("k string", ("1",)), frame("m int", (1,))
    with pytest.raises(TypeError):
        keep_members(left, "k", right, "m")


def test_rules(frame, rows):
    df = frame(
        "ville string, dep string, media string",
        ("Verdun", "55", "x"),
        ("Verdun", "09", "x"),
        ("Valence", "82", "VFM"),
        ("Valence", "26", "VFM"),
        ("Valence", "26", "autre"),
        ("Ailleurs", "01", "x"),
        (None, "01", "x"),
        ("Verdun", None, "x"),
    )
    vfm = F.col("media") == "VFM"
    kept = keep_by_rules(
        df,
        place="ville",
        area="dep",
        allowed={"Verdun": "55"},
        special={"Valence": ((F.col("dep") == "82") & vfm) | ((F.col("dep") == "26") & ~vfm)},
    )
    assert rows(kept) == [
        (None, "01", "x"),
        ("Ailleurs", "01", "x"),
        ("Valence", "26", "autre"),
        ("Valence", "82", "VFM"),
        ("Verdun", "55", "x"),
    ]


PAIRS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=10
)


@settings(max_examples=5, deadline=None)
@given(PAIRS, PAIRS)
def test_spread_join_is_the_plain_join(left, right):
    facts = SESSION.createDataFrame(left, "k string, n int")
    table = SESSION.createDataFrame(right, "t string, m int")
    same = (F.col("k") == F.col("t")) & (F.col("n") == F.col("m"))
    keys = [(F.col("k"), F.col("t")), (F.col("n"), F.col("m"))]
    for how in ("left", "inner", "left_semi", "left_anti"):
        take = {"m": F.col("m")} if how in ("left", "inner") else None
        got = spread_join(facts, table, keys=keys, take=take, how=how)
        want = facts.join(table, same, how).select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def skew_settings(spark, **changes):
    old = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    return old


def restore(spark, old):
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_skew(spark):
    """Thresholds low enough for a test-sized skew."""
    old = skew_settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    yield
    restore(spark, old)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split(spark, small_skew):
    """A key holding most facts is joined by several tasks although the table side was
    aggregated by that key."""
    facts = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    table = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") < 10, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    once = first_match(table, "k", "v")
    keys = [(F.col("k"), F.col("k"))]
    joined = spread_join(facts, once, keys=keys, take={"v": F.col("v")})
    assert "skew=true" in executed(joined.select("k", "load", "v"))
    assert joined.count() == 40_000
    assert joined.where("k = 'hot' AND v = '0'").count() == 36_000
    kept = spread_join(facts, table.select("k").distinct(), keys=keys, how="left_semi")
    assert "skew=true" in executed(kept)


def test_rows_without_lookup_are_dealt_out(spark, small_skew):
    """Rows with a null key do not meet in one partition, identical rows neither."""
    facts = spark.range(0, 8_000, 1, 64).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("n"))
    table = spark.createDataFrame([("a", "x")], "k string, v string")
    joined = spread_join(facts, table, keys=[(F.col("k"), F.col("k"))], take={"v": F.col("v")})
    per_partition = joined.groupBy(F.spark_partition_id()).count().collect()
    assert joined.count() == 8_000
    assert max(r["count"] for r in per_partition) < 4_000


@pytest.fixture
def no_adaptive(spark):
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    old = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("false", "-1", "64")):
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_keys_are_split_without_adaptive_execution(spark, no_adaptive, how):
    """The library deals a hot key over tasks itself, and joins what the plain join does."""
    facts = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
    )
    table = spark.range(0, 20_000, 2, 4).select(
        F.when(F.col("id") < 10, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    once = first_match(table, "k", "v")
    take = {"v": F.col("v")} if how in ("left", "inner") else None
    joined = spread_join(facts, once, keys=[(F.col("k"), F.col("k"))], take=take, how=how)
    plain = facts.join(once.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), how)
    assert joined.columns == ["k", "n", *(take or {})]
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.select(*joined.columns).collect()))
    if how != "left_anti":
        hot = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in hot) == 6_667 and max(r["count"] for r in hot) < 1_500


def test_hot_keys_are_counted_over_all_facts(spark):
    facts = spark.range(0, 10_000).select(F.when(F.col("id") < 5_000, 1).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"))
    got = hot_keys(facts, [F.col("a"), F.col("b")], share=100).collect()
    assert [tuple(r) for r in got] == [(1, "x", 50)]
    assert hot_keys(facts.limit(0), [F.col("a")]).count() == 0


RULES = "place string, area string, only array<string>, without array<string>"


def test_rules_from_a_table(frame, rows):
    df = frame(
        "ville string, dep string, media string",
        ("Valence", "82", "VFM"), ("Valence", "26", "VFM"), ("Valence", "26", "autre"), ("Valence", "82", "autre"),
        ("Verdun", "55", "x"), ("Verdun", "09", "x"), ("Verdun", None, "x"), ("Verdun", "55", None),
        ("Ailleurs", "01", "x"), (None, "01", "x"),
    )
    rules = frame(RULES, ("Valence", "82", ["VFM"], None), ("Valence", "26", None, ["VFM"]), ("Verdun", "55", None, None), (None, "01", None, None))
    kept = keep_by_rule_table(df, rules, place="ville", area="dep", item="media")
    assert rows(kept) == rows(df.where("ville is null or ville = 'Ailleurs' or (ville = 'Verdun' and dep = '55') or (dep = '82' and media = 'VFM') or (dep = '26' and media <> 'VFM')"))
    assert kept.columns == df.columns
    assert rows(keep_by_rule_table(df, rules.limit(0), place="ville", area="dep", item="media")) == rows(df)
    with pytest.raises(TypeError, match="items"):
        keep_by_rule_table(df.withColumn("media", F.lit(1)), rules, place="ville", area="dep", item="media")


def test_many_rules_do_not_swell_the_plan(spark, frame):
    df = spark.range(30_000).select(F.concat(F.lit("p"), F.col("id") % 15_000).alias("ville"), (F.col("id") % 3).cast("string").alias("dep"), F.lit("m").alias("media"))

    def with_rules(n):
        rules = spark.range(n).select(F.concat(F.lit("p"), "id").alias("place"), F.lit("1").alias("area"), F.lit(None).cast("array<string>").alias("only"), F.array(F.lit("z")).alias("without"))
        return keep_by_rule_table(df, rules, place="ville", area="dep", item="media")

    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    many = with_rules(10_000)
    assert abs(size(many) - size(with_rules(10))) < 50
    assert many.count() == 30_000 - df.where("cast(substring(ville, 2) as int) < 10000 and dep <> '1'").count()
