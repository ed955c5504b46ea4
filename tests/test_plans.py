"""What the physical plans may and may not contain, and results against SQL."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.check import compare, connect
from harness.oracles import ORACLES
from harness.registry import QUERIES
from maillage.operators.lookup import spread_join

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def plan(spark, key):
    return QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_agrees_with_sql(spark, con, key):
    assert key in ORACLES
    assert compare(spark, con, key, SF) == ""


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_and_no_products(spark, key):
    text = plan(spark, key)
    for node in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "ind_carpool_areas")
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_returnflag:string>" in text


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookups_prune_columns_and_push_filters(spark, how):
    """Columns and filters asked for after a lookup reach the scan below it."""
    lineitem, part = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "part"))
    take = {"size": F.col("p_size")} if how in ("left", "inner") else None
    keys = [(F.col("l_partkey"), F.col("p_partkey"))]
    joined = spread_join(lineitem, part, keys=keys, take=take, how=how)
    text = joined.where("l_quantity > 49").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(l_quantity,49.0\)", text)


def test_only_lines_of_first_splits_are_joined(spark, tmp_path):
    from maillage.sources import preamble

    (tmp_path / "a.csv").write_text("x\nCommune;n\n1;2\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = preamble.read_after_header(spark, f"{tmp_path}/a.csv", T.StructType.fromDDL("c string, n int"))
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    beside = text[text.rindex("FileScan") - 1500 :]
    assert "Union" in text and "Exchange" not in beside[beside.rindex("Project") :]


def test_facts_are_counted_before_the_join(spark):
    """The fact side of the flagship's join is an aggregate."""
    text = plan(spark, "layout_short")
    facts = text[: text.index("orders.parquet")].splitlines()
    joins = [i for i, line in enumerate(facts) if "Join" in line]
    after = facts[joins[-1] :]
    assert any("HashAggregate" in line for line in after)


def test_large_dimensions_are_not_broadcast(spark):
    """Nothing is forced: without a size under the threshold there is no broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("layout_complete", "ind_association_density", "located_media"):
            assert "BroadcastHashJoin" not in plan(spark, key)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["dept", "id_epci", "nom_epci", "id_indicator", "valeur_brute"]
    assert df.count() > 0
    # The optional part adds queries, some of which SQL cannot express.
    assert set(QUERIES) == set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
