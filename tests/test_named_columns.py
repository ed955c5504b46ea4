"""Columns found by header names, stacked files, newest sheets."""

import pytest
from pyspark.sql import functions as F

from maillage.sources import named, snapshots
from tests.test_sources_and_sinks import put

COLUMNS = {"code": "string", "apl": "double"}


def test_each_file_has_its_own_order(spark, tmp_path, rows):
    put(tmp_path / "a.csv", 'Titre;2023\n\ncode;note;"apl"\n01001;x;2.5\n01002;;\n')
    put(tmp_path / "b.csv", "apl;code\r\n1.5;02001\r\n;\"02;\"\"0\"\"\"\r\n")
    put(tmp_path / "c.csv", "﻿code;apl;code\n03001;bad;9\n")
    df = named.read_named(spark, f"{tmp_path}/*.csv", COLUMNS, keywords=("code",))
    got = df.select(F.regexp_extract("file", r"(\w)\.csv", 1), "code", "apl")
    want = [("a", "01001", 2.5), ("a", "01002", None), ("b", '02;"0"', None), ("b", "02001", 1.5), ("c", "03001", None)]
    assert sorted(rows(got), key=repr) == sorted(want, key=repr)


def test_a_missing_name_is_an_error_or_null(spark, tmp_path, rows):
    put(tmp_path / "a.csv", "code;apl\n1;2\n")
    put(tmp_path / "b.csv", "code;other\n3;4\n")
    with pytest.raises(Exception, match="no column 'apl' in .*b.csv"):
        named.read_named(spark, f"{tmp_path}/*.csv", COLUMNS).collect()
    df = named.read_named(spark, f"{tmp_path}/*.csv", COLUMNS, missing="null")
    assert rows(df.drop("file")) == [("1", 2.0), ("3", None)]
    with pytest.raises(ValueError, match="missing"):
        named.read_named(spark, f"{tmp_path}/*.csv", COLUMNS, missing="skip")


def test_a_missing_header_is_an_error(spark, tmp_path):
    put(tmp_path / "a.csv", "no;header\n1;2\n")
    with pytest.raises(Exception, match="no header in the first split of"):
        named.read_named(spark, f"{tmp_path}/a.csv", COLUMNS, keywords=("Commune",)).collect()
    with pytest.raises(Exception, match="no header in the first split of"):
        named.read_named(spark, f"{tmp_path}/a.csv", COLUMNS, skip=5).collect()


def test_windows_and_fixed_preambles(spark, tmp_path, rows):
    path = put(tmp_path / "a.csv", "apl;code\n1;a\n2;b\ncode here\n3;c\n")
    assert rows(named.read_named(spark, path, COLUMNS, keywords=("here",), window=2).drop("file")) == [(None, None), ("a", 1.0), ("b", 2.0), ("c", 3.0)]
    path = put(tmp_path / "b.csv", "x\ny\ncode;apl\n01;3.5\n", "latin-1")
    assert rows(named.read_named(spark, path, COLUMNS, skip=2, encoding="ISO-8859-1").drop("file")) == [("01", 3.5)]


@pytest.mark.parametrize("few", [0, 10_000])
def test_a_file_of_many_splits(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(named, "FEW_FILES", few)
    body = "".join(f"{i}.0;{i:05d};x\n" for i in range(20_000))
    path = put(tmp_path / "big.csv", f"Titre\napl;code;z\n{body}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    try:
        df = named.read_named(spark, path, COLUMNS, skip=1)
        got = df.agg(F.count("*"), F.sum("apl"), F.min("code"), F.countDistinct("code")).first()
        assert tuple(got) == (20_000, sum(range(20_000)), "00000", 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("headers", [3, 70])
def test_stacking_by_name(spark, tmp_path, rows, headers):
    want = []
    for i in range(headers):
        extra = "" if headers == 3 else f";extra{i}"
        order = ("code", "apl") if i % 3 == 0 else ("apl", "code") if i % 3 == 1 else ("code",)
        values = {"code": f"c{i}", "apl": f"{i}.5"}
        put(tmp_path / f"f {i}%.csv", ";".join(order) + extra + "\n" + ";".join(values[c] for c in order) + (";e" if extra else "") + "\n")
        want.append((f"c{i}", i + 0.5 if i % 3 < 2 else None))
    df = named.read_stacked(spark, f"{tmp_path}/*.csv", COLUMNS)
    assert rows(df) == sorted(want, key=lambda r: [(v is not None, v) for v in r])
    if headers == 3:
        plan = df.select("code")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan csv") == 3


def test_stacking_like_files_is_one_scan(spark, tmp_path, rows):
    for i in range(4):
        put(tmp_path / f"f{i}.csv", f"code;apl\n{i};{i}\n")
    df = named.read_stacked(spark, f"{tmp_path}/*.csv", COLUMNS)
    assert rows(df) == [(str(i), float(i)) for i in range(4)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_newest_sheets_are_chosen_from_the_listing(spark, tmp_path):
    for dataset, sheet in (("a", "APL 2021"), ("a", "APL 2023"), ("a", "notes"), ("b", "z"), ("b", "m")):
        folder = tmp_path / dataset / f"sheet={sheet}"
        folder.mkdir(parents=True)
        put(folder / "x.csv", "code;apl\n1;2\n")
    got = snapshots.latest_files(spark, str(tmp_path))
    assert [f.rsplit("/", 3)[1:3] for f in got] == [["a", "sheet=APL 2023"], ["b", "sheet=m"]]
    df = named.read_named(spark, got, COLUMNS)
    assert "2021" not in "".join(df.inputFiles()) and df.count() == 2


def test_only_newest_partitions_are_scanned(spark, tmp_path, frame, rows):
    df = frame("d string, sheet string, v int", ("a", "APL 2021", 1), ("a", "APL 2023", 2), ("b", "z", 5), ("b", "m", 6), ("b", "m", 7))
    df.write.partitionBy("d", "sheet").parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    got = snapshots.latest_partitions(table, dataset="d", label="sheet").select("d", "sheet", "v")
    assert rows(got) == [("a", "APL 2023", 2), ("b", "m", 6), ("b", "m", 7)]
    got.collect()
    node = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in node and "APL 2023" in node.split("PartitionFilters: [")[1]
    most = snapshots.latest_partitions(table, dataset="d", label="sheet", most=1).select("d", "sheet", "v")
    assert rows(most) == rows(got)
