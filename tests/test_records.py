"""Line breaks within quotes, in files of many splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.sources import readers, records
from tests.test_sources_and_sinks import put

SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("a", T.StringType())])


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1KB")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def written(rows):
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="\n").writerows([("n", "a"), *rows])
    return out.getvalue()


def test_many_splits_equal_the_unsplit_read(spark, tmp_path, rows, small_splits):
    rng = random.Random(2)
    cell = lambda: "".join(rng.choice(["x", "é", " ", "\n", ";", '"', "\n\n"]) for _ in range(rng.randint(1, 60))).strip() or "y"
    want = [(i, "L" + cell() + "R") for i in range(800)] + [(900, "long " + "line\n" * 900 + "end"), (901, "last")]
    path = put(tmp_path / "q.csv", written(want))
    df = records.read_records(spark, path, SCHEMA, sep=";")
    assert records.numbered_lines(spark, path).rdd.getNumPartitions() > 10
    assert rows(df) == want
    unsplit = spark.read.schema(SCHEMA).csv(path, header=True, sep=";", multiLine=True, escape='"')
    assert rows(unsplit) == rows(df)


def test_only_malformed_records_are_dropped(spark, tmp_path, rows):
    path = put(tmp_path / "q.csv", 'n;a\n1;"a\nb"\nbad;c\n2;d\n3;e;f\n4;"g;\n\nh"\n5;"open\n6;x\n')
    good = records.read_records(spark, path, SCHEMA, sep=";", mode="DROPMALFORMED")
    assert rows(good) == [(1, "a\nb"), (2, "d"), (4, "g;\n\nh")]
    kept = records.read_records(spark, path, SCHEMA, sep=";", mode="PERMISSIVE").where(F.col(readers.CORRUPT).isNotNull())
    assert rows(kept.select(readers.CORRUPT)) == [('3;e;f',), ('5;"open\n6;x',), ("bad;c",)]
    with pytest.raises(Exception, match="malformed record"):
        records.read_records(spark, path, SCHEMA, sep=";").collect()
    with pytest.raises(ValueError, match="mode"):
        records.read_records(spark, path, SCHEMA, mode="ANY")


def test_several_files_and_none(spark, tmp_path, rows):
    put(tmp_path / "a.csv", 'n;a\n1;"x\ny"\n')
    put(tmp_path / "b.csv", 'n;a\n2;"z"\n3;\n')
    put(tmp_path / "c.csv", "n;a\n")
    assert rows(records.read_records(spark, str(tmp_path), SCHEMA, sep=";")) == [(1, "x\ny"), (2, "z"), (3, None)]
