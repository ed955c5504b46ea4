"""Cleaning of codes, numbers and texts."""

import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maillage.functions import codes, numbers, text


def one(spark, column, *values, ddl="v string"):
    """The column over one-value rows, in the order of the values."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(column.alias("x")).collect()]


V = F.col("v")


def test_postcode_repair_removes_every_dot_zero_and_never_cuts(spark):
    got = one(spark, codes.repair_postcode(V), "1400.0", "75050.05", "570000", "1400", None, "")
    assert got == ["01400", "750505", "570000", "01400", None, "00000"]


def test_postcode_repair_of_a_float_column(spark):
    assert one(spark, codes.repair_postcode(V), 1400.0, 75056.0, ddl="v double") == ["01400", "75056"]


def test_pad_code_leaves_longer_codes(spark):
    assert one(spark, codes.pad_code(V, 5), "1", "123456", None) == ["00001", "123456", None]


def test_null_markers_stay_null_through_the_repair(spark):
    values = (" nan ", "0", "0.0", "", "INSEE", "commune", "<NA>", "1400.0", None)
    got = one(spark, codes.clean_code(V), *values)
    assert got == [None] * 7 + ["01400", None]


def test_first_token(spark):
    assert one(spark, codes.first_token(V), "75012 PARIS CEDEX", "75012", None) == [
        "75012",
        "75012",
        None,
    ]


def test_no_grouping_filter_drops_sentinel_and_null(spark):
    df = spark.createDataFrame([("200",), ("ZZZZZZZZZ",), (None,)], "v string")
    assert [r[0] for r in df.where(codes.in_grouping(V)).collect()] == ["200"]


def test_map_values_is_exact(spark):
    got = one(spark, codes.map_values(V, {"57": "57050", "681180 ": "68118"}), "57", "681180 ",
              "681180", "5700", None)
    assert got == ["57050", "68118", "681180", "5700", None]


def test_null_where_matches_covers_all_text_columns(spark):
    df = spark.createDataFrame(
        [("N/A - secret", "1", 1), ("0", "N/A", 2), (None, "not N/A", 3)], "a string, b string, n int"
    )
    for cleaned in (codes.null_where_matches(df, "^N/A.*"), codes.null_where_starts(df)):
        got = [tuple(r) for r in cleaned.orderBy("n").collect()]
        assert got == [(None, "1", 1), ("0", None, 2), (None, "not N/A", 3)]


def test_integers_round_instead_of_vanishing(spark):
    got = one(spark, numbers.to_int(V), "12.7", "12.5", "-12.5", "12", "x", None, "99999999999")
    assert got == [13, 13, -13, 12, None, None, None]


def test_to_int_agrees_with_sql_try_cast(spark):
    values = [f"{random.Random(i).uniform(-5000, 5000):.1f}" for i in range(2000)]
    want = [
        duckdb.execute("SELECT TRY_CAST(? AS INTEGER)", [v]).fetchone()[0] for v in values
    ]
    assert one(spark, numbers.to_int(V), *values) == want


def test_spaced_numbers(spark):
    got = one(spark, numbers.spaced_number(V), "12 345", "1 234 567", "", "n.d.", None, "0")
    assert got == [12345.0, 1234567.0, None, None, None, 0.0]
    assert one(spark, numbers.spaced_number(V, "int"), "12 345", "x") == [12345, None]


def test_comma_numbers(spark):
    assert one(spark, numbers.comma_number(V), "12,5", "3,5 %", "7", "-", None) == [
        12.5,
        3.5,
        7.0,
        None,
        None,
    ]


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_rounding_agrees_with_sql(spark, digits):
    rng = random.Random(digits)
    values = [rng.uniform(-1000, 1000) for _ in range(4000)]
    values += [1.005, 0.285, -1.005, 2.5, 0.5, -0.5, 0.15, 1e15 + 0.5, 0.49999999999999994]
    want = [
        duckdb.execute(f"SELECT ROUND(CAST(? AS DOUBLE), {digits})", [v]).fetchone()[0]
        for v in values
    ]
    assert one(spark, numbers.round_half(V, digits), *values, ddl="v double") == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=50))
def test_rounding_moves_by_less_than_half_a_unit(spark, values):
    for value, got in zip(values, one(spark, numbers.round_half(V, 2), *values, ddl="v double")):
        assert abs(got - value) <= 0.005 + abs(value) * 1e-15


def test_rounding_keeps_null_nan_and_infinity(spark):
    got = one(spark, numbers.round_half(V, 2), None, float("inf"), float("nan"), ddl="v double")
    assert got[0] is None and got[1] == float("inf") and got[2] != got[2]


def test_ratio(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2), (0, 0)], "n int, d int")
    value = numbers.ratio(F.col("n"), F.col("d"), scale=100, digits=2)
    assert [r[0] for r in df.select(value).collect()] == [33.33, None, None, None]


def test_ratio_of_decimals_is_a_double(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(24,6)) n, CAST(3 AS DECIMAL(24,6)) d")
    assert df.select(numbers.ratio(F.col("n"), F.col("d")).alias("v")).first().v == 1 / 3


def test_link_texts_do_not_span_lines(spark):
    page = '<a href="#">A (X)</a> <a href="#">B</a>\n<a href="/no">C</a><a href="#">D\n</a>'
    assert one(spark, text.link_texts(V), page) == [["A (X)", "B"]]


def test_name_and_city_uses_the_last_parenthesis(spark):
    values = ("Le Mag (Paris)", "Radio (FM) (Lyon)", "Sans ville", " A  ( B )", "X(Y)", "Z (a) b")
    name, city = text.name_and_city(V)
    assert one(spark, name, *values) == ["Le Mag", "Radio (FM)", "Sans ville", "A", "X(Y)", "Z (a) b"]
    assert one(spark, city, *values) == ["Paris", "Lyon", "Inconnue", "B", "Inconnue", "Inconnue"]


def test_year_in(spark):
    assert one(spark, text.year_in(V), "APL 2023", "APL_2021_2022", "n° 123", None) == [
        2023,
        2021,
        None,
        None,
    ]


def test_contains_any(spark):
    got = one(spark, text.contains_any(V, ("Commune", "Code")), "Code postal", "commune", "Commune")
    assert got == [True, False, True]


def test_foreign_suffixes_are_no_numbers(spark):
    values = ["12d", "1f", "0x1p3", "1D", "12", " 3.5 ", "1e3", None]
    want = [None, None, None, None, 12.0, 3.5, 1000.0, None]
    assert one(spark, numbers.to_double(V), *values) == want
    assert one(spark, numbers.comma_number(V), "12d", "1,5 %") == [None, 1.5]
    assert one(spark, numbers.spaced_number(V), "1 2f", "1 2") == [None, 12.0]
    assert one(spark, numbers.to_double(V), "Infinity", "-inf") == [float("inf"), float("-inf")]


def test_measures_keep_digits_and_refuse_what_does_not_fit(spark):
    got = one(spark, numbers.to_measure(V), "10000000000000000000", "0.1234567", "x", "1d", None)
    assert [None if v is None else float(v) for v in got] == [1e19, 0.1234567, None, None, None]
    with pytest.raises(Exception, match="does not fit"):
        one(spark, numbers.to_measure(V), "1e25")
    assert one(spark, numbers.to_measure(V, "decimal(38,2)"), "1e25") == [10**25]
