"""Reports and set operations."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maillage.operators.quality import ambiguous_keys, duplicates, malformed_codes, reconcile
from maillage.operators.sets import key_difference, stack, union_distinct
from tests.conftest import SESSION

KEYS = st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=12)


def tables(left, right):
    return (
        SESSION.createDataFrame([(k, i) for i, k in enumerate(left)], "lk string, li int"),
        SESSION.createDataFrame([(k, i) for i, k in enumerate(right)], "rk string, ri int"),
    )


@settings(max_examples=8, deadline=None)
@given(KEYS, KEYS)
def test_reconcile_is_the_full_join_without_matches(left, right):
    a, b = tables(left, right)
    full = a.join(b, F.col("lk") == F.col("rk"), "full")
    want = full.where(F.col("lk").isNull() | F.col("rk").isNull())
    assert sorted(map(str, reconcile(a, "lk", b, "rk").collect())) == sorted(map(str, want.collect()))


@settings(max_examples=5, deadline=None)
@given(KEYS, KEYS)
def test_key_difference_is_the_set_difference(left, right):
    a, b = tables(left, right)
    got = [r[0] for r in key_difference(a, "lk", b, "rk").collect()]
    assert len(got) == len(set(got)) and set(got) == set(left) - set(right)


def test_union_distinct_is_positional_and_idempotent(frame, rows):
    a = frame("x string, y int", ("a", 1), ("a", 1), (None, 2))
    b = frame("u string, v int", ("a", 1), ("b", 3))
    once = union_distinct(a, b)
    assert rows(once) == [(None, 2), ("a", 1), ("b", 3)]
    assert rows(union_distinct(once, b)) == rows(once)


def test_stack_goes_by_name_and_keeps_repetitions(frame, rows):
    a = frame("x string, y int", ("a", 1))
    b = frame("y int, x string", (1, "a"), (2, "b"))
    assert rows(stack(a, b, a)) == [("a", 1), ("a", 1), ("a", 1), ("b", 2)]


def test_duplicates_ignore_null(frame, rows):
    df = frame("k string", ("a",), ("a",), ("b",), (None,), (None,))
    assert rows(duplicates(df, "k")) == [("a", 2)]


def test_ambiguous_keys_repeat_on_both_sides(frame, rows):
    left = frame("l string", ("a",), ("a",), ("b",), ("b",), ("c",))
    right = frame("r string", ("a",), ("a",), ("a",), ("b",), ("c",), ("c",))
    assert rows(ambiguous_keys(left, "l", right, "r")) == [("a", 2, "a", 3)]


def test_malformed_codes(frame, rows):
    df = frame("c string", ("57000",), ("5700",), ("570000",), ("681180 ",), (None,))
    assert rows(malformed_codes(df, "c")) == [("5700",), ("570000",), ("681180 ",)]
