"""Lookups: fill, match, keep and drop rows by another table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.operators.rollup import any_values


#: A key is hot if more than this share of all facts have it; so fewer keys than that are.
HOT_SHARE = 1000


def splits_skew(spark: SparkSession) -> bool:
    """Whether the session's adaptive execution splits skewed joins."""
    on = lambda name: spark.conf.get(name, "true").lower() == "true"
    return on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")


def hot_keys(facts: DataFrame, keys: Sequence[Column], share: int = HOT_SHARE) -> DataFrame:
    """Keys that over a ``share``-th of the facts have, as ``_hot0, _hot1, ...``, and in how
    many parts they are to be dealt (``_parts``). Fewer than ``share`` rows.

    The counts are summed up before the shuffle and come from one pass over the facts'
    keys, all of them; nothing is sampled.
    """
    names = [f"_hot{i}" for i in range(len(keys))]
    known = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    counts = facts.where(known).select(*[k.alias(n) for n, k in zip(names, keys)]).groupBy(*names).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    most = max(-(-total // share), 1)
    return counts.where(F.col("_n") > most).select(*names, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))


def salted(
    left: DataFrame, right: DataFrame, names: Sequence[str], share: int = HOT_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``names`` with ``_salt``, a further join key: rows of a hot key
    are dealt over its parts on the left and repeated for each part on the right."""
    hot = hot_keys(left, [F.col(n) for n in names], share)
    match = [f"_hot{i}" for i in range(len(names))]
    few = F.broadcast(hot.withColumnsRenamed(dict(zip(match, names))))  # fewer than `share` rows
    part = F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int")
    dealt = left.join(few, list(names), "left").withColumn("_salt", F.coalesce(part, F.lit(0)))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    repeated = right.join(few, list(names), "left").withColumn("_salt", every)
    return dealt.drop("_parts"), repeated.drop("_parts")


def spread_join(
    facts: DataFrame,
    table: DataFrame,
    *,
    keys: Sequence[tuple[Column, Column]],
    take: Mapping[str, Column] | None = None,
    needed: Column | None = None,
    how: str = "left",
    deal: Sequence[str] = (),
) -> DataFrame:
    """Equi join of facts with a table (left, inner, left_semi or left_anti) that no
    single key can pile up in one task. Adds the table's ``take`` columns.

    A hash of the keys is a second join column. It keeps the join from reusing the
    partitioning of an aggregated table: both sides come straight out of a shuffle, the
    form in which the adaptive skew join can split a key that many facts share, the null
    key included. (A constant would not do: the optimizer takes constants out of the
    join keys.) Rows that match nothing (a null key, or ``needed`` not true) are filtered
    out where the join drops them anyway; elsewhere those of ``needed`` keep their keys'
    hash, which deals them out, and rows with null keys are dealt by ``deal``, columns of
    the facts, if given. Nothing but keys and ``deal`` is read for the join, and filters
    on the result reach the scan.

    Where the session's adaptive execution does not split skewed joins, the join does so
    itself: keys that a thousandth of the facts share are counted first, dealt over
    several tasks, and the table's rows for them repeated (``salted``).
    """
    for fact_key, table_key in keys:
        left_type = facts.select(fact_key).schema[0].dataType
        right_type = table.select(table_key).schema[0].dataType
        if left_type != right_type:
            raise TypeError(f"join keys differ in type: {left_type} and {right_type}")
    names = [f"_key{i}" for i in range(len(keys))]
    wanted = reduce(lambda a, b: a & b, [k.isNotNull() for k, _ in keys])
    if needed is not None:
        wanted = wanted & F.coalesce(needed, F.lit(False))
    if how in ("inner", "left_semi"):
        facts = facts.where(wanted)
    hashed = F.xxhash64(*[k for k, _ in keys], *[F.when(~wanted, F.col(c)) for c in deal])
    own = F.xxhash64(*[k for k, _ in keys])
    left = facts.select(
        "*",
        *[
            (k if needed is None else F.when(wanted, k)).alias(n)
            for n, (k, _) in zip(names, keys)
        ],
        (F.when(wanted, own).otherwise(hashed) if deal else own).alias("_deal"),
    )
    right = table.select(
        *[k.alias(n) for n, (_, k) in zip(names, keys)],
        F.xxhash64(*[k for _, k in keys]).alias("_deal"),
        *[c.alias(n) for n, c in (take or {}).items()],
    )
    if splits_skew(facts.sparkSession):
        return left.join(right, [*names, "_deal"], how).drop(*names, "_deal")
    left, right = salted(left, right, names)
    return left.join(right, [*names, "_deal", "_salt"], how).drop(*names, "_deal", "_salt").select(
        *facts.columns, *(take or {})
    )


def first_match(table: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key with its smallest value. File order plays no part."""
    known = table.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    return any_values(known, key, columns=[value])


def fill_missing(
    facts: DataFrame,
    lookup: DataFrame,
    *,
    key: tuple[str, str],
    target: str,
    value: str,
    missing: Column,
    keep_unmatched: bool = False,
    bypass: bool = False,
) -> DataFrame:
    """Replace ``target`` where ``missing`` holds by the first match of the key.

    ``key`` names the column in the facts and in the lookup. Without a match the
    target becomes null, or stays as it is with ``keep_unmatched``.

    The facts are read once. If the lookup is too large to be broadcast they are also
    shuffled once; ``bypass`` then joins only the rows that lack the value and lets the
    others pass without a shuffle, at the price of a second scan. It pays when few rows
    lack the value.
    """
    fact_key, lookup_key = key
    lacking = F.coalesce(missing, F.lit(False))
    found = spread_join(
        facts.where(lacking) if bypass else facts,
        first_match(lookup, lookup_key, value),
        keys=[(F.col(fact_key), F.col(lookup_key))],
        take={"_found": F.col(value)},
        needed=lacking,
    )
    new = F.coalesce("_found", target) if keep_unmatched else F.col("_found")
    filled = found.withColumn(target, F.when(lacking, new).otherwise(F.col(target)))
    filled = filled.drop("_found")
    return facts.where(~lacking).unionByName(filled) if bypass else filled


def match_by_name_and_prefix(
    facts: DataFrame,
    areas: DataFrame,
    *,
    name: tuple[str, str],
    code: tuple[str, str],
    take: Mapping[str, Column],
    length: int = 2,
) -> DataFrame:
    """LEFT JOIN on equal names and equal first characters of a code."""
    return spread_join(
        facts,
        areas,
        keys=[
            (F.col(name[0]), F.col(name[1])),
            (F.left(F.col(code[0]), F.lit(length)), F.left(F.col(code[1]), F.lit(length))),
        ],
        take=take,
    )


def keep_members(df: DataFrame, column: str, members: DataFrame, key: str) -> DataFrame:
    """Rows whose value occurs among the members."""
    return _by_members(df, column, members, key, "left_semi")


def drop_members(df: DataFrame, column: str, members: DataFrame, key: str) -> DataFrame:
    """Rows whose value does not occur among the members; null values are kept,
    and a null among the members empties nothing (unlike NOT IN)."""
    return _by_members(df, column, members, key, "left_anti")


def _by_members(
    df: DataFrame, column: str, members: DataFrame, key: str, how: str
) -> DataFrame:
    """Repeated members are removed before the join, on the map side already."""
    once = members.select(key).distinct()
    return spread_join(df, once, keys=[(F.col(column), F.col(key))], how=how)


def keep_by_rules(
    df: DataFrame,
    *,
    place: str,
    area: str,
    allowed: Mapping[str, str],
    special: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Disambiguate places that exist in several areas.

    A place without a rule is kept. ``allowed`` ties a place to one area;
    ``special`` gives a place a predicate of its own.
    """
    pairs = [F.lit(part) for pair in allowed.items() for part in pair]
    area_of = F.try_element_at(F.create_map(*pairs), F.col(place))
    keep = F.when(area_of.isNotNull(), F.col(area) == area_of)
    for name, predicate in (special or {}).items():
        keep = keep.when(F.col(place) == name, predicate)
    return df.where(keep.otherwise(F.lit(True)))


def keep_by_rule_table(
    df: DataFrame, rules: DataFrame, *, place: str, area: str, item: str
) -> DataFrame:
    """Disambiguate places by a table of rules, however many.

    ``rules`` has the columns place, area, only and without (arrays of items). A row at a
    place with rules is kept if one of them fits: its area is the row's, its ``only`` holds
    the row's item (null: any item), its ``without`` does not (null: none). Places without
    rules are kept, null places too. The rules of a place meet in one row first, and are
    joined once; the plan does not grow with them.
    """
    for name in ("only", "without"):
        kind = rules.schema[name].dataType.elementType
        if kind != df.schema[item].dataType:
            raise TypeError(f"items differ in type: {kind} and {df.schema[item].dataType}")
    rule = F.struct("area", "only", "without")
    of_place = rules.where(F.col("place").isNotNull()).groupBy("place").agg(F.collect_list(rule).alias("_rules"))
    met = spread_join(
        df, of_place, keys=[(F.col(place), F.col("place"))], take={"_rules": F.col("_rules")}
    )

    def fits(r: Column) -> Column:
        allowed = r["only"].isNull() | F.array_contains(r["only"], F.col(item))
        barred = r["without"].isNotNull() & F.array_contains(r["without"], F.col(item))
        return F.coalesce((r["area"] == F.col(area)) & allowed & ~F.coalesce(barred, F.lit(False)), F.lit(False))

    return met.where(F.col("_rules").isNull() | F.exists("_rules", fits)).drop("_rules")
