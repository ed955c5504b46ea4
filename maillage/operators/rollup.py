"""Aggregation from facts to small areas to groupings of areas.

Facts are always summed up per area before any join: the partial aggregation on the
map side then absorbs an area that holds a large share of the rows, and the join
sees one row per area.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.functions.numbers import ratio, to_int


def totals_by(facts: DataFrame, *keys: str, **measures: Column) -> DataFrame:
    """One row per key combination with the named aggregates."""
    return facts.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def roll_up(
    members: DataFrame,
    per_area: DataFrame,
    *,
    area: str,
    group: str,
    sums: Sequence[str],
) -> DataFrame:
    """Members LEFT JOIN per-area totals, then SUM per group.

    A group without any fact gets null, not zero. ``sums`` may name columns of
    either side, so numerator and denominator come out of one aggregation.
    """
    joined = members.join(per_area, area, "left")
    return joined.groupBy(group).agg(*[F.sum(c).alias(c) for c in sums])


def mean_per_group(
    members: DataFrame, facts: DataFrame, *, area: str, group: str, measure: str
) -> DataFrame:
    """Sum and non-null count per group; their ratio is AVG over the joined rows.

    Kept as two columns so that groups can be merged further without averaging means.
    """
    per_area = totals_by(facts, area, total=F.sum(measure), n=F.count(measure))
    return roll_up(members, per_area, area=area, group=group, sums=["total", "n"])


def mean_per_year(facts: DataFrame, *, key: str, year: str, measure: str) -> DataFrame:
    """SUM(measure) / COUNT(DISTINCT year) per key.

    Grouping by (key, year) first leaves at most one row per year and key, so the
    distinct count is a plain count and a hot key is spread over its years.
    """
    by_year = totals_by(facts, key, year, total=F.sum(measure))
    both = totals_by(by_year, key, total=F.sum("total"), n_years=F.count(year))
    return both.select(key, ratio(F.col("total"), F.col("n_years")).alias("mean_per_year"))


def matched_counts(
    facts: DataFrame,
    members: DataFrame,
    *,
    key: str,
    group: str,
    count: str = "n",
    dedupe: bool = False,
) -> DataFrame:
    """COUNT per group over the many-to-many join of facts and members on ``key``.

    Both sides are counted per key first and the counts multiplied, so the pairs are
    never formed. By default a fact counts once per member sharing its key;
    ``dedupe`` lets every fact count once, for the smallest group of its key.
    """
    facts_per_key = totals_by(facts.where(F.col(key).isNotNull()), key, _facts=F.count(F.lit(1)))
    if dedupe:
        members_per_key = totals_by(members, key, **{group: F.min(group)}).withColumn(
            "_members", F.lit(1)
        )
    else:
        members_per_key = totals_by(members, key, group, _members=F.count(F.lit(1)))
    pairs = facts_per_key.join(members_per_key, key)
    return pairs.groupBy(group).agg(F.sum(F.col("_facts") * F.col("_members")).alias(count))


def presence_score(
    facts: DataFrame,
    members: DataFrame,
    *,
    area: str,
    group: str,
    categories: Sequence[str],
    score: str = "valeur_brute",
) -> DataFrame:
    """Number of categories whose sum per group is above zero.

    Categories come as text; what is no number counts as nothing.
    """
    per_area = totals_by(facts, area, **{c: F.sum(to_int(F.col(c))) for c in categories})
    per_group = members.join(per_area, area).groupBy(group).agg(
        *[F.sum(c).alias(c) for c in categories]
    )
    present = [F.when(F.col(c) > 0, F.lit(1)).otherwise(F.lit(0)) for c in categories]
    return per_group.select(group, reduce(lambda a, b: a + b, present).cast("long").alias(score))


def distinct_counts(
    df: DataFrame,
    *keys: str,
    distinct: dict[str, str],
    sums: dict[str, str] | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Several COUNT(DISTINCT column) next to sums and a row count.

    Spark multiplies the rows by the number of distinct columns. Collapsing to the
    combinations that occur first means that only those are multiplied.
    """
    sums = sums or {}
    inner = {f"_s_{n}": F.sum(c) for n, c in sums.items()}
    combos = totals_by(df, *keys, *distinct.values(), _rows=F.count(F.lit(1)), **inner)
    outer = {n: F.countDistinct(c) for n, c in distinct.items()}
    outer |= {n: F.sum(f"_s_{n}") for n in sums}
    if rows:
        outer = {rows: F.sum("_rows")} | outer
    return totals_by(combos, *keys, **outer)


def combinations(df: DataFrame, *columns: str) -> DataFrame:
    """The combinations that occur, found by hashing.

    A plain ``distinct`` below a minimum or maximum is taken out by the optimizer, and
    those of strings and structs then sort all rows. The count is there to keep the
    two steps apart.
    """
    counted = totals_by(df, *columns, _rows=F.count(F.lit(1)))
    return counted.where(F.col("_rows") > 0).drop("_rows")


def any_values(df: DataFrame, *keys: str, columns: Sequence[str]) -> DataFrame:
    """Some non-null value of each column per key; the smallest one, so that two runs
    over the same rows agree. Meant for columns that depend on the key and so take few
    values."""
    return totals_by(combinations(df, *keys, *columns), *keys, **{c: F.min(c) for c in columns})
