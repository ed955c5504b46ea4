"""Choice of the most recent of several yearly tables."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.functions.text import year_in
from maillage.operators.lookup import spread_join
from maillage.operators.rollup import combinations


def latest_labels(df: DataFrame, *, dataset: str, label: str) -> DataFrame:
    """Per data set the label with the highest year in it, else the smallest label.

    The choice is made among the labels, not among all rows.
    """
    year = year_in(F.col(label))
    newest = F.max(F.when(year.isNotNull(), F.struct(year.alias("year"), F.col(label))))
    labels = combinations(df, dataset, label)
    return labels.groupBy(dataset).agg(F.coalesce(newest[label], F.min(label)).alias(label))


def latest_snapshot(df: DataFrame, *, dataset: str, label: str) -> DataFrame:
    """The rows of each data set's latest label."""
    picks = latest_labels(df, dataset=dataset, label=label)
    keys = [(F.col(dataset), F.col(dataset)), (F.col(label), F.col(label))]
    return spread_join(df, picks, keys=keys, how="left_semi")


def latest_label(labels: Sequence[str]) -> str:
    """The label with the highest year in it, else the smallest."""
    dated = [(int(m[0]), label) for label in labels if (m := re.search(r"\d{4}", label))]
    return max(dated)[1] if dated else min(labels)


def sheet_of(file: str) -> tuple[str, str]:
    """Data set and sheet of a file in folders ``.../data set/sheet=label/file``."""
    folders = file.split("/")
    at = max(i for i, f in enumerate(folders) if f.startswith("sheet="))
    return "/".join(folders[:at]), folders[at].removeprefix("sheet=")


def latest_files(
    spark: SparkSession, path: str | Sequence[str], of: Callable[[str], tuple[str, str]] = sheet_of
) -> list[str]:
    """The files of each data set's latest sheet, chosen from the listing: no file is read.

    ``of`` gives a file's data set and sheet.
    """
    paths = path if isinstance(path, str) else list(path)
    # Listed files come as URIs.
    files = map(unquote, spark.read.text(paths, recursiveFileLookup=True).inputFiles())
    by_sheet: dict[str, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
    for file in files:
        dataset, sheet = of(file)
        by_sheet[dataset][sheet].append(file)
    return sorted(f for sheets in by_sheet.values() for f in sheets[latest_label(list(sheets))])


def latest_partitions(df: DataFrame, *, dataset: str, label: str, most: int = 1000) -> DataFrame:
    """The rows of each data set's latest label, for a table partitioned by both.

    The labels are partition values. Those picked stand as a filter in the plan, so that
    the files of other labels are not scanned. With over ``most`` data sets the picks are
    joined instead.
    """
    picks = latest_labels(df, dataset=dataset, label=label)
    rows = picks.limit(most + 1).collect()
    if len(rows) > most:
        return latest_snapshot(df, dataset=dataset, label=label)
    chosen = F.lit(False)
    for row in rows:
        chosen = chosen | (F.col(dataset).eqNullSafe(row[dataset]) & F.col(label).eqNullSafe(row[label]))
    return df.where(chosen)
