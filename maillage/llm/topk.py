"""Operator 10: exact k nearest binary codes by incremental multi-index hashing.

Vectors become binary codes (bit j: component j is above zero); distance is the Hamming
distance. Codes are cut into SEGMENTS segments. A block of different codes keeps, for
each segment, its codes in the order of the segment's value with a directory of where
each value begins. A query looks at all values within radius 0 of its segments, then 1,
2, ...: after radius r in the first s segments and r - 1 in the others, every code within
SEGMENTS * r + s - 1 has been seen (a farther one can hide, a nearer one would have to
differ by more than that in every segment). Candidates are verified by their whole
distance; a query is done once its kth distance is within what is provably covered.

The stated queries are searched for in blocks: index rows are dealt over as many blocks
as their number asks for. A task gets a block's rows first, builds its index once and then
streams the queries through it in bundles. All queries go to the first block; the kth
distance found there bounds their search in the others, which ends as soon as all within
it is covered. The best k of each block are merged. Rows with equal codes are one entry with
their k + 1 smallest ids, summed up before they meet, so a vector that a third of all rows
have costs one entry.

The result is exact: nearest by (distance, id), a query's own row left out. Nulls: rows
with a null vector or id are left out, null components count as not above zero, vectors
of other lengths than BITS are an error. Repeated rows (one id, one vector) count once.
With fewer than k other rows all are given; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maillage.llm.common import ship, stored

BITS, SEGMENTS = 64, 4
#: Codes of an index block, queries of a bundle.
BLOCK_CODES, BUNDLE = 1 << 14, 1 << 11


def codes(df: DataFrame, vector: str = "embedding", key: str = "vec_id", bits: int = BITS) -> DataFrame:
    """Rows (key, code): bit j of the code (from the lowest) is set if component j is above zero."""
    size = F.size(vector)
    checked = F.when(size == bits, F.col(vector)).otherwise(F.raise_error(F.concat(F.lit(f"vectors need {bits} components, not "), size)))
    set_bits = F.transform(checked, lambda x, j: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(set_bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return df.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(key, code.alias("code"))


def masks(width: int, weight: int) -> np.ndarray:
    """All numbers of `width` bits with `weight` of them set."""
    return np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), weight)], dtype=np.int64)


class Block:
    """Multi-index over different codes."""

    def __init__(self, found: np.ndarray):
        self.codes, self.width = found.view(np.uint64), BITS // SEGMENTS
        self.tables = []
        for s in range(SEGMENTS):
            value = self.segment(self.codes, s)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << self.width) + 1))))
        self.masks = [masks(self.width, w) for w in range(self.width + 1)]

    def segment(self, x: np.ndarray, s: int) -> np.ndarray:
        return ((x >> np.uint64(s * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int, sizes: np.ndarray, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, code number, distance) of enough codes to hold the k nearest ids
        of each query that are within its bound. sizes: how many ids a code stands for."""
        queries = queries.view(np.uint64)
        bounds = np.full(len(queries), BITS) if bounds is None else bounds
        counts = np.zeros((len(queries), BITS + 1), dtype=np.int64)  # verified ids by distance
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        active = np.arange(len(queries))
        for radius in range(self.width + 1):
            for s in range(SEGMENTS):
                order, begins = self.tables[s]
                values = self.segment(queries[active], s)
                step = max(1, (1 << 20) // len(self.masks[radius]))
                for at in range(0, len(active), step):
                    who = active[at : at + step]
                    probes = (values[at : at + step, None] ^ self.masks[radius]).ravel()
                    low, n = begins[probes], begins[probes + 1] - begins[probes]
                    hit = np.flatnonzero(n)
                    low, n = low[hit], n[hit]
                    ends = np.cumsum(n)
                    place = np.repeat(low - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
                    code, query = order[place], np.repeat(who[hit // len(self.masks[radius])], n)
                    other = self.codes[code] ^ queries[query]
                    # A code is met in several segments: it counts where it is met first.
                    new = np.ones(len(code), dtype=bool)
                    for t in range(SEGMENTS):
                        if t != s:
                            apart = np.bitwise_count(self.segment(other, t).astype(np.uint64))
                            new &= (apart > radius) | ((apart == radius) & (t > s))
                    code, query, other = code[new], query[new], other[new]
                    apart = np.bitwise_count(other).astype(np.int64)
                    np.add.at(counts, (query, apart), sizes[code])
                    found.append((query, code, apart))
                covered = SEGMENTS * radius + s
                done = (counts[active, : covered + 1].sum(axis=1) >= k) | (bounds[active] <= covered)
                active = active[~done]
                if not len(active):
                    break
            if not len(active):
                break
        query, code, apart = map(np.concatenate, zip(*found, strict=True))
        # The kth distance of each query; farther codes are not needed.
        reach = np.argmax(np.cumsum(counts, axis=1) >= np.minimum(k, counts.sum(axis=1))[:, None], axis=1)
        keep = apart <= np.minimum(reach, bounds)[query]
        return query[keep], code[keep], apart[keep]


def nearest(index: DataFrame, queries: DataFrame, k: int, key: str = "vec_id") -> DataFrame:
    """Rows (query_id, rank, key, distance): the k nearest rows of `index` (key, code) for
    each of `queries` (key, code), by distance and id, without the query itself."""
    ship(index.sparkSession)
    # Equal codes: one entry with its k + 1 smallest ids (enough if one is the query's own).
    smallest = Window.partitionBy("code").orderBy(key)
    entries = index.distinct().withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1)
    entries = stored(entries.groupBy("code").agg(F.sort_array(F.collect_list(key)).alias("ids")))
    blocks = max(1, -(-entries.count() // BLOCK_CODES))
    entries = entries.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
    asked = queries.select("code").distinct()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows, built, ids, sizes = None, [], None, None, None
        for frame in frames:
            for block, part in frame.groupby("block", sort=True):
                if block != at:
                    at, rows, built = block, [], None
                if (part["kind"] == 0).any():
                    rows.append(part.loc[part["kind"] == 0, ["code", "ids"]])
                wanted = part[part["kind"] == 1]
                if not len(wanted) or not rows:
                    continue
                if built is None:
                    whole = pd.concat(rows, ignore_index=True)
                    built, ids = Block(whole["code"].to_numpy()), whole["ids"].to_numpy()
                    sizes = whole["ids"].map(len).to_numpy()
                for low in range(0, len(wanted), BUNDLE):
                    some = wanted.iloc[low : low + BUNDLE]
                    query = some["code"].to_numpy()
                    who, code, apart = built.search(query, k + 1, sizes, some["reach"].to_numpy())
                    found = pd.DataFrame({"code": query[who], "near": [ids[c] for c in code], "distance": apart})
                    found = found.explode("near").astype("int64").sort_values(["code", "distance", "near"])
                    yield found.groupby("code", sort=False).head(k + 1)

    def searched(entries: DataFrame, asked: DataFrame) -> DataFrame:
        none = F.lit(None).cast(entries.schema["ids"].dataType)
        rows = entries.select("block", F.lit(0).alias("kind"), "code", "ids", F.lit(BITS).alias("reach"))
        rows = rows.union(asked.select("block", F.lit(1), "code", none, "reach"))
        return rows.repartition("block").sortWithinPartitions("block", "kind").mapInPandas(work, "code long, near long, distance int")

    best = searched(entries.where("block = 0"), asked.select(F.lit(0).alias("block"), "code", F.lit(BITS).alias("reach")))
    if blocks > 1:
        best = stored(best)
        reach = F.when(F.count("*") > k, F.max("distance")).otherwise(F.lit(BITS))
        bounded = asked.join(best.groupBy("code").agg(reach.alias("reach")), "code", "left").withColumn("reach", F.coalesce("reach", F.lit(BITS)))
        others = bounded.select(F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))).alias("block"), "code", "reach")
        best = best.union(searched(entries.where("block > 0"), others))
    first = Window.partitionBy("code").orderBy("distance", "near")
    best = best.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    of_query = queries.select(F.col(key).alias("query_id"), "code").distinct().join(best.select("code", "near", "distance"), "code").where("near <> query_id")
    rank = Window.partitionBy("query_id").orderBy("distance", "near")
    return of_query.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", F.col("near").alias(key), "distance")
