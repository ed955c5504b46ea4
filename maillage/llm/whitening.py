"""Operator 12: whitening of embeddings by the covariance of their different vectors.

1. Entries become integers, floor(scale * c); equal integer vectors are grouped, with their
   number of rows as multiplicity.
2. Fit: each different vector counts once, or by its multiplicity (`by`). Sums are exact
   (64-bit integers); each task centres its vectors and multiplies them by themselves
   (weighted GEMM), and the d x d products are added up by cell. The driver gets d sums and
   d x d cells and solves the symmetric eigenproblem.
3. Each different vector is whitened once: its centred entries on the first components, over
   the roots of their eigenvalues. The covariance of what came out is computed anew, centred
   by its own means, and held against the identity.
4. Results are joined back to the rows by a digest of the vector; vectors with very many
   rows are dealt over several join keys.

Rows whose vector is null, or holds null, NaN or infinite entries, are left out. Vectors of
different lengths are filled up with zeros to the longest. A null id is kept; repeated rows
come back once each; ties of eigenvalues go by the eigenvector solver's order (any basis of
their space is right). Entries beyond 64 bits after scaling take the largest 64-bit value.
Components with an eigenvalue of zero to double precision (constant or dependent
columns, a single vector) have null in `whitened`; `explained` is null if nothing varies,
`identity_error` if no component does. `deviation` is null where it exceeds 64 bits.
An empty table, or one of empty vectors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.common import joined_back, ship, stored

SCALE = 256
#: Vectors that a task multiplies at a time.
BLOCK = 4096


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return vector.isNotNull() & F.forall(F.transform(vector, lambda c: c.cast("double")), finite)


def integers(df: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """Rows (key, x) with integer vectors of one length."""
    # floor gives a 64-bit integer, which has one zero only.
    own = F.transform(df[vector], lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    rows = df.where(usable(df[vector])).select(df[key].alias("key"), own.alias("x"))
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("x")))
    return rows.withColumn("x", filled) if longest else rows.limit(0)


@dataclass(frozen=True)
class Fit:
    n: int  # fit weight in all
    sums: np.ndarray  # of each dimension, exact
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # (components, dims)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums.tolist()])

    @property
    def sound(self) -> np.ndarray:
        """Components whose eigenvalue isn't zero to double precision."""
        return self.values > max(self.values[0], 0.0) * len(self.sums) * np.finfo(float).eps if len(self.values) else np.zeros(0, dtype=bool)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def fitted(distinct: DataFrame, components: int, by: str = "one") -> Fit | None:
    """Fit over rows (x, copies); by: 'one' or 'count'."""
    if by not in ("one", "count"):
        raise ValueError(f"weights are 'one' or 'count', not {by!r}")
    weighted = distinct.select("x", (F.lit(1).cast("long") if by == "one" else F.col("copies")).alias("weight"))
    spark = distinct.sparkSession
    ship(spark)
    n = weighted.agg(F.sum("weight")).first()[0]
    if not n:
        return None
    cells = weighted.select(F.posexplode("x"), "weight").groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)") * F.col("weight")).alias("s")).collect()
    sums = np.array([int(r["s"]) for r in sorted(cells, key=lambda r: r["pos"])], dtype=object)
    d = len(sums)
    mean = np.array([int(s) / n for s in sums])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x, w = matrix(batch.column("x")), batch.column("weight").to_numpy()
            for at in range(0, len(x), BLOCK):
                centred = x[at : at + BLOCK] - mean
                total += (centred * w[at : at + BLOCK, None]).T @ centred
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j), pa.array(total[i, j])], ["cell", "s"])

    rows = weighted.mapInArrow(multiply, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    covariance = np.zeros((d, d))
    for r in rows:
        covariance[r["cell"] // d, r["cell"] % d] = r["s"] / n
    covariance += np.triu(covariance, 1).T
    values, vectors = np.linalg.eigh(covariance)
    first = np.argsort(values)[::-1][:components]
    return Fit(int(n), sums, float(np.trace(covariance)), values[first], vectors[:, first].T)


def projected(distinct: DataFrame, fit: Fit) -> DataFrame:
    """Rows (digest, deviation, w): of each different vector its squared distance from the mean
    times n squared, exactly, and its whitened components."""
    n, sums, mean = fit.n, [int(s) for s in fit.sums], fit.mean
    sound = fit.sound
    down = np.where(sound[:, None], fit.vectors, 0.0) / np.sqrt(np.where(sound, fit.values, 1.0))[:, None]
    whole = np.array(sums, dtype=object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"))
            far = float(np.abs(x).max(initial=0)) * n + max(abs(s) for s in sums)
            if far < 2.0**62 and far * far * len(sums) < 2.0**62:
                away = n * x - np.array(sums, dtype=np.int64)
                deviation = (away * away).sum(axis=1).tolist()
            else:  # Python's integers
                away = n * x.astype(object) - whole
                deviation = [v if v < 1 << 63 else None for v in (away * away).sum(axis=1)]
            w = (x - mean) @ down.T
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(deviation, pa.int64()), lists], ["digest", "deviation", "w"])

    return distinct.select("digest", "x").mapInArrow(work, "digest binary, deviation long, w array<double>")


def identity_error(whitened: DataFrame, fit: Fit, by: str) -> float | None:
    """Largest entry, in absolute value, of the covariance of w minus the identity."""
    use = np.flatnonzero(fit.sound).tolist()
    if not use:
        return None
    weight = F.lit(1) if by == "one" else F.col("copies")
    w = [F.col("w")[k] for k in use]
    means = whitened.agg(*(F.sum(c * weight) / fit.n for c in w)).first()
    pairs = [(i, j) for i in range(len(use)) for j in range(i + 1)]
    row = whitened.agg(*(F.sum((w[i] - means[i]) * (w[j] - means[j]) * weight) / fit.n for i, j in pairs)).first()
    return float(max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs, strict=True)))


def whitened(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 4, by: str = "one", scale: int = SCALE) -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error), components
    from 1, of all rows with a usable vector."""
    rows = stored(integers(df, vector, key, scale).withColumn("digest", F.unhex(F.sha2(F.array_join("x", ","), 256))))
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies"), F.first("digest").alias("digest")))
    kind = rows.schema["key"].dataType.simpleString()
    fit = fitted(distinct, components, by)
    if fit is None:
        empty = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], empty)
    found = stored(projected(distinct, fit).join(distinct.select("digest", "copies"), "digest"))
    error = identity_error(found, fit, by)
    sound = fit.sound.tolist()
    shares = [float(v) / fit.trace if fit.trace > 0 else None for v in fit.values]
    number = lambda v: F.lit(v).cast("double")
    of = [
        F.struct(
            F.lit(k + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), F.col("deviation"),
            (F.col("w")[k] if sound[k] else number(None)).alias("whitened"), number(shares[k]).alias("explained"), number(error).alias("identity_error"),
        )
        for k in range(len(fit.values))
    ]
    back = joined_back(rows.select("key", "digest"), found.select("digest", "deviation", "w"), "digest", distinct.select("digest", "copies"))
    return back.select(F.col("key").alias(key), F.explode(F.array(*of)).alias("c")).select(key, "c.*")
