"""Shared helpers: word arrays of Arrow batches, shipping, checkpoints, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about this many bytes, so that a worker's memory
#: does not follow the size of the Arrow batches.
SLICE_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package: sent as a zip file, once a session. In local
    mode, workers find it where the driver did."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        root = str(package.parent)
        paths = context.environment.get("PYTHONPATH", "").split(":")
        if root not in paths:
            context.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
        return
    name = f"{package.name}-{context.applicationId}.zip"
    if name not in context._python_includes:
        path = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / name
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))


def send_file(spark: SparkSession, path: str) -> str:
    """Sends a file of the driver to all executors; the name that `received` finds it by."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def received(name: str) -> str:
    """Where a sent file lies on this machine."""
    return SparkFiles.get(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only in local mode (tests), where the session names
    none, a temporary one is made and set."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="maillage-")
        context.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder as Parquet and read again: cuts lineage,
    survives lost executors, and is compressed."""
    path = f"{shared_dir(df.sparkSession)}/maillage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no slice has over `limit` bytes in `column`, or it has one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start, total = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total + size > limit and i > start:
            ends.append((start, i))
            start, total = i, 0
        total += size
    if len(sizes):
        ends.append((start, len(sizes)))
    for a, b in ends:
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # workers live on; what they keep adds up


#: Keys with more than this share of all rows are dealt over several join keys.
SHARE = 4096


def joined_back(rows: DataFrame, found: DataFrame, key: str, copies: DataFrame) -> DataFrame:
    """Rows with the columns of `found`, which has one row for a key, or nulls. copies:
    (key, copies), the number of rows of each key.

    A key with over a SHARE-th of all rows (so fewer than SHARE keys) is dealt over as many
    join keys as it has such shares, and its row of `found` is repeated for each."""
    most = copies.agg(F.ceil(F.sum("copies") / SHARE)).first()[0] or 1
    hot = stored(copies.where(F.col("copies") > most).select(key, F.ceil(F.col("copies") / most).cast("int").alias("_parts")))
    few = F.broadcast(hot)  # fewer than SHARE rows, by the bound above
    left = rows.join(few, key, "left").withColumn("_part", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    right = found.join(few, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, [key, "_part"], "left").drop("_part")


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of an array of texts (null: none).

    flat: all words as one Arrow array; offsets: word range of each text."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        offsets = lists.offsets.to_numpy()
        full = pc.greater(pc.binary_length(flat), 0)
        kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
        self.flat = flat.filter(full)
        self.offsets = kept[offsets - offsets[0]].astype(np.int64)

    def coded(self) -> tuple[pa.Array, np.ndarray]:
        """Different words, and for each word its place among them."""
        found = self.flat.dictionary_encode()
        return found.dictionary, found.indices.to_numpy(zero_copy_only=False)

    def joined(self) -> pa.Array:
        """Each text's words joined by one space."""
        lists = pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), self.flat.cast(pa.string()))
        return pc.binary_join(lists, " ").cast(pa.large_string())


def joined_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of strings without nulls in a row, and their sizes."""
    values = values.cast(pa.large_binary())
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[ends[0] : ends[-1]], np.diff(ends)


def taken(items: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """For each range of codes between offsets, the joined runs of items they stand for."""
    each = lengths[codes]
    ends = np.cumsum(each)
    found = items[np.repeat(starts[codes] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.concatenate(([0], ends))[offsets].tolist()
    return [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


def gathered(parts: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """For each range of codes between offsets, the joined parts (4-byte items) they stand for."""
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    return taken(np.frombuffer(b"".join(parts), dtype="<u4"), np.cumsum(lengths) - lengths, lengths, codes, offsets)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) with a > b: rows (node, root), root being the
    smallest node reachable.

    Large-star and small-star in turn until the edges stay the same; each step groups
    edges by node, takes a minimum (summed up before the shuffle) and joins it back by an
    equi-join whose skewed side Spark can split. The number of rounds grows with the
    logarithm of the longest path."""

    def star(sym: DataFrame) -> DataFrame:
        least = sym.groupBy("u").agg(F.min("v").alias("m"))
        return sym.join(least, "u")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(edges.select("a", "b").distinct())
    before = mark(edges)
    while before[0]:
        ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
        both = edges.select(F.explode(ends).alias("e")).select("e.u", "e.v")
        large = star(both).where("v > u").select(F.col("v").alias("a"), F.least("m", "u").alias("b")).distinct()
        down = star(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        ends = F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))
        small = down.select(F.explode(ends).alias("e")).select("e.a", "e.b").where("a > b").distinct()
        edges = stored(small)
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
