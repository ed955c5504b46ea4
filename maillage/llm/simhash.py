"""Operator 5: SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: a bit is 1 if it is set in over half of the XXH64 hashes of a text's 3-word
shingles. Equal fingerprints are joined first; what follows works on different ones.

Links (at most `radius` differing bits) are found exactly. The 64 bits are cut into
parts, each with a threshold; if the thresholds sum up to radius - parts + 1, two
fingerprints within the radius differ in at most the threshold in some part. Bits that
are correlated over the corpus are put into the same part (so parts are as independent as
they can be), and the thresholds, which may differ from part to part, and the number of
parts come from a dynamic program over estimated numbers of probes and candidates.

Probing: a fingerprint has, for a part of threshold t, one key for each choice of t bits
of the part that are left out; two values at most t bits apart share a key. Equal keys
meet in sorted partitions, where candidates are verified by counting bits. A key's
fingerprints are compared in blocks, and only the edges of a spanning forest leave the
task, never all pairs. Components of these edges give the groups.

Nulls: a null text has no words and fingerprint zero, which links like any other; a row
with a null id gets the group of the rows with its fingerprint but never names one (null
where no row with an id has that fingerprint). Repeated rows are kept. Empty tables give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.llm.common import Words, components, ship, slices, stored

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
#: Relative costs of a probe row (shuffled and sorted) and of a compared candidate.
PROBE_COST, CANDIDATE_COST = 1.0, 0.002
#: Fingerprints of one key are compared in squares of this side.
BLOCK = 2048


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, lowest first."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprints of texts (null: no words)."""
    words = Words(pc.ascii_lower(pc.fill_null(texts, "")))
    joined = words.joined()
    data = memoryview(joined.buffers()[2]) if len(words.flat) else b""
    counts = np.diff(words.offsets)
    sizes = pc.binary_length(words.flat).to_numpy(zero_copy_only=False).astype(np.int64)
    base = joined.buffers() and np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined)]
    # Where each word starts in the joined texts: all words and spaces of its text before it.
    before = np.cumsum(sizes + 1) - sizes - 1
    first = before[np.minimum(words.offsets[:-1], len(sizes) - 1)] if len(sizes) else np.zeros(len(counts), dtype=np.int64)
    starts = before + np.repeat(np.asarray(base) - first, counts)
    shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    ends = np.cumsum(shingles)
    nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - shingles, shingles)
    begin = np.repeat(words.offsets[:-1], shingles) + nth
    last = begin + np.repeat(np.minimum(counts, shingle), shingles) - 1
    out = np.zeros(len(counts), dtype=np.uint64)
    if not len(begin):
        return out
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[begin].tolist(), (starts[last] + sizes[last]).tolist(), strict=True)
    hashes = np.fromiter((digest(data[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(begin))
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    full = np.flatnonzero(shingles)
    totals = np.zeros((len(counts), BITS), dtype=np.int64)
    step = 1 << 16
    for at in range(0, len(hashes), step):  # bounded memory for the longest texts too
        lo, hi = np.searchsorted(ends, [at, min(at + step, len(hashes)) - 1], side="right")
        here = full[(full >= lo) & (full <= hi)]
        cuts = np.maximum(ends[here] - shingles[here] - at, 0)
        totals[here] += np.add.reduceat(_bits(hashes[at : at + step]), cuts, axis=0, dtype=np.int64)
    return ((2 * totals > shingles[:, None]).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


def fingerprints(df: DataFrame, shingle: int = SHINGLE, seed: int = SEED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, fp): the fingerprint as a signed 64-bit number."""
    ship(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = fingerprints_of(part.column("text"), shingle, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(found)], ["key", "fp"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(work, f"key {kind}, fp long").withColumnRenamed("key", key)


def agreement(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both set: a 64 x 64
    matrix, summed up in each partition first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fp), 1 << 15):
                x = _bits(fp[at : at + (1 << 15)]).astype(np.float32)
                total += (x.T @ x).astype(np.int64)
                n += len(x)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(i)), -1]), pa.array([*total[i, j].tolist(), n])], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = {r["cell"]: r["n"] for r in rows}
    out = np.zeros((BITS, BITS), dtype=np.int64)
    i, j = np.triu_indices(BITS)
    out[i, j] = [cells.get(k, 0) for k in range(len(i))]
    return cells.get(-1, 0), np.maximum(out, out.T)


def partition_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cuts the bits into parts of (nearly) equal size, correlated bits together: each part
    starts with the bit that is most correlated with the others that are left, and takes
    the one most correlated with those it has."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        part = [max(left, key=lambda b: related[b, left].sum())]
        left.remove(part[0])
        while len(part) < size:
            part.append(max(left, key=lambda b: related[b, part].sum()))
            left.remove(part[-1])
        out.append(sorted(part))
    return out


def allocate(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Parts with their thresholds (-1: not probed), of least estimated cost."""
    share = np.diag(both) / max(n, 1)
    agree = np.clip(share**2 + (1 - share) ** 2, 0.5, 1 - 1e-9)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, radius + 2):
        cut = partition_bits(n, both, parts)
        # Estimated cost of part i with threshold t: its keys, and pairs that agree on all
        # but at most t of its bits, taken as independent.
        cost = []
        for bits in cut:
            odds = (1 - agree[bits]) / agree[bits]
            by_t, near = {-1: 0.0}, np.ones(1)
            for t in range(radius + 1):
                if t:
                    near = np.append(near, sum(np.prod(odds[list(c)]) for c in itertools.combinations(range(len(bits)), t)) if t < 3 else odds.sum() ** t / 6)
                keys = 1.0
                for k in range(t):
                    keys *= (len(bits) - k) / (k + 1)
                by_t[t] = PROBE_COST * n * keys + CANDIDATE_COST * n * n / 2 * np.prod(agree[bits]) * near.sum()
            cost.append(by_t)
        # Dynamic program over parts and the sum of thresholds so far.
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for by_t in cost:
            after: dict[int, tuple[float, list[int]]] = {}
            for total, (so_far, chosen) in states.items():
                for t, c in by_t.items():
                    if total + t not in after or so_far + c < after[total + t][0]:
                        after[total + t] = (so_far + c, [*chosen, t])
            states = after
        found = states[radius - parts + 1]
        if best is None or found[0] < best[0]:
            best = found[0], list(zip(cut, found[1], strict=True))
    return best[1]


def key_masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """For each key of a fingerprint, the bits it looks at."""
    out = []
    for bits, t in parts:
        if t >= 0:
            whole = sum(1 << b for b in bits)
            out += [whole - sum(1 << b for b in gone) for gone in itertools.combinations(bits, t)]
    return out


def forest(nodes: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (node, root) of the groups that fingerprints within the radius make. Nodes ascend.

    Each pass gives every fingerprint the least label among those near it and hooks its
    tree to that; passes end when nothing changes. Squares of BLOCK x BLOCK are compared
    at a time."""
    n = len(fps)
    label = np.arange(n)
    while True:
        least = label.copy()
        for a in range(0, n, BLOCK):
            for b in range(0, a + 1, BLOCK):
                near = np.bitwise_count(fps[a : a + BLOCK, None] ^ fps[None, b : b + BLOCK]) <= radius
                here, there = label[a : a + BLOCK], label[b : b + BLOCK]
                least[a : a + BLOCK] = np.minimum(least[a : a + BLOCK], np.where(near, there[None, :], n).min(axis=1))
                if a != b:
                    least[b : b + BLOCK] = np.minimum(least[b : b + BLOCK], np.where(near, here[:, None], n).min(axis=0))
        if (least == label).all():
            break
        hooked = label.copy()
        np.minimum.at(hooked, label, least)
        np.minimum(hooked, least, out=hooked)
        while (hooked[hooked] != hooked).any():
            hooked = hooked[hooked]
        label = hooked
    own = np.flatnonzero(label != np.arange(n))
    return list(zip(nodes[own].tolist(), nodes[label[own]].tolist(), strict=True))


def edges(fps: DataFrame, masks: list[int], radius: int = RADIUS) -> DataFrame:
    """Rows (a, b), a > b: edges that link nodes with fingerprints within the radius, a
    spanning forest for each key. fps: (node, fp), different fingerprints."""
    ship(fps.sparkSession)
    use = np.array(masks, dtype=np.uint64)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = batch.column("node").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fp), 4096):
                x = fp[at : at + 4096]
                values = (x[:, None] & use).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(use), dtype=np.int32), len(x))), pa.array(values.view(np.int64)), pa.array(np.repeat(node[at : at + 4096], len(use))), pa.array(np.repeat(x.view(np.int64), len(use)))],
                    ["mask", "value", "node", "fp"],
                )

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in itertools.chain(frames, [None]):
            if frame is not None:
                both = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            elif rest is None:
                return
            else:
                both = rest
            mask, value = both["mask"].to_numpy(), both["value"].to_numpy()
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            bounds = np.concatenate(([0], cuts, [len(both)]))
            if frame is not None:  # the last key may go on
                rest, bounds = both.iloc[bounds[-2] :].reset_index(drop=True), bounds[:-1]
            node, fp = both["node"].to_numpy(), both["fp"].to_numpy().view(np.uint64)
            sizes = np.diff(bounds)
            out: list[np.ndarray] = []
            two = bounds[:-1][sizes == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
            out.append(np.stack([np.maximum(node[two], node[two + 1]), np.minimum(node[two], node[two + 1])], axis=1))
            for k in np.flatnonzero(sizes > 2).tolist():
                a, b = bounds[k], bounds[k + 1]
                order = np.argsort(node[a:b], kind="stable")
                if found := forest(node[a:b][order], fp[a:b][order], radius):
                    out.append(np.array(found, dtype=np.int64))
            found = np.concatenate(out)
            if len(found):
                yield pd.DataFrame(found, columns=["a", "b"])

    probes = fps.select("node", "fp").mapInArrow(probe, "mask int, value long, node long, fp long")
    met = probes.repartition("mask", "value").sortWithinPartitions("mask", "value")
    return met.mapInPandas(verify, "a long, b long").distinct()


def grouped(prints: DataFrame, radius: int = RADIUS, key: str = "doc_id") -> DataFrame:
    """Rows (key, fp, component_id) of fingerprints (key, fp)."""
    prints = stored(prints)
    nodes = stored(prints.groupBy("fp").agg(F.min(key).alias("node")))
    # Rows without an id make no nodes of their own.
    named = nodes.where("node is not null")
    n, both = agreement(named)
    links = edges(named, key_masks(allocate(n, both, radius)), radius)
    of_node = components(links).select("node", "root")
    labels = nodes.join(of_node, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return prints.join(labels, "fp").select(key, "fp", "component_id")
