"""Operator 3: toxicity by a convolutional text classifier, trained by Spark's tasks in numpy.

A word's embedding is the sum of hashed embeddings of the word (lower case, without signs
at its ends), its prefixes and its ending, so that unseen forms of a known stem are near
it. Filters of several widths run over the whole text, each keeps its maximum, and a
logistic unit turns the maxima into a score. Only text enters the score.

Training learns from every labelled row that has a document, toxic and other rows weighted to
their shares in all labels. Where the labels are at most `Setting.positives` toxic and
`Setting.negatives` other ones, all are fitted on the driver. Else a seventh of the ids, by
hash, is set aside; a start is fitted on the driver, on so many rows (those with the smallest
hashes of their ids), and words it did not learn count as nothing; then come one to
`Setting.passes` passes over all rows not set aside. In a pass, each task goes down the
gradient from the model sent to it, a file of rows at a time, and what each file moved is
averaged over the files that moved it. The start itself is never the result: of the passes,
the one with the least loss over all rows set aside is. Files of rows follow Spark's shuffle
partitions: the same tables, settings and number of cores give the same model.

All rows set aside (on the driver, a seventh of the rows) choose the epoch or pass and
calibrate the score (scale of the log odds), and give each language the threshold with the
best F1, where it has at least `least_positives` toxic ones among them (else the default).
Thresholds by language mark `flagged`; they never change a score.

Scoring is a map over the whole table: a batch's words are embedded once per different
word, convolution is a sum of table rows.

Nulls: null and empty texts are scored as a text of one blank. A null id is never held
out, and its label never joins. Rows without a label or language are scored like others
(default threshold). Repeated rows are scored alike; labels that contradict each other
for one id count once each; of rows with one id, the one with the smallest text is learnt
from. Without any labels of both kinds all scores are the base rate.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.llm.common import Words, ship, slices, stored


@dataclass(frozen=True)
class Setting:
    buckets: int = 1 << 17
    dims: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    positives: int = 1500  # rows fitted on the driver: all, or the start
    negatives: int = 3500
    passes: int = 3  # over all rows, at most
    default: float = 0.3
    least_positives: int = 20
    enough: float = 0.003  # held-out loss at which training ends
    seed: int = 7


@dataclass
class Model:
    setting: Setting
    table: np.ndarray  # bucket embeddings, (buckets, dims)
    filters: list[np.ndarray]  # of each width, (width, dims, filters)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)
    squares: dict = field(default_factory=dict)  # sums of squared gradients, while it is trained


FEATURES = 5


def features(words: list[str], buckets: int) -> np.ndarray:
    """Hashed features of words: itself, prefixes of 3, 4 and 5 letters, the last 3."""
    out = np.empty((len(words), FEATURES), dtype=np.int64)
    crc = zlib.crc32
    for i, word in enumerate(words):
        w = word.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~|¡¿«»“”„…")
        out[i] = crc(b"w" + w.encode()), crc(b"3" + w[:3].encode()), crc(b"4" + w[:4].encode()), crc(b"5" + w[:5].encode()), crc(b"e" + w[-3:].encode())
    return out % buckets


class Batch:
    """Words of texts as codes, each text padded so that every filter fits."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, blank: int, widest: int):
        counts = np.diff(offsets)
        pad = widest - 1 + (counts == 0)  # an empty text is one blank
        self.starts = np.cumsum(counts + pad) - counts - pad
        self.codes = np.full(int((counts + pad).sum()) + widest, blank, dtype=np.int64)
        place = np.repeat(self.starts - offsets[:-1], counts) + np.arange(offsets[0], offsets[-1])
        self.codes[place] = codes[offsets[0] : offsets[-1]]
        spans = np.maximum(counts, 1)
        self.cuts = np.cumsum(spans) - spans
        self.positions = np.repeat(self.starts - self.cuts, spans) + np.arange(spans.sum())
        self.spans = spans


def pooled(model: Model, words: np.ndarray, batch: Batch) -> np.ndarray:
    """Maxima of the filters over each text, before the ReLU. words: embeddings by code."""
    found = []
    for filters in model.filters:
        total = None
        for k, weights in enumerate(filters):
            part = (words @ weights)[batch.codes[batch.positions + k]]
            total = part if total is None else total + part
        found.append(np.maximum.reduceat(total, batch.cuts, axis=0))
    return np.concatenate(found, axis=1) + model.bias


def log_odds(model: Model, maxima: np.ndarray) -> np.ndarray:
    return np.maximum(maxima, 0) @ model.out + model.shift


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def embed(model: Model, feats: np.ndarray) -> np.ndarray:
    """Embeddings of words by their features; a last one of zeros for the blank."""
    out = np.zeros((len(feats) + 1, model.setting.dims), dtype=np.float32)
    for k in range(FEATURES):
        out[:-1] += model.table[feats[:, k]]
    return out


class Coded:
    """Texts as codes of their words, and the features of these; the last code is the blank."""

    def __init__(self, texts: pa.Array, setting: Setting):
        words = Words(texts)
        found, codes = words.coded()
        feats = features(found.to_pylist(), setting.buckets)
        self.blank, self.widest = len(feats), max(setting.widths)
        self.feats = np.concatenate([feats, np.zeros((1, FEATURES), dtype=np.int64)])
        self.codes = codes.astype(np.int64)
        self.lows, self.highs = words.offsets[:-1], words.offsets[1:]

    def batch(self, rows: np.ndarray, rng: np.random.Generator | None = None, drop: float = 0.0) -> Batch:
        counts = self.highs[rows] - self.lows[rows]
        ends = np.cumsum(counts)
        place = np.repeat(self.lows[rows] - ends + counts, counts) + np.arange(ends[-1])
        found = self.codes[place]
        if drop:
            found = np.where(rng.random(len(found)) < drop, self.blank, found)
        return Batch(found, np.concatenate(([0], ends)), self.blank, self.widest)


STEP = 64  # texts
DROP = 0.15  # share of words left out in training
RATE = 0.08


def descend(model: Model, texts: Coded, batch: Batch, labels: np.ndarray, weights: np.ndarray, early: bool = False) -> None:
    """One step down the gradient of a batch; changes the model and its squares."""
    setting, feats, blank, squares = model.setting, texts.feats, texts.blank, model.squares
    some, inverse = np.unique(batch.codes, return_inverse=True)
    near = np.zeros((len(some), setting.dims), dtype=np.float32)
    for k in range(FEATURES):
        near += model.table[feats[some, k]]
    near[some == blank] = 0
    maxima, tops = [], []
    doc = np.repeat(np.arange(len(labels)), batch.spans)
    for filters in model.filters:
        total = sum((near @ w)[inverse[batch.positions + k]] for k, w in enumerate(filters))
        top = np.maximum.reduceat(total, batch.cuts, axis=0)
        where = np.where(total == top[doc], np.arange(len(total))[:, None], len(total))
        maxima.append(top)
        tops.append(np.minimum.reduceat(where, batch.cuts, axis=0))
    maxima = np.concatenate(maxima, axis=1) + model.bias
    wrong = ((sigmoid(log_odds(model, maxima)) - labels) * weights / len(labels)).astype(np.float32)
    up = wrong[:, None] * model.out * (maxima > -0.01 if early else maxima > 0)
    grad_near = np.zeros_like(near)
    steps = [("bias", model.bias, up.sum(0)), ("out", model.out, wrong @ np.maximum(maxima, 0))]
    for i, (filters, top) in enumerate(zip(model.filters, tops, strict=True)):
        part = up[:, i * setting.filters : (i + 1) * setting.filters]
        grad = np.zeros_like(filters)
        for k in range(len(filters)):
            code = inverse[batch.positions[top] + k]  # (texts, filters)
            grad[k] = np.einsum("tfd,tf->df", near[code], part)
            np.add.at(grad_near, code.ravel(), (part[:, :, None] * filters[k].T[None]).reshape(-1, setting.dims))
        steps.append((i, filters, grad))
    grad_near[some == blank] = 0
    for name, value, grad in steps:
        squares[name] += grad**2
        value -= RATE * grad / (np.sqrt(squares[name]) + 1e-6)
    touched = np.flatnonzero(np.abs(grad_near).sum(1))
    for k in range(FEATURES):
        bucket, place = np.unique(feats[some[touched], k], return_inverse=True)
        grad = np.zeros((len(bucket), setting.dims), dtype=np.float32)
        np.add.at(grad, place, grad_near[touched])
        squares["table"][bucket] += grad**2
        model.table[bucket] -= RATE * grad / (np.sqrt(squares["table"][bucket]) + 1e-6)
    squares["shift"] += float(wrong.sum()) ** 2
    model.shift -= 0.02 * float(wrong.sum()) / (squares["shift"] ** 0.5 + 1e-6)


def fit(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, langs: list[str | None], setting: Setting = Setting(), aside: np.ndarray | None = None) -> Model:
    """Trains and calibrates a model on rows in memory. aside: rows not to learn from (else a
    seventh of them), which choose the epoch and calibrate."""
    rng = np.random.default_rng(setting.seed)
    widths, n_out = setting.widths, setting.filters * len(setting.widths)
    base = float(np.average(labels, weights=weights)) if len(labels) else 0.0
    model = Model(
        setting, rng.normal(0, 0.1, (setting.buckets, setting.dims)).astype(np.float32),
        [rng.normal(0, 0.5, (w, setting.dims, setting.filters)).astype(np.float32) / w for w in widths],
        np.zeros(n_out, dtype=np.float32), rng.uniform(0.3, 0.7, n_out).astype(np.float32), 0.0,
    )
    if not 0 < base < 1:
        model.out[:] = 0
        model.shift = -40.0 if base == 0 else 40.0
        return model
    model.shift = float(np.log(base / (1 - base)))
    coded = Coded(texts, setting)
    order = rng.permutation(len(labels))
    if aside is None:
        held, order = order[: len(order) // 7], order[len(order) // 7 :]
    else:
        held, order = order[aside[order]], order[~aside[order]]

    def scores(rows: np.ndarray) -> np.ndarray:
        parts = [rows[i : i + 256] for i in range(0, len(rows), 256)]
        every = embed(model, coded.feats[:-1])
        return np.concatenate([log_odds(model, pooled(model, every, coded.batch(p))) for p in parts]) if parts else np.zeros(0)

    def loss(x: np.ndarray, rows: np.ndarray) -> float:
        p = np.clip(sigmoid(x), 1e-7, 1 - 1e-7)
        return float(-np.average(np.where(labels[rows] == 1, np.log(p), np.log(1 - p)), weights=weights[rows]))

    model.squares = {k: np.zeros_like(v) for k, v in (("table", model.table), ("bias", model.bias), ("out", model.out), *((i, f) for i, f in enumerate(model.filters)))} | {"shift": 0.0}
    best: tuple[float, tuple] | None = None
    epochs = int(np.clip(30_000 // max(len(order), 1), 4, 40))
    weights = weights / weights.mean()
    for epoch in range(epochs):
        rng.shuffle(order)
        for at in range(0, len(order), STEP):
            rows = order[at : at + STEP]
            descend(model, coded, coded.batch(rows, rng, DROP), labels[rows], weights[rows], early=epoch == 0)
        now = loss(scores(held), held) if len(held) else 0.0
        if best is None or now < best[0]:
            best = now, (model.table.copy(), [f.copy() for f in model.filters], model.bias.copy(), model.out.copy(), model.shift)
        if len(held) and now < setting.enough:
            break
    model.table, model.filters, model.bias, model.out, model.shift = best[1]
    if len(held):
        calibrate(model, scores(held), labels[held], weights[held], [langs[i] for i in held])
    return model


SCALES = np.geomspace(0.4, 1.5, 23)
CUTS = np.linspace(0.1, 0.9, 81)


def best_cut(hits: np.ndarray, said: np.ndarray, toxic: float, default: float) -> float:
    """The threshold with the best F1, the nearest to the default among equals. hits, said:
    weight of toxic rows and of all rows at or over each of CUTS."""
    good = 2 * hits / (said + toxic)
    top = CUTS[good >= good.max() - 1e-9]
    return float(top[np.argmin(np.abs(top - default))])


def calibrate(model: Model, odds: np.ndarray, labels: np.ndarray, weights: np.ndarray, langs: list[str | None]) -> None:
    """Scale of the log odds by held-out likelihood, then thresholds by language."""
    if 0 < labels.mean() < 1:
        def loss(scale: float) -> float:
            p = np.clip(sigmoid(scale * odds), 1e-6, 1 - 1e-6)
            return -np.average(np.where(labels == 1, np.log(p), np.log(1 - p)), weights=weights)

        model.scale = float(min(SCALES, key=loss))
    score = sigmoid(model.scale * odds)
    for lang in sorted({x for x in langs if x}):
        own = np.array([x == lang for x in langs])
        if (labels[own] == 1).sum() < model.setting.least_positives:
            continue
        over = (score[own][:, None] >= CUTS) * weights[own][:, None]
        model.thresholds[lang] = best_cut(labels[own] @ over, over.sum(0), (weights[own] * labels[own]).sum(), model.setting.default)


def held_out(key: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))


def usable(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels (`_key`, `_toxic`) that aren't held out."""
    return labels.select(labels[key].alias("_key"), labels["toxic"].cast("int").alias("_toxic")).where("_key is not null and _toxic in (0, 1)").where(~held_out("_key"))


def labelled(documents: DataFrame, pairs: DataFrame, setting: Setting = Setting(), text: str = "text", key: str = "doc_id", lang: str = "lang", few: bool = False) -> DataFrame:
    """All rows with a usable label: `_key`, `_toxic`, `_text`, `_lang`, `_aside` (the same for
    all labels of an id) and `_file`, the partition a row stands in. few: labels that fit into
    every executor spare other texts the shuffle."""
    rows = documents.select(documents[key].alias("_key"), documents[text].alias("_text"), documents[lang].alias("_lang")).where("_key is not null").where(~held_out("_key"))
    if few:
        rows = rows.join(F.broadcast(pairs.select("_key").distinct()), "_key", "left_semi")
    # Where an id is repeated, its row with the smallest text: summed up before the shuffle, so no id fills a task.
    once = rows.groupBy("_key").agg(F.min(F.struct("_text", "_lang")).alias("row")).select("_key", "row.*")
    aside = F.pmod(F.xxhash64(F.lit(setting.seed), "_key"), F.lit(7)) == 0
    found = once.join(pairs.distinct(), "_key").select("_key", "_toxic", "_text", "_lang", aside.alias("_aside"), F.spark_partition_id().alias("_file"))
    return found.sortWithinPartitions("_key", "_toxic")


def fitted(rows: DataFrame, shares: dict[int, int], setting: Setting, split: bool = False) -> Model:
    """`fit` on all rows of a small frame. split: by `_aside`."""
    got = rows.toPandas().sort_values(["_key", "_toxic"], kind="stable")
    found = got["_toxic"].to_numpy(dtype=np.int64)
    counts = {k: max(int((found == k).sum()), 1) for k in (0, 1)}
    weights = np.array([shares.get(k, 0) / counts[k] for k in found.tolist()], dtype=np.float64)
    langs = [x if isinstance(x, str) else None for x in got["_lang"]]
    return fit(pa.array(got["_text"], pa.string(), from_pandas=True), found, weights, langs, setting, got["_aside"].to_numpy(dtype=bool) if split else None)


def begun(rows: DataFrame, shares: dict[int, int], setting: Setting) -> Model:
    """The start: a model fitted on a bounded part of the rows."""
    order = F.xxhash64("_key"), "_key"
    ids = rows.select("_key", "_toxic")
    some = ids.where("_toxic = 1").orderBy(*order).limit(setting.positives).union(ids.where("_toxic = 0").orderBy(*order).limit(setting.negatives))
    # At most positives + negatives rows of two numbers: small enough for every executor.
    model = fitted(rows.join(F.broadcast(some), ["_key", "_toxic"]), shares, setting, split=True)
    if model.squares:
        model.table[(model.squares["table"] == 0).all(axis=1)] = 0
    return model


def copied(model: Model) -> Model:
    squares = {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in model.squares.items()}
    return Model(model.setting, model.table.copy(), [f.copy() for f in model.filters], model.bias.copy(), model.out.copy(), model.shift, squares=squares)


def learn(model: Model, texts: pa.Array, labels: np.ndarray, weights: np.ndarray, rng: np.random.Generator) -> None:
    """Goes once over texts in memory, in random order; changes the model."""
    coded, order = Coded(texts, model.setting), rng.permutation(len(labels))
    for at in range(0, len(order), STEP):
        rows = order[at : at + STEP]
        descend(model, coded, coded.batch(rows, rng, DROP), labels[rows], weights[rows])


def small_parts(model: Model) -> np.ndarray:
    """All of a model but its table, as rows like the table's."""
    flat = np.concatenate([*(f.ravel() for f in model.filters), model.bias, model.out, [model.shift]]).astype(np.float64)
    return np.concatenate([flat, np.zeros(-len(flat) % model.setting.dims)]).reshape(-1, model.setting.dims)


#: Moves are added up as whole numbers of this share, so that their order can't matter.
UNIT = 2.0**-32


def moves(start: Model, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the table that moved and all rows of the small parts, and how far in UNITs."""
    slots = np.flatnonzero((model.table != start.table).any(axis=1))
    small = small_parts(model) - small_parts(start)
    far = np.concatenate([model.table[slots].astype(np.float64) - start.table[slots], small])
    return np.concatenate([slots, len(model.table) + np.arange(len(small))]), np.rint(far / UNIT).astype(np.int64)


def moved(start: Model, slots: np.ndarray, far: np.ndarray) -> Model:
    """The model with rows of its table and small parts moved."""
    model, size = copied(start), len(start.table)
    big = slots < size
    model.table[slots[big]] += far[big].astype(np.float32)
    small = small_parts(start)
    small[slots[~big] - size] += far[~big]
    flat, at = small.ravel(), 0
    for value in (*model.filters, model.bias, model.out):
        value[...] = flat[at : at + value.size].reshape(value.shape)
        at += value.size
    model.shift = float(flat[at])
    return model


#: Weights of other and of toxic rows.
EVEN = (1.0, 1.0)


def passed(rows: DataFrame, model: Model, number: int = 0, weights: tuple[float, float] = EVEN) -> Model:
    """The model after a pass over all rows (`_text`, `_toxic`, `_file`) that stand file by file.

    A file's rows are learnt one after the other, from the model as sent. What comes back is
    one row a moved slot, averaged over the files that moved it: the size of the model."""
    spark = rows.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # fixed size: see Setting
    dims = [f"d{i}" for i in range(model.setting.dims)]

    def found(start: Model, own: Model) -> pa.RecordBatch:
        slots, far = moves(start, own)
        return pa.RecordBatch.from_arrays([pa.array(slots), *(pa.array(x) for x in np.ascontiguousarray(far.T))], ["slot", *dims])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, own, at = sent.value, None, None
        for batch in batches:
            files = batch.column("_file").to_numpy()
            ends = np.flatnonzero(np.diff(files)) + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(files)], strict=True):
                if a == b:
                    continue
                if own is None or files[a] != at:
                    if own is not None:
                        yield found(start, own)
                    own, at, rng = copied(start), files[a], np.random.default_rng([start.setting.seed, number])
                for part in slices(batch.slice(a, b - a), "_text"):
                    toxic = part.column("_toxic").to_numpy()
                    learn(own, part.column("_text"), toxic, np.array(weights)[toxic], rng)
        if own is not None:
            yield found(start, own)

    kinds = T.StructType([T.StructField(x, T.LongType()) for x in ("slot", *dims)])
    each = rows.select("_text", "_toxic", "_file").mapInArrow(work, kinds)
    mean = [(F.sum(x) / F.count("*") * UNIT).alias(x) for x in dims]
    got = each.groupBy("slot").agg(*mean).toPandas()
    return moved(model, got["slot"].to_numpy(dtype=np.int64), got[dims].to_numpy(dtype=np.float64))


def judged(rows: DataFrame, model: Model) -> DataFrame:
    """Log odds of rows before calibration, stored: `_toxic`, `_lang`, `_odds`."""
    found = scored(rows.select("_text", "_toxic", "_lang"), replace(model, squares={}), "_text", raw=True)
    return stored(found.select("_toxic", "_lang", F.col("score").alias("_odds")))


def likelihood(odds: Column) -> Column:
    """A row's score by its log odds, as `sigmoid`."""
    return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(40.0)), F.lit(-40.0))))


def mean_loss(found: DataFrame, scales: list[float], least: float, weights: tuple[float, float] = EVEN) -> list[float]:
    """Loss over all rows at each scale; decimals, so that the order of rows can't matter."""
    def loss(scale: float) -> Column:
        p = F.greatest(F.least(likelihood(F.col("_odds") * scale), F.lit(1 - least)), F.lit(least))
        return -F.log(F.when(F.col("_toxic") == 1, p).otherwise(1 - p))

    sums = [F.sum(loss(x).cast("decimal(18,12)")).alias(str(i)) for i, x in enumerate(scales)]
    rows = found.groupBy("_toxic").agg(F.count("*").alias("n"), *sums).collect()
    total = sum(weights[r["_toxic"]] * r["n"] for r in rows)
    return [sum(weights[r["_toxic"]] * float(r[str(i)]) for r in rows) / total if total else 0.0 for i in range(len(scales))]


def calibrated(model: Model, found: DataFrame, weights: tuple[float, float] = EVEN) -> None:
    """As `calibrate`, from counts over all rows of a frame as `judged` returns it."""
    kinds = {r["_toxic"] for r in found.select("_toxic").distinct().collect()}
    if kinds == {0, 1}:
        model.scale = float(SCALES[int(np.argmin(mean_loss(found, SCALES.tolist(), 1e-6, weights)))])
    score = likelihood(F.col("_odds") * model.scale)
    at = F.size(F.filter(F.array(*(F.lit(float(c)) for c in CUTS)), lambda c: c <= F.col("_score")))
    bins = found.where("_lang <> ''").withColumn("_score", score).groupBy("_lang", at.alias("bin")).agg(F.count("*").alias("n"), F.sum("_toxic").alias("toxic"))
    # A row a language with enough toxic rows, with at most as many counts as there are cuts, and one.
    enough = F.col("toxic") >= model.setting.least_positives
    for row in bins.groupBy("_lang").agg(F.collect_list(F.struct("bin", "n", "toxic")).alias("bins"), F.sum("toxic").alias("toxic")).where(enough).collect():
        said, hits = np.zeros(len(CUTS) + 1), np.zeros(len(CUTS) + 1)
        for x in row["bins"]:
            hits[x["bin"]] = weights[1] * x["toxic"]
            said[x["bin"]] = hits[x["bin"]] + weights[0] * (x["n"] - x["toxic"])
        over = lambda counts: counts[::-1].cumsum()[::-1][1:]
        model.thresholds[row["_lang"]] = best_cut(over(hits), over(said), weights[1] * row["toxic"], model.setting.default)


def train(documents: DataFrame, labels: DataFrame, setting: Setting = Setting(), text: str = "text", key: str = "doc_id", lang: str = "lang") -> Model:
    """A model that learnt from all labelled rows that aren't held out."""
    pairs = usable(labels, key)
    shares = {r["_toxic"]: r["n"] for r in pairs.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    few = shares.get(1, 0) <= setting.positives and shares.get(0, 0) <= setting.negatives
    rows = labelled(documents, pairs, setting, text, key, lang, few)
    if few:
        return replace(fitted(rows, shares, setting), squares={})
    rows = stored(rows)
    start = begun(rows, shares, setting)
    if not start.squares:  # no rows of both kinds
        return start
    counts = {r["_toxic"]: r["n"] for r in rows.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    weights = tuple(shares[k] / counts[k] * sum(counts.values()) / sum(shares.values()) for k in (0, 1))
    model, best = start, None
    for number in range(max(setting.passes, 1)):
        model = passed(rows.where("not _aside"), model, number, weights)
        found = judged(rows.where("_aside"), model)
        now = mean_loss(found, [1.0], 1e-7, weights)[0]
        if best is None or now < best[0]:
            best = now, model, found
        if now < setting.enough:
            break
    _, model, found = best
    model.squares = {}
    calibrated(model, found, weights)
    return model


def odds_of(model: Model, texts: pa.Array) -> np.ndarray:
    words = Words(texts)
    found, codes = words.coded()
    batch = Batch(codes.astype(np.int64), words.offsets, len(found), max(model.setting.widths))
    every = embed(model, features(found.to_pylist(), model.setting.buckets))
    return log_odds(model, pooled(model, every, batch))


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    return sigmoid(model.scale * odds_of(model, texts)).astype(np.float64)


def scored(documents: DataFrame, model: Model, text: str = "text", raw: bool = False) -> DataFrame:
    """All columns of the table, and `score` (0 to 1; raw: log odds before calibration), in
    place of one of that name."""
    spark = documents.sparkSession
    documents = documents.drop("score")
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # fixed size: see Setting
    names, found = documents.columns, odds_of if raw else score_texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found(sent.value, part.column(text)), pa.float64())], [*names, "score"])

    return documents.mapInArrow(work, T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())]))


def flagged(df: DataFrame, model: Model, lang: str = "lang"):
    """Whether a scored row is over its language's threshold."""
    cut = F.lit(model.setting.default)
    for name, value in sorted(model.thresholds.items()):
        cut = F.when(F.col(lang) == name, F.lit(value)).otherwise(cut)
    return F.col("score") >= cut
