"""Operator 13: language identification by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: how many different n-grams
of 1 to `Setting.longest` characters both have, over the root of the product of each
one's number. n-grams are taken within words (runs of letters and marks, lower case, a blank
on either side), and those count that some landmark has.

Fit: a bounded sample of labelled texts. For each of the `Setting.languages` commonest values
of the label, those different texts with the smallest hashes are taken, `Setting.sample`
texts in all; `Setting.landmarks` of them, dealt in turn over the labels, are the
landmarks. Nyström features are kernels with the landmarks times the inverse root of
the landmarks' own kernel matrix; on them a ridge regression of each label against the
rest is solved, labels weighted alike. A fifth of the sample chooses the ridge and the
scale of the scores. Which rows may be learnt from is the caller's choice.

Scoring: every whole text. A block of texts is a presence matrix (text x n-gram), multiplied
by the landmarks' (n-gram x landmark) and that by the weights (landmark x label). The
score is the softmax of the scaled regressions at the largest one.

Nulls: null texts and texts without a letter get `und` and score 0; so does everything if
nothing could be learnt. Rows without a label or text are not learnt from; null ids are kept.
Repeated texts are learnt once for each label. A text without any known n-gram gets the label
with the largest constant. Ties go to the first label in alphabetical order. Very long texts
are scored whole, in a block of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.llm.common import Words, ship, slices

UNKNOWN = "und"
#: Bits of a character's number in an n-gram's.
BITS = 15
#: Words of texts in a block of scoring, about, and texts at most.
BLOCK_WORDS, BLOCK_TEXTS = 1 << 17, 256


@dataclass(frozen=True)
class Setting:
    longest: int = 4
    languages: int = 200
    sample: int = 1600
    landmarks: int = 64
    ridges: tuple[float, ...] = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)


@dataclass
class Model:
    setting: Setting
    letters: np.ndarray  # number of each code point of the landmarks, 0: not theirs, 1: blank
    grams: np.ndarray  # known n-grams, ascending
    landmarks: np.ndarray  # (n-grams, landmarks), 1 over the root of a landmark's number of them
    weights: np.ndarray  # (landmarks, labels)
    constants: np.ndarray
    scale: float
    labels: list[str]


def plain(texts: pa.Array) -> pa.Array:
    """Words of texts (null: none): runs of letters and marks in lower case, between blanks."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\p{L}\p{M}]+", " ")


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def grams_of(words: list[str], letters: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, n-gram) of all n-grams of words that only have known characters."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), dtype="<u4")
    code = letters[points].astype(np.int64)
    blank = points == 0x20
    own = np.cumsum(blank) - 1
    found_words, found = [], []
    value, good = np.zeros(len(code), dtype=np.int64), np.ones(len(code), dtype=bool)
    for n in range(1, longest + 1):
        # Place i begins the n-gram: one more character, and no blank inside.
        size = len(code) - n + 1
        if size <= 0:
            break
        value = value[:size] << BITS | code[n - 1 :]
        good = good[:size] & (code[n - 1 :] > 0)
        if n > 2:
            good &= ~blank[n - 2 : n - 2 + size]
        at = np.flatnonzero(good & ~blank[:size] if n == 1 else good)
        found_words.append(own[at])
        found.append(value[at])
    return np.concatenate(found_words), np.concatenate(found)


class Grams:
    """Which known n-grams the different words of texts have, and the words of each text."""

    def __init__(self, texts: pa.Array, letters: np.ndarray, longest: int, known: np.ndarray | None = None):
        words = Words(plain(texts))
        distinct, self.codes = words.coded()
        self.offsets = words.offsets
        n = len(distinct)
        word, value = grams_of(distinct.to_pylist(), letters, longest) if n else (np.zeros(0, dtype=np.int64),) * 2
        if known is not None:
            place = np.searchsorted(known, value)
            place[place == len(known)] = 0
            hit = known[place] == value if len(known) else np.zeros(len(value), dtype=bool)
            word, value = word[hit], place[hit]
        order = np.argsort(word, kind="stable")
        self.values = value[order]
        self.starts = np.searchsorted(word[order], np.arange(n + 1))

    def of(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, value) of texts low to high, values repeated where words share them."""
        a, b = self.offsets[low], self.offsets[high]
        text = np.repeat(np.arange(high - low), np.diff(self.offsets[low : high + 1]))
        pairs = np.unique(text * len(self.starts) + self.codes[a:b])
        text, code = pairs // len(self.starts), pairs % len(self.starts)
        sizes = self.starts[code + 1] - self.starts[code]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[code] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return np.repeat(text, sizes), self.values[at]


def kernels(texts: pa.Array, letters: np.ndarray, grams: np.ndarray, landmarks: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Kernels of texts with the landmarks, in blocks."""
    found = Grams(texts, letters, longest, grams)
    low, n = 0, len(texts)
    while low < n:
        high = int(np.searchsorted(found.offsets, found.offsets[low] + BLOCK_WORDS, side="right")) - 1
        high = max(low + 1, min(high, low + BLOCK_TEXTS, n))
        present = np.zeros((high - low, len(grams)), dtype=np.float32)
        present[found.of(low, high)] = 1
        own = present.sum(axis=1, dtype=np.float64)
        yield (present @ landmarks) / np.sqrt(np.maximum(own, 1))[:, None]
        low = high


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(texts: pa.Array, langs: list[str], setting: Setting = Setting()) -> Model | None:
    """A model of texts in memory, in an order that doesn't follow the labels' (a hash's)."""
    labels = sorted(set(langs))
    if not labels:
        return None
    y = np.array([labels.index(x) for x in langs])
    # The landmarks: labels in turn.
    turn = np.empty(len(y), dtype=np.int64)
    for c in range(len(labels)):
        turn[y == c] = np.arange((y == c).sum())
    chosen = np.sort(np.argsort(turn, kind="stable")[: setting.landmarks])
    some = texts.take(pa.array(chosen))
    points = sorted(set("".join(plain(some).to_pylist())) - {" "})[: (1 << BITS) - 2]
    letters = np.zeros(0x110000, dtype=np.uint16)
    letters[0x20] = 1
    letters[[ord(c) for c in points]] = np.arange(2, len(points) + 2)
    own = Grams(some, letters, setting.longest)
    grams = np.unique(own.values)
    text, value = own.of(0, len(some))
    landmarks = np.zeros((len(grams), len(some)), dtype=np.float32)
    landmarks[np.searchsorted(grams, value), text] = 1
    landmarks /= np.sqrt(np.maximum(landmarks.sum(axis=0), 1))
    near = np.concatenate([*kernels(texts, letters, grams, landmarks, setting.longest)]).astype(np.float64)
    values, vectors = np.linalg.eigh((near[chosen] + near[chosen].T) / 2)
    used = values > max(values[-1], 0) * 1e-6
    root = vectors[:, used] / np.sqrt(values[used])
    z = np.concatenate([near @ root, np.ones((len(y), 1))], axis=1)
    target = np.where(y[:, None] == np.arange(len(labels)), 1.0, -1.0)
    weight = (1 / np.bincount(y))[y] / len(labels)

    def solved(rows: np.ndarray, ridge: float) -> np.ndarray:
        left = (z[rows] * weight[rows, None]).T @ z[rows]
        penalty = np.append(np.full(z.shape[1] - 1, ridge), 1e-9)  # the constant is free
        return np.linalg.solve(left + np.diag(penalty * weight[rows].sum()), (z[rows] * weight[rows, None]).T @ target[rows])

    held = np.arange(len(y)) % 5 == 4
    rows, aside = np.flatnonzero(~held), np.flatnonzero(held)
    if not len(aside):
        rows = aside = np.arange(len(y))

    def loss(scores: np.ndarray) -> float:
        return -float(np.average(np.log(np.maximum(scores[np.arange(len(aside)), y[aside]], 1e-12)), weights=weight[aside]))

    scales = np.geomspace(0.5, 16, 16)
    tried = [(loss(softmax(z[aside] @ solved(rows, r) * s)), r, s) for r in setting.ridges for s in scales]
    _, ridge, scale = min(tried)
    found = solved(np.arange(len(y)), ridge)
    return Model(setting, letters, grams, landmarks, (root @ found[:-1]).astype(np.float32), found[-1], float(scale), labels)


def train(df: DataFrame, setting: Setting = Setting(), text: str = "text", lang: str = "lang") -> Model | None:
    """A model from a bounded sample of the rows of df with a label and a letter in their text."""
    rows = df.select(df[text].alias("text"), df[lang].alias("lang"), F.xxhash64(df[text]).alias("hash")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    common = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(setting.languages).collect()}
    if not common:
        return None
    each = max(setting.sample // len(common), 1)
    # Far more hashes than wanted pass, of the smallest, so that few are ranked.
    share = F.lit(None).cast("double")
    for name, n in common.items():
        share = F.when(F.col("lang") == name, F.lit(16.0 * each / n)).otherwise(share)
    small = F.shiftrightunsigned("hash", 11) / float(1 << 53) < share
    order = Window.partitionBy("lang").orderBy("hash")
    picked = rows.where(small).select("lang", "hash").distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each).select("lang", "hash")
    # At most `setting.sample` rows (one a language, where there are more languages).
    texts = rows.join(F.broadcast(picked), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    got = texts.toPandas().sort_values(["hash", "lang"], kind="stable")
    return fit(pa.array(got["text"], pa.large_string()), got["lang"].tolist(), setting)


def predicted_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the number of its label (-1: unknown) and the score."""
    best, score = [], []
    for near in kernels(texts, model.letters, model.grams, model.landmarks, model.setting.longest):
        found = softmax((near @ model.weights + model.constants) * model.scale)
        best.append(found.argmax(axis=1))
        score.append(found.max(axis=1))
    best, score = (np.concatenate(x) if x else np.zeros(0) for x in (best, score))
    some = has_letter(texts)
    return np.where(some, best, -1).astype(np.int64), np.where(some, score, 0.0).astype(np.float64)


def predicted(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns of df with `lang_pred` and `score`, in place of such columns of its own."""
    df = df.drop("lang_pred", "score")
    if model is None:
        return df.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    spark = df.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # its size is bounded by Setting
    names = df.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = sent.value
        labels = pa.array([*use.labels, UNKNOWN], pa.string())
        for batch in batches:
            for part in slices(batch, text):
                best, score = predicted_texts(use, part.column(text))
                said = labels.take(pa.array(np.where(best < 0, len(use.labels), best)))
                yield pa.RecordBatch.from_arrays([*part.columns, said, pa.array(score)], [*names, "lang_pred", "score"])

    kind = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return df.mapInArrow(work, kind)
