"""Operator 7: licence scans by a trained paragraph classifier, confirmed by templates.

Paragraphs are the lines of a text, and notices wrapped over successive lines that are not
blank (comment marks do not count): windows over such lines, somewhat longer than a
template, that have `confirm` of its 2-grams are looked at like lines. A wrapped notice
has the number of its first line; where a line of the window is confirmed alone, that
line stands for it. n_paragraphs counts lines. A multinomial logistic regression over hashed word
1-grams and 2-grams names a licence family or "unknown". It is trained here, on variants
of the families' templates (words left out, other words around them) and, for "unknown",
on the lines of a bounded sample of documents (at most `sample_documents`, those with the
smallest hashes of their ids) and on lines mixed from template words out of order. A part
set aside calibrates it: a temperature for the probabilities, and the least probability
at which at most `false_rate` of unknown lines would be named. Fitting is bounded: at most
`sample_lines` lines of the sample are collected; at most `plain_lines` of them, each by its
first `line_words` words, train "unknown"; the first `filler_words` words of `filler_lines`
of them are what stands around the templates.

A prediction is confirmed by comparing with the family's templates: the share of a
template's 2-grams that the paragraph has must reach `confirm`. As a paragraph without a
single telling word of any template can't reach that (checked when the model is made),
only paragraphs with one are scored; the result is the same as scoring all.

Nulls: null and empty texts have no paragraphs and no licences. A null id is kept.
Repeated rows are scanned alike. Long texts are scanned whole. Without documents the
model is trained on templates alone; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.llm.common import Words, ship, slices

#: Notices as they are commonly written, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License",
        "This project is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3",
    ),
    "GPL-2.0": ("This program is licensed under the GNU General Public License, version 2",),
    "LGPL": ("This library is licensed under the GNU Lesser General Public License",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3",),
    "BSD": (
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
    "CC0": ("Released under CC0 1.0 Universal Public Domain Dedication",),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-ND": ("Licensed under CC BY-NC-ND 4.0",),
}
#: Words that tell nothing about licences.
COMMON = frozenset("a an and any are as be by can copy file for free from in into is it may met not of on or person purpose that the this to under use with without work you your v 2 3 4 2.0 3.0 4.0 1.0".split())
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Setting:
    buckets: int = 1 << 15
    sample_documents: int = 300
    sample_lines: int = 8000
    plain_lines: int = 6000
    line_words: int = 200
    filler_lines: int = 2000
    filler_words: int = 30
    variants: int = 60
    confirm: float = 0.6
    false_rate: float = 0.001
    seed: int = 11


@dataclass
class Model:
    setting: Setting
    families: list[str]
    weights: np.ndarray  # (buckets, classes)
    temperature: float = 1.0
    least: float = 0.5


def words_of(line: str) -> list[str]:
    return [w for w in (x.strip(".,;:()[]\"'*/#<>!?-") for x in line.lower().split()) if w]


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(["^", *words], [*words, "$"], strict=True)) if len(words) < 2 else set(zip(words, words[1:], strict=False))


GRAMS = {f: [pairs(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}
#: Templates (family, words, 2-grams) and, for each 2-gram, which of them have it.
WHOLE = [(f, len(words_of(t)), pairs(words_of(t))) for f, ts in TEMPLATES.items() for t in ts]
HOLDERS: dict[tuple[str, str], list[int]] = {}
for _k, (_, _, _g) in enumerate(WHOLE):
    for _pair in _g:
        HOLDERS.setdefault(_pair, []).append(_k)
#: Words that may stand in a wrapped notice besides its template's.
SLACK = 5
TELLING = {w for ts in TEMPLATES.values() for t in ts for w in words_of(t)} - COMMON


def overlap(line: str, family: str) -> float:
    """Largest share of a template's 2-grams of a family that a line has."""
    own = pairs(words_of(line))
    return max((len(g & own) / len(g) for g in GRAMS.get(family, ())), default=0.0)


def features(words: list[str], buckets: int) -> np.ndarray:
    grams = [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]
    return np.unique(np.array([zlib.crc32(g.encode()) % buckets for g in grams], dtype=np.int64))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def odds(model: Model, lines: list[list[str]]) -> np.ndarray:
    return np.stack([model.weights[features(w, model.setting.buckets)].sum(0) for w in lines]) if lines else np.zeros((0, len(model.families)))


def fit(lines: list[str], setting: Setting = Setting()) -> Model:
    """Trains on the templates and on lines of the corpus."""
    for family, found in GRAMS.items():
        for g in found:
            if sum(a not in TELLING and b not in TELLING for a, b in g) >= setting.confirm * len(g):
                raise ValueError(f"a template of {family} could be confirmed by common words alone")
    rng = np.random.default_rng(setting.seed)
    families = [UNKNOWN, *TEMPLATES]
    plain = [w for w in map(words_of, lines) if w]
    plain = [w for w in plain if max(overlap(" ".join(w), f) for f in TEMPLATES) < 0.3]
    filler = [w for words in plain[: setting.filler_lines] for w in words[: setting.filler_words]] or ["lorem", "ipsum"]
    own = [w for ts in TEMPLATES.values() for t in ts for w in words_of(t)]
    x: list[list[str]] = []
    y: list[int] = []
    for k, family in enumerate(TEMPLATES, 1):
        for template in TEMPLATES[family]:
            base = words_of(template)
            for _ in range(setting.variants):
                kept = [w for w in base if w not in COMMON or rng.random() > 0.1]
                around = [[str(w) for w in rng.choice(filler, rng.integers(0, 6))] for _ in range(2)]
                x.append([*around[0], *kept, *around[1]])
                y.append(k)
    mixed = [[str(w) for w in rng.choice(own, rng.integers(1, 9))] for _ in range(len(x) // 3)]
    mixed = [w for w in mixed if max(overlap(" ".join(w), f) for f in TEMPLATES) < setting.confirm]
    x += [w[: setting.line_words] for w in plain[: setting.plain_lines]] + mixed
    y += [0] * (len(x) - len(y))
    y_all = np.array(y)
    sets = [features(w, setting.buckets) for w in x]
    model = Model(setting, families, np.zeros((setting.buckets, len(families)), dtype=np.float64))
    order = rng.permutation(len(x))
    held, order = order[: len(order) // 5], order[len(order) // 5 :]
    squares = np.full_like(model.weights, 1e-3)
    for _ in range(6):
        rng.shuffle(order)
        for i in order.tolist():
            p = softmax(model.weights[sets[i]].sum(0, keepdims=True))[0]
            p[y_all[i]] -= 1
            squares[sets[i]] += p**2
            model.weights[sets[i]] -= 0.3 * (p / np.sqrt(squares[sets[i]]) + 1e-4 * model.weights[sets[i]])
    scores = np.stack([model.weights[sets[i]].sum(0) for i in held])
    truth = y_all[held]
    model.temperature = float(min(np.geomspace(0.5, 8, 25), key=lambda t: -np.log(np.clip(softmax(scores / t)[np.arange(len(truth)), truth], 1e-9, 1)).mean()))
    named = softmax(scores / model.temperature)[:, 1:].max(1)[truth == 0]
    model.least = float(np.clip(np.quantile(named, 1 - setting.false_rate) if len(named) else 0.5, 0.3, 0.9))
    return model


def train(documents: DataFrame, setting: Setting = Setting(), text: str = "text", key: str = "doc_id") -> Model:
    """A model from the templates and a bounded sample of documents."""
    rows = documents.where(documents[text].isNotNull()).select(documents[key].alias("key"), documents[text].alias("text"))
    # Ids first, so that no task gathers texts it does not need; at most sample_documents ids.
    ids = rows.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(setting.sample_documents)
    found = rows.join(F.broadcast(ids), "key").select(F.explode(F.split("text", "\n")).alias("line"))
    return fit([r["line"] for r in found.where("line <> ''").orderBy(F.xxhash64("line"), "line").limit(setting.sample_lines).collect()], setting)


def judged(model: Model, lines: list[str]) -> list[tuple[str, float, float, bool]]:
    """(family, probability, template overlap, confirmed) of lines."""
    p = softmax(odds(model, [words_of(x) for x in lines]) / model.temperature) if lines else np.zeros((0, len(model.families)))
    out = []
    for line, row in zip(lines, p, strict=True):
        k = int(row.argmax())
        family = model.families[k] if row[k] >= model.least else UNKNOWN
        share = overlap(line, family)
        out.append((family, float(row[k]), share, family != UNKNOWN and share >= model.setting.confirm))
    return out


def wrapped(lines: list[list[str]], confirm: float) -> list[tuple[int, int, str, str]]:
    """(first line, last line, family, words) of windows over several successive lines
    (their words; none in a blank one) that have `confirm` of a template's 2-grams."""
    out = []
    at = 0
    while at < len(lines):
        end = at
        while end < len(lines) and lines[end]:
            end += 1
        if end - at > 1:
            words = [w for line in lines[at:end] for w in line]
            line_of = [k for k in range(at, end) for _ in lines[k]]
            hits: dict[int, list[tuple[int, tuple[str, str]]]] = {}
            for i, pair in enumerate(zip(words, words[1:], strict=False)):
                for k in HOLDERS.get(pair, ()):
                    hits.setdefault(k, []).append((i, pair))
            for k, found in hits.items():
                family, size, grams = WHOLE[k]
                if len({g for _, g in found}) < confirm * len(grams):
                    continue
                width, since = size + SLACK, 0
                shares = [len({g for i, g in found[s : s + width] if i + 1 < found[s][0] + width}) / len(grams) for s in range(len(found))]
                while since < len(found):
                    if shares[since] < confirm:
                        since += 1
                        continue
                    near = [s for s in range(since, len(found)) if found[s][0] < found[since][0] + size]
                    best = max(near, key=lambda s: shares[s])
                    first = found[best][0]
                    last = max(i for i, _ in found[best : best + width] if i + 1 < first + width) + 1
                    if line_of[first] != line_of[last]:
                        out.append((line_of[first], line_of[last], family, " ".join(words[first : last + 1])))
                    while since < len(found) and found[since][0] <= last:
                        since += 1
        at = end + 1
    return out


def joined(model: Model, lines: list[str], alone: list[dict]) -> list[dict]:
    """The confirmed lines of a text and, besides them, its wrapped notices."""
    windows = wrapped([words_of(x) for x in lines], model.setting.confirm)
    found = []
    for (first, last, family, _), (named, p, share, sure) in zip(windows, judged(model, [w[3] for w in windows]), strict=True):
        if sure and named == family and not any(f["family"] == family and first <= f["paragraph"] <= last for f in alone):
            found.append((first, last, {"paragraph": first, "family": family, "probability": p, "share": share}))
    kept: list[tuple[int, int, dict]] = []
    for first, last, one in sorted(found, key=lambda f: (-f[2]["share"], f[0], f[1])):  # several templates of a family: the best
        if not any(one["family"] == f["family"] and first <= b and a <= last for a, b, f in kept):
            kept.append((first, last, one))
    return sorted([*alone, *(f for _, _, f in kept)], key=lambda f: f["paragraph"])


def scanned(documents: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, n_paragraphs, found): the paragraphs with a licence, by their number,
    with family, probability and share of the template."""
    spark = documents.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # fixed size: see Setting
    kind = documents.schema[key].dataType.simpleString()
    found_type = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("share", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lists = pc.split_pattern(pc.fill_null(part.column("text").cast(pa.large_string()), ""), "\n")
                lines, offsets = lists.flatten(), lists.offsets.to_numpy()
                words = Words(lines)
                known, codes = words.coded()
                tells = np.array([bool(TELLING.intersection(words_of(w))) for w in known.to_pylist()], dtype=bool)
                hits = np.concatenate(([0], np.cumsum(tells[codes]))) if len(codes) else np.zeros(1, np.int64)
                near = np.flatnonzero(np.diff(hits[words.offsets]))
                filled = np.concatenate(([0], np.cumsum(np.diff(words.offsets) > 0)))[offsets]
                out: list[list[dict]] = [[] for _ in range(len(part))]
                owner = np.searchsorted(offsets, near, side="right") - 1
                for doc, line, (family, p, share, sure) in zip(owner.tolist(), near.tolist(), judged(sent.value, lines.take(pa.array(near)).to_pylist()), strict=True):
                    if sure:
                        out[doc].append({"paragraph": line - int(offsets[doc]), "family": family, "probability": p, "share": share})
                for doc in np.unique(owner).tolist():
                    a, b = int(offsets[doc]), int(offsets[doc + 1])
                    if b - a > 1:
                        out[doc] = joined(sent.value, lines.slice(a, b - a).to_pylist(), out[doc])
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(np.diff(filled)), pa.array(out, found_type)], ["key", "n_paragraphs", "found"])

    rows = documents.select(documents[key].alias("key"), documents[text].alias("text"))
    out = rows.mapInArrow(work, f"key {kind}, n_paragraphs long, found array<struct<paragraph:int,family:string,probability:double,share:double>>")
    return out.withColumnRenamed("key", key)
