"""Operator 3 learns from all labelled rows: against plain loops over them."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maillage.llm import toxicity
from tests.llm.test_texts import SMALL, labelled

DDL = "_key long, _toxic int, _text string, _lang string, _aside boolean, _file int"


@pytest.fixture(scope="module")
def start():
    rows = labelled(400)
    y = np.array([t for _, _, t in rows])
    return toxicity.fit(pa.array([t for _, t, _ in rows]), y, np.ones(len(y)), ["en"] * len(y), SMALL, np.arange(len(y)) % 7 == 0)


def test_rows_beyond_the_start_are_learnt(docs, frame):
    """Half of the toxic rows have a stem that no row of the start shows."""
    few = toxicity.Setting(buckets=1 << 12, positives=100, negatives=150)
    rows = labelled(3000)
    hashed = frame("doc_id long, toxic int", *((i, t) for i, _, t in rows)).where(~toxicity.held_out())
    order = [r.doc_id for r in hashed.where("toxic = 1").orderBy(F.xxhash64("doc_id")).collect()]
    late = set(order[few.positives :][::2]) | {i for i, _, t in rows if t and i not in set(order) and i % 2}
    rows = [(i, " ".join("zwoffel" if w.startswith("grum") else w for w in text.split()) if i in late else text, t) for i, text, t in rows]
    table, labels = docs([(i, t) for i, t, _ in rows]), frame("doc_id long, quality int, toxic int", *((i, 0, t) for i, _, t in rows))
    model = toxicity.train(table, labels, few)
    truth = {i: t for i, _, t in rows}
    got = {r.doc_id: r.score for r in toxicity.scored(table.where(toxicity.held_out()), model).collect()}
    assert np.mean([got[i] >= 0.3 for i in got if i in late]) > 0.95
    assert np.mean([(v >= 0.3) == truth[i] for i, v in got.items()]) > 0.95
    assert not model.squares


def test_a_pass_is_the_mean_of_its_files(frame, start):
    rows = [(i, t, text, "en", False, i % 3) for i, text, t in labelled(240, 3)]
    table = frame(DDL, *rows).repartitionByRange(2, "_file").sortWithinPartitions("_file", "_key")
    got = toxicity.passed(table, start, 1, (1.0, 0.5))
    own = []
    for file in range(3):
        part = [r for r in rows if r[5] == file]
        own.append(toxicity.copied(start))
        y = np.array([r[1] for r in part])
        toxicity.learn(own[-1], pa.array([r[2] for r in part]), y, 1 - 0.5 * y, np.random.default_rng([SMALL.seed, 1]))
    tables = np.stack([m.table for m in own]).astype(np.float64) - start.table
    times = (tables != 0).any(axis=2).sum(0)
    assert times.max() == 3 and (times == 0).any()
    assert np.allclose(got.table - start.table, tables.sum(0) / np.maximum(times, 1)[:, None], atol=1e-6)
    for a, *each in zip(got.filters, *(m.filters for m in own), strict=True):
        assert np.allclose(a, np.mean(each, axis=0), atol=1e-6)
    assert np.allclose(got.out, np.mean([m.out for m in own], axis=0), atol=1e-6) and np.isclose(got.shift, np.mean([m.shift for m in own]))
    assert not np.array_equal(got.out, start.out) and toxicity.passed(table.limit(0), start).shift == start.shift


def test_calibration_counts_all_rows(frame, start):
    rng = np.random.default_rng(4)
    langs = rng.choice(["en", "de", "", "few", None], 900, p=[0.5, 0.3, 0.1, 0.05, 0.05]).tolist()
    y = (rng.random(900) < 0.4).astype(np.int64)
    odds = rng.normal(2.0 * y - 1, 1.5)
    got, want = toxicity.copied(start), toxicity.copied(start)
    toxicity.calibrated(got, frame("_toxic int, _lang string, _odds double", *zip(y.tolist(), langs, odds.tolist(), strict=True)), (0.5, 2.0))
    toxicity.calibrate(want, odds, y, np.where(y == 1, 2.0, 0.5), langs)
    assert got.scale == want.scale != 1.0 and got.thresholds == want.thresholds and got.thresholds.keys() == {"en", "de"}


@pytest.mark.parametrize("few", [False, True])
def test_labelled_rows(docs, frame, few):
    ids = [i for i in range(30) if not toxicity.zlib.crc32(str(i).encode()) % 4 == 2]
    table = docs([*((i, f"text {i}") for i in ids), (ids[0], "a lesser text"), (None, "none"), (ids[1], None)])
    labels = frame("doc_id long, quality int, toxic int", *((i, 0, i % 2) for i in ids), (ids[2], 0, ids[2] % 2), (ids[3], 0, 1 - ids[3] % 2), (None, 0, 1), (999, 0, 1), (ids[4], 0, 7))
    got = toxicity.labelled(table, toxicity.usable(labels), few=few)
    want = {(i, i % 2): f"text {i}" for i in ids} | {(ids[3], 1 - ids[3] % 2): f"text {ids[3]}", (ids[0], ids[0] % 2): "a lesser text", (ids[1], ids[1] % 2): None}
    found = got.collect()
    assert {(r._key, r._toxic): r._text for r in found} == want and len(found) == len(want)
    assert {r._aside for r in found} == {True, False} and len({(r._key, r._aside) for r in found}) == len(ids)
