"""Operator 12 against numpy over all vectors at once."""

import numpy as np
import pytest

from maillage.llm import whitening

DDL = "vec_id long, embedding array<float>, x long, digest string, copies int, n int, key string"


def rows_of(vectors):
    return [(i, v, 1, "d", 2, 3, "k") for i, v in vectors]


def expected(vectors, weights):
    """(id, component) to (deviation, |whitened|), and explained, by numpy."""
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    longest = max(len(v) for _, v in good)
    x = np.array([[int(np.floor(256 * float(np.float32(c)))) for c in v] + [0] * (longest - len(v)) for _, v in good], dtype=np.int64)
    fit, copies = np.unique(x, axis=0, return_counts=True)
    copies = copies if weights == "count" else np.ones(len(fit), dtype=np.int64)
    n, s = int(copies.sum()), (fit * copies[:, None]).sum(axis=0)
    y = fit - s / n
    v = (y * copies[:, None]).T @ y / n
    values, vectors = np.linalg.eigh(v)
    top = np.argsort(values)[::-1][:4]
    w = (x - s / n) @ vectors[:, top] / np.sqrt(np.maximum(values[top], 1e-300))
    return [i for i, _ in good], ((n * x - s) ** 2).sum(axis=1), np.abs(w), values[top] / np.trace(v), n


@pytest.mark.parametrize("weights", ["one", "count"])
def test_like_numpy(frame, weights):
    rng = np.random.default_rng(1)
    made = [(i, (rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]).astype(np.float32).tolist()) for i in range(300)]
    made += [(1000 + i, made[7][1]) for i in range(200)] + [(7, made[7][1]), (None, made[3][1])]
    made += [(2000, None), (2001, [1.0] * 5 + [None]), (2002, [float("nan")] * 6), (2003, [1.0, float("inf")]), (2004, [-0.0] * 6), (2005, [1.0, 2.0])]
    got = whitening.whitened(frame(DDL, *rows_of(made)), by=weights).toPandas()
    ids, deviation, w, explained, n = expected(made, weights)
    assert len(got) == 4 * len(ids)
    assert set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10
    want = sorted(((-1 if i is None else i), c + 1, int(deviation[k]), round(w[k, c], 8)) for k, i in enumerate(ids) for c in range(4))
    found = sorted((-1 if np.isnan(r.vec_id) else int(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 8)) for r in got.itertuples())
    assert [f[:3] for f in found] == [f[:3] for f in want]
    np.testing.assert_allclose([f[3] for f in found], [f[3] for f in want], atol=1e-6)
    for c in range(4):
        np.testing.assert_allclose(got[got["component"] == c + 1]["explained"], explained[c], rtol=1e-9)


def test_signs_are_one_for_all_rows(frame):
    made = [(i, [float(i), float(i % 3)]) for i in range(30)]
    got = whitening.whitened(frame(DDL, *rows_of(made))).where("component = 1").orderBy("vec_id").toPandas()["whitened"]
    assert len({np.sign(b - a) for a, b in zip(got, got[1:], strict=False)}) == 1


def test_nothing_varies(frame):
    got = whitening.whitened(frame(DDL, *rows_of([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [0.5, 0.25])]))).collect()
    assert len(got) == 6
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, None, None, None)}


def test_dependent_columns(frame):
    got = whitening.whitened(frame(DDL, *rows_of([(i, [float(i), 2.0 * i]) for i in range(9)]))).toPandas()
    assert got[got["component"] == 2]["whitened"].isna().all() and got[got["component"] == 1]["whitened"].notna().all()
    assert got["identity_error"].max() < 1e-12


def test_huge_entries(frame):
    got = whitening.whitened(frame(DDL, *rows_of([(1, [1e14, 0.0]), (2, [0.0, 1.0]), (3, [1e38, 1.0])]))).collect()
    assert len(got) == 6 and {r["vec_id"]: r["deviation"] for r in got}[1] is None


def test_nothing(frame):
    for rows in ([], rows_of([(1, None), (2, [])])):
        got = whitening.whitened(frame(DDL, *rows))
        assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_weights_are_named(frame):
    with pytest.raises(ValueError, match="weights"):
        whitening.whitened(frame(DDL, *rows_of([(1, [1.0])])), by="two")
