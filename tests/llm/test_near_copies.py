"""Operators 2, 4, 5 and 10 against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from maillage.llm import simhash, sketches, substrings, topk
from maillage.llm.common import components
from tests.llm.conftest import AWKWARD, awkward_rows

WORDS = r"[^\x20\x09-\x0D]+"


def passages(seed=3, n=60):
    """Documents that share passages, with copies and repeats of their own."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    shared = [" ".join(rng.choice(vocabulary, 30)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(vocabulary, rng.integers(0, 40))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, shared[i % 6])
        if i % 7 == 0:
            parts.append(parts[0])
        rows.append((i, "\n".join(parts)))
    rows += [(n + k, rows[k][1]) for k in range(8)]
    return [*rows, (n + 20, "same " * 70), (n + 21, "a b c " * 30)]


def without(rows, length):
    order = sorted(((k if k is not None else 2**63 - 1, t or "") for k, t in rows), key=lambda r: (r[0], r[1]))
    first, out = {}, {}
    for key, text in order:
        w = re.findall(WORDS, text)
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (key, s))
    for key, text in order:
        w = re.findall(WORDS, text)
        stays = [True] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < (key, s):
                stays[s : s + length] = [False] * length
        out.setdefault(key, []).append((len(w), stays.count(False), " ".join(x for x, y in zip(w, stays, strict=True) if y)))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("length, gram", [(20, 8), (5, 3)])
def test_repeated_passages_go(docs, length, gram):
    rows = [*passages(), *((1000 + (k if k is not None else 99), t) for k, t in awkward_rows() if k is not None), (None, passages()[0][1])]
    got = {}
    for r in substrings.thinned(docs(rows), length, gram).collect():
        got.setdefault(2**63 - 1 if r.doc_id is None else r.doc_id, []).append((r.n_words, r.n_removed, r.kept))
    assert {k: sorted(v) for k, v in got.items()} == without(rows, length)


def test_small_shards_give_the_same(docs, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 100)
    rows = passages(9)
    got = {r.doc_id: [(r.n_words, r.n_removed, r.kept)] for r in substrings.thinned(docs(rows)).collect()}
    assert got == without(rows, 20)


def test_cleaned_keeps_columns_and_clean_texts(docs):
    long = " ".join(f"v{i}" for i in range(40))
    out = {r.doc_id: r for r in substrings.cleaned(docs([(1, long), (2, "own  text\n" + long), (3, None)])).collect()}
    assert out[1].text == long and out[2].text == "own text" and out[2].n_chars == 8 and out[3].text is None and out[1].n_chars == 0
    assert substrings.cleaned(docs([])).columns == docs([]).columns and substrings.thinned(docs([])).count() == 0


def test_index_finds_every_window():
    rng = np.random.default_rng(1)
    stretches = [rng.integers(1, 4, rng.integers(0, 14)) for _ in range(30)]
    codes = np.concatenate(stretches).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in stretches])))
    index = substrings.FMIndex(codes, offsets, 5)
    found = {}
    for who, at, low, high in index.matching(codes, offsets):
        for w, a, lo, hi in zip(who.tolist(), at.tolist(), low.tolist(), high.tolist(), strict=True):
            found[w, a] = sorted(index.rows[lo:hi].tolist())
    want = {}
    for w, s in enumerate(stretches):
        for a in range(len(s) - 4):
            want[w, a] = sorted(int(index.starts[v]) + b for v, t in enumerate(stretches) for b in range(len(t) - 4) if (t[b : b + 5] == s[a : a + 5]).all())
    assert found == want


def fingerprint(text):
    w = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(keys, prints, radius):
    label = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for i in range(len(keys)):
            for j in range(len(keys)):
                if (prints[i] ^ prints[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_and_groups(docs):
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(i, t) for i, t in enumerate([*AWKWARD, *(base + f" {x}" for x in "abcdef"), base, base.upper()])]
    assert simhash.fingerprints_of(pa.array([t for _, t in rows], pa.string())).tolist() == [fingerprint(t) for _, t in rows]
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.grouped(simhash.fingerprints(docs(rows))).collect()}
    prints = [fingerprint(t) for _, t in rows]
    label = groups([k for k, _ in rows], prints, 3)
    assert got == {k: (prints[i], rows[label[i]][0]) for i, (k, _) in enumerate(rows)}
    assert simhash.grouped(simhash.fingerprints(docs([]))).count() == 0
    null = simhash.grouped(simhash.fingerprints(docs([(None, "lonely words here"), (None, base), (4, base), (4, base)]))).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in null if r.component_id) == [(False, 4), (False, 4), (True, 4)] and len(null) == 4


def test_links_by_any_allocation(frame):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints = list({int(base[i % 12]) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))) for i in range(150)})
    table = frame("node long, fp long", *((i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)))
    label = groups(list(range(len(prints))), prints, 3)
    n, both = simhash.agreement(table)
    x = np.array([[p >> b & 1 for b in range(64)] for p in prints])
    assert n == len(prints) and (both == x.T @ x).all()
    for parts, thresholds in ((1, [3]), (2, [1, 1]), (2, [2, 0]), (3, [1, 0, 0]), (3, [2, 0, -1]), (4, [0] * 4)):
        cut = list(zip(simhash.partition_bits(n, both, parts), thresholds, strict=True))
        if parts == 1:
            cut = [(cut[0][0][:64], 3)]
            continue  # all 43 745 keys a fingerprint: not for a test
        found = components(simhash.edges(table, simhash.key_masks(cut))).collect()
        assert {r.node: r.root for r in found} == {i: v for i, v in enumerate(label) if v != i}


def test_allocation_covers_the_radius_and_follows_the_costs():
    rng = np.random.default_rng(3)
    x = (rng.random((500, 64)) < np.where(np.arange(64) < 32, 0.02, 0.5)).astype(int)  # half of the bits tell little
    found = {}
    for n in (100, 10**6, 10**8):
        found[n] = parts = simhash.allocate(n, x.T @ x * n // 500, 3)
        assert sorted(b for bits, _ in parts for b in bits) == list(range(64))
        assert sum(t for _, t in parts) == 3 - len(parts) + 1
    assert len({t for _, t in found[10**6]}) > 1  # unequal where parts tell unequally much
    assert len(found[10**8]) < len(found[100])


@pytest.mark.parametrize("seed", range(5))
def test_components(frame, seed):
    rng = np.random.default_rng(seed)
    edges = {(int(max(a, b)), int(min(a, b))) for a, b in rng.integers(0, 60, (35, 2)) if a != b} | {(100 + i + 1, 100 + i) for i in range(20)}
    label = {v: v for e in edges for v in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = {r.node: r.root for r in components(frame("a long, b long", *edges)).collect()}
    assert found == {v: r for v, r in label.items() if v != r}
    assert components(frame("a long, b long")).count() == 0


def test_sketches(docs, monkeypatch):
    monkeypatch.setattr(sketches, "RANGE_ROWS", 5)
    rng = np.random.default_rng(4)
    texts = ["\n".join(" ".join(f"w{i}" for i in rng.integers(0, 50, rng.integers(1, 40))) for _ in range(rng.integers(1, 9))) for _ in range(20)]
    rows = list(enumerate([*AWKWARD, *texts, texts[0]]))
    got = {r.doc_id: r for r in sketches.fingerprinted(docs(rows)).collect()}
    pieces = lambda t: {m.strip(" ") for m in re.findall(r"(?:[^ \t\n\x0b\f\r]+[ \t]*){1,10}", t)}  # noqa: E731  Java's white space
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (key, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        r = got[key]
        assert (r.n_chars, r.edited_sha256, r.recovered) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), True)
        assert r.near_edited == pytest.approx(like(pieces(text), pieces(edited))) and r.near_next == pytest.approx(like(pieces(text), pieces(after)))
        assert (r.fingerprint == r.edited_fingerprint) == (pieces(text) == pieces(edited))
    assert got[len(rows) - 1].fingerprint == got[len(AWKWARD)].fingerprint
    assert sketches.fingerprinted(docs([])).count() == 0
    twins = sketches.fingerprinted(docs([(1, "a b"), (1, "a b"), (None, None)])).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in twins) == [(-1, 0), (1, 3), (1, 3)]


def test_peeling_retries_larger(spark):
    from pyspark.sql import functions as F

    a, b = list(range(0, 400)), list(range(100, 450))
    mixed = lambda xs: F.transform(F.array(*map(F.lit, xs)), lambda x: F.xxhash64(x))
    first = sketches.peeled(sketches.subtracted(sketches.sketch(mixed(a), F.lit(24)), sketches.sketch(mixed(b), F.lit(24))), 24)
    row = spark.range(1).select(first["ok"].alias("small"), sketches.difference(mixed(a), mixed(b)).alias("d")).first()
    assert not row.small and tuple(row.d) == (True, 100, 50)


@pytest.mark.parametrize("bundle", [2, 64])
def test_nearest_codes(frame, monkeypatch, bundle):
    monkeypatch.setattr(topk, "BLOCK_CODES", 40)
    monkeypatch.setattr(topk, "BUNDLE", bundle)
    rng = np.random.default_rng(6)
    vectors = [rng.normal(size=64) for _ in range(90)]
    vectors += [vectors[3]] * 30 + [vectors[4] * 2]  # equal codes
    rows = [(i, [float(x) for x in v], "x", 1) for i, v in enumerate(vectors)] + [(5, [float(x) for x in vectors[5]], "y", 2), (None, [1.0] * 64, "", 0), (500, None, "", 0)]
    table = frame("vec_id long, embedding array<double>, code string, distance int", *rows)
    found = topk.codes(table)
    got = {}
    for r in topk.nearest(found, found.where("vec_id % 20 = 0"), 7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.vec_id))
    bits = np.array([v > 0 for v in vectors])
    for q in range(0, len(vectors), 20):
        near = sorted((int((bits[q] != bits[i]).sum()), i) for i in range(len(vectors)) if i != q)[:7]
        assert sorted(got[q]) == [(k + 1, d, i) for k, (d, i) in enumerate(near)]
    few = found.where("vec_id < 3")
    assert topk.nearest(few, few, 7).count() == 6 and topk.nearest(found.limit(0), found.limit(0), 7).count() == 0


def test_vectors_of_another_length_are_refused(frame):
    with pytest.raises(Exception, match="64 components"):
        topk.codes(frame("vec_id long, embedding array<double>", (1, [1.0]))).collect()


