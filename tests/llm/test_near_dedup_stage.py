"""The pipeline's near-dedup stage against fingerprints by plain loops."""

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tests.llm.conftest import AWKWARD


def fingerprint(text):
    words = (text or "").encode()
    words = "".join(chr(b) for b in words).translate({c: c + 32 for c in range(65, 91)}).translate({c: " " for c in range(9, 14)}).split(" ")
    words = [w.encode("latin-1") for w in words if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def versions(seed=5):
    """Texts with copies, versions with a word changed, and a large group of each."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    words = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    texts = []
    for k in range(40):
        base = words(int(rng.integers(20, 400)))
        texts += [" ".join(base)] * (1 + k % 3)
        for _ in range(k % 4):
            new = list(base)
            new[int(rng.integers(0, len(base)))] = words(1)[0]
            texts.append(" ".join(new))
    base = words(500)
    for k in range(60):
        new = list(base)
        new[int(rng.integers(0, 500))] = f"x{k}"
        texts.append(" ".join(new))
    texts += [*["the very same text"] * 50, *AWKWARD]
    return [(int(k), texts[i]) for k, i in enumerate(rng.permutation(len(texts)))]


@pytest.mark.parametrize("seed", [5, 6])
def test_stage_keeps_one_of_each_group(spark, docs, seed):
    rows = versions(seed)
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert sum(prints[i] != prints[j] for i, j in near) > 20
    for _ in rows:
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    kept = corpus_pipeline.without_near_copies(spark, docs(rows), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted({rows[v][0] for v in label})
    assert all(r.text == dict(rows)[r.doc_id] for r in kept)


def test_nothing_is_lost_of_nothing(spark, docs):
    assert corpus_pipeline.without_near_copies(spark, docs([]), "").count() == 0
    rows = [(None, None), (None, "no id at all"), (None, "no id at all"), (4, "one two three"), (4, "one two three"), (4, "four five")]
    assert sorted((repr(r.doc_id), r.text) for r in corpus_pipeline.without_near_copies(spark, docs(rows), "").collect() if r.text) == [("4", "four five"), ("None", "no id at all")]
