"""op2 over documents without ids, told apart by their texts."""

import numpy as np
import pytest

from maillage.llm import substrings


@pytest.mark.parametrize("bits", [{}, {"MARK_BITS": 0}, {"NULL_BITS": 0}])
def test_unrelated_texts_without_ids_stay_whole(docs, monkeypatch, bits):
    for name, value in bits.items():  # one of the two hashes tells nothing
        monkeypatch.setattr(substrings, name, value)
    rng = np.random.default_rng(3)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    passage = words(40)
    plain = [" ".join(words(100)) for _ in range(60)]
    repeating = [" ".join([*words(7), *passage, *words(5)]) for _ in range(30)]
    rows = [(None, t) for t in [*plain, *repeating]] + [(1, " ".join(words(50))), (None, None), (None, plain[0])]
    got = {}
    for r in substrings.thinned(docs(rows)).collect():
        got.setdefault(r.kept, []).append((r.doc_id, r.n_words, r.n_removed))
    assert all(len(got[t]) == (2 if t == plain[0] else 1) for t in plain)  # twins both stay
    assert sum(" ".join(passage) in k for k in got) == 1
    assert sorted(n for v in got.values() for _, _, n in v if n) == [40] * 29


def test_places_keep_document_and_start_order():
    start, mark, n = np.array([5, 3, (1 << 30) - 1]), np.array([9, (1 << 29) - 1, 0]), np.array([16, 1, 2])
    place = substrings._place(start, mark, n)
    assert (place >= 0).all() and place.argsort().tolist() == [2, 0, 1]
    assert [x.tolist() for x in substrings._unplace(place)] == [start.tolist(), n.tolist()]
