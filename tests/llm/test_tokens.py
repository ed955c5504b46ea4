"""Operators 1 and 8 against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from maillage.llm import bpe, packing
from tests.llm.conftest import AWKWARD, awkward_rows

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = " abcdefthenaion.,'sSZ09\n\t\xa0é漢😀  \x1c\x85ñ"


def texts(n=1500):
    rng = random.Random(5)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*made, *(t + "<|endoftext|>" + t for t in made[:50]), *(t for t in AWKWARD if t is not None)]


def library(path):
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def test_codec_gives_the_merges_ids_and_text_back():
    own, other = bpe.Codec(BYTE), library(BYTE)
    made = texts()
    for text, ids in zip(made, own.encode_all(pa.array(made)), strict=True):
        want = other.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.encode(text) == ids
        assert own.decode(ids) == other.decode(want, skip_special_tokens=False)


def test_codec_on_nothing():
    own = bpe.Codec(BYTE)
    assert own.encode_all(pa.array([None, ""], pa.string())) == [b"", b""]
    assert own.encode_all(pa.array([], pa.string())) == []
    assert own.decode(b"") == ""
    assert own.decode(np.array([255 - 68], "<u4").tobytes()) == library(BYTE).decode([255 - 68])  # half a character


def test_recent_results_come_back_from_the_older_generation(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 3)
    asked = []
    found = bpe.Recent(lambda k: asked.append(k) or k.encode())
    for key in "abcdab":
        assert found[key] == key.encode()
    assert asked == list("abcd")


def test_digests_of_a_table(docs):
    got = bpe.digests(docs(awkward_rows()), BYTE).collect()
    other = library(BYTE)
    want = []
    for key, text in awkward_rows():
        ids = other.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(other.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(want)
    assert bpe.encoded(docs([]), BYTE).collect() == []


def test_word_tokens_match_the_library():
    own, other = packing.Tokens(WORD), library(WORD)
    made = texts()
    for text, ids in zip(made, own.encode(pa.array(made)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("shard_pieces", [5, 1000])
def test_packing_is_whole_and_tight(docs, shard_pieces):
    rows = [*awkward_rows(), *((100 + i, "the cat " * (i % 37)) for i in range(300))]
    got = packing.packed(packing.pieces(docs(rows), WORD, capacity=64), capacity=64, shard_pieces=shard_pieces).toPandas()
    other = library(WORD)
    want = defaultdict(list)
    for key, text in rows:
        ids = [*other.encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 64)):
            cut = ids[at : at + 64]
            want[key].append((n, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    found = defaultdict(list)
    for r in got.itertuples():
        found[None if np.isnan(r.doc_id) else int(r.doc_id)].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        ends = (sequence["offset"] + sequence["length"]).tolist()
        assert sequence["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 64
    least = -(-int(got["length"].sum()) // 64)
    assert got["sequence_id"].nunique() <= least * 1.05 + 1 + (len(got) // shard_pieces + 1)


def test_packing_of_nothing(docs):
    assert packing.packed(packing.pieces(docs([]), WORD)).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_runs_are_placed_once_and_nearly_as_tight_as_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 101, 30))
    counts = rng.integers(1, 40, len(lengths))
    placed, fill = defaultdict(set), defaultdict(list)
    for length, rank, n, sequence, offset in packing.match_runs(lengths, counts, 100):
        for k in range(n):
            assert rank + k not in placed[length]
            placed[length].add(rank + k)
            fill[sequence + k].append((offset, length))
    assert {k: len(v) for k, v in placed.items()} == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    gaps = []  # best-fit decreasing, one by one
    for length in sorted(np.repeat(lengths, counts).tolist(), reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            gaps.append(100 - length)
    assert len(fill) <= len(gaps) * 1.02 + 1
