"""Operator 11 against plain loops over the libraries' tokens."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from maillage.llm import alignment
from maillage.llm.bpe import byte_alphabet
from tests.llm.conftest import awkward_rows

BYTE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ALPHABET = ["a", "the", "ing", " ", " ", "  ", "\n", "\n\n", ".", ",", "'s", "12", "é", "漢字", "😀", "\t", "\r", "\xa0", "　", "\x1c", "\x85", ")", "?!", "<s>", "<0x41>", "<|endoftext|>", "​", "ß", "\x00"]


def expected(rows):
    """Results of (id, text) rows, in their order."""
    ours, theirs = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    ours.encode_special_tokens = True
    of = byte_alphabet()
    bytes_a = {i: bytes(of[c] for c in t) for t, i in ours.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}
    counts, found = Counter(), []
    for _, text in rows:
        full = (" " + (text or "")).encode()
        a, b = ours.encode(full.decode(), add_special_tokens=False).ids, theirs.encode(text or "")
        parts = [[bytes_a[i] for i in a], [alignment.piece_bytes(theirs.id_to_piece(i)) for i in b]]
        if not text or any(b"".join(p) != full for p in parts):
            found.append(None)
            continue
        spans = []
        for part in parts:
            at, own = 0, []
            for t in part:
                own.append((at, at + len(t)))
                at += len(t)
            spans.append(own)
        links = [(x, y) for x, (s, e) in zip(a, spans[0], strict=True) for y, (u, v) in zip(b, spans[1], strict=True) if u < e and s < v] if len(a) < 300 else None
        if links is None:  # the same by a walk
            links, j = [], 0
            for x, (s, e) in zip(a, spans[0], strict=True):
                while spans[1][j][1] <= s:
                    j += 1
                k = j
                while k < len(b) and spans[1][k][0] < e:
                    links.append((x, b[k]))
                    k += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [defaultdict(list), defaultdict(list)]
        for ids, own, group in zip((a, b), spans, groups, strict=True):
            for i, (_, e) in zip(ids, own, strict=True):
                group[bisect.bisect_left(ends, e)].append(str(i))
        line = ";".join(f"{','.join(groups[0][k])}|{','.join(groups[1][k])}" for k in range(len(ends)))
        counts.update(links)
        found.append((len(a), len(b), len(ends), links, hashlib.sha256(line.encode()).hexdigest()))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(counts[x] == top[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4]) for f in found]


def held_against(frame, rows, **more):
    got = alignment.alignments(frame, BYTE, PIECE, **more).select("doc_id", *COLUMNS).collect()
    want = [(key, *e) for (key, _), e in zip(rows, expected(rows), strict=True)]
    order = lambda x: sorted(map(tuple, x), key=repr)
    assert order(got) == order(want)


def test_awkward_texts(docs):
    rows = [*awkward_rows(), (70, "a▁b plain"), (71, "▁"), (72, "word"), (73, "\n"), (74, " x "), (75, "x." * 3000), (76, "漢" * 3000)]
    held_against(docs(rows), rows)


@pytest.mark.parametrize("chunk_bytes", [40, 1 << 20])
def test_random_texts_with_copies(docs, chunk_bytes):
    rng = random.Random(3)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(500)]
    rows = list(enumerate([*made, *made[:50], *["the same thing, again"] * 300]))
    held_against(docs(rows), rows, chunk_bytes=chunk_bytes)


def test_nothing(docs):
    assert alignment.alignments(docs([]), BYTE, PIECE).collect() == []
    assert [tuple(r)[1:] for r in alignment.alignments(docs([(1, None), (1, "")]), BYTE, PIECE).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_settings_stay(docs, spark):
    before = dict(spark.conf.getAll)
    alignment.alignments(docs([(1, "a b")]), BYTE, PIECE).collect()
    assert dict(spark.conf.getAll) == before
