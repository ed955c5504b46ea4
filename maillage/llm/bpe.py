"""Operator 8: exact byte-pair encoding in linear time, and decoding by an offset table.

The encoder never replays the merges. For a word it takes, at each place, the longest
token that fits (all matches come from one Aho-Corasick pass) and keeps it if it can
stand after the token before it; else the next shorter one; if none is left, it steps
back. Two tokens can stand side by side exactly if merging their joined bytes would give
those two tokens; the answers are kept in a pair-compatibility table. A sequence whose
neighbours are all compatible is the one that the merges give.

Nulls: a null text is encoded as an empty one (no ids, decoded as empty). Other columns
are kept out of the result. Repeated rows give repeated results; long texts are encoded
whole. The vocabulary's path is a parameter; its file is sent to the workers.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from maillage.llm.common import gathered, received, send_file, ship, slices

#: How the byte-level vocabulary splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded words and units of a generation that a worker remembers.
REMEMBER = 600_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of bytes in byte-level vocabularies: bytes that print stand for
    themselves, the others for the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Recent(dict):
    """Results of a function for the arguments met lately. When full it keeps the last
    REMEMBER as the older generation, of which what is asked for again comes back."""

    def __init__(self, function: Callable[[str], bytes]):
        self.function, self.older = function, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.function(key)
        if len(self) >= REMEMBER:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Codec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: bytes(of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        size = max(texts) + 1
        self.table = [texts.get(i, b"") for i in range(size)]
        self.sizes = [len(t) for t in self.table]
        self.lengths = np.array(self.sizes, dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.blob = np.frombuffer(b"".join(self.table), dtype=np.uint8)
        # Rank of a token: when the merge that makes it is applied; single bytes come first.
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank = [-1] * size
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made, a, b = vocab[left + right], vocab[left], vocab[right]
            self.merged[a, b] = rank
            if made not in self.parts:
                self.parts[made], self.rank[made] = (a, b), rank
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(self.table):
            if t and i not in self.special.values():
                self.matcher.add_word(t.decode("latin-1"), i)
        self.matcher.make_automaton()
        self.fits: dict[int, bool] = {}
        self.words = Recent(self._word)
        self.units = Recent(self._plain)
        self.split = regex.compile(PATTERN).findall
        self.mark = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether `left right` is how the merges leave their joined bytes.

        It is not exactly if, on the way of making both, some token ending at the seam
        and some token starting there would have been merged first."""
        key = left << 20 | right
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Goes back in time: a is the token that ended at the seam, b the one that began
        # there, until_a and until_b the ranks at which they were merged into larger ones.
        a, b = left, right
        until_a = until_b = len(self.merged)
        while True:
            rank = self.merged.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b:
                return False  # of equal pairs the left one merges first
            if self.rank[a] < 0 and self.rank[b] < 0:
                return True
            if self.rank[a] > self.rank[b]:
                until_a, a = self.rank[a], self.parts[a][1]
            else:
                until_b, b = self.rank[b], self.parts[b][0]

    def encode_word(self, data: bytes) -> list[int]:
        """Ids of one pre-split word."""
        size, sizes, fits = len(data), self.sizes, self.fits
        at: list[list[int]] = [[] for _ in range(size + 1)]
        for end, token in self.matcher.iter(data.decode("latin-1")):
            at[end - sizes[token]].append(token)  # at[-1] is place 0; shortest first
        out: list[int] = []
        place, dead, before = 0, set(), -1
        options = at[-1]
        left = len(options)
        while place < size:
            while left:
                left -= 1
                token = options[left]
                end = place + sizes[token]
                if end in dead:
                    continue
                if before < 0:
                    break
                good = fits.get(before << 20 | token)
                if good is None:
                    good = self.compatible(before, token)
                if good:
                    break
            else:  # nothing fits here: this place can't be a seam
                dead.add(place)
                out.pop()
                place -= sizes[before]
                options = at[place - 1]
                left = options.index(before)
                before = out[-1] if out else -1
                continue
            out.append(token)
            place, before = end, token
            options = at[end - 1]
            left = len(options)
        return out

    def _word(self, word: str) -> bytes:
        if len(self.fits) >= 4 * REMEMBER:
            self.fits.clear()
        return np.array(self.encode_word(word.encode()), dtype="<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not self.mark or not any(s in text for s in self.special):
            return self._plain(text)
        out, place = [], 0
        for found in self.mark.finditer(text):
            out += [self._plain(text[place : found.start()]), np.array([self.special[found[0]]], dtype="<u4").tobytes()]
            place = found.end()
        return b"".join([*out, self._plain(text[place:])])

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts (null: none).

        A space before a character that is not white space always starts a word, and a
        line break between such characters is a word. So where a text has no other white
        space, the units between spaces and line breaks stand alone, and each different
        unit is encoded once a batch."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, r"[ \n][ \n]|[ \n]$|[^\S \n]|[\x00-\x09\x0b-\x1f\x7f-\x{a0}]|[\x{1680}\x{2000}-\x{206f}\x{3000}]")
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        usual = pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n ")
        lists = pc.split_pattern(usual, " ")
        offsets = lists.offsets.to_numpy()
        found = lists.flatten().dictionary_encode()
        units, codes = found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False)
        # Bare: at the start of a text or line, and line breaks themselves.
        is_break = np.array([u == "\n" for u in units], dtype=bool)[codes]
        bare = is_break.copy()
        bare[1:] |= is_break[:-1]
        bare[offsets[:-1][offsets[:-1] < len(bare)]] = True
        size = len(units)
        keys = codes + size * bare
        used = np.zeros(2 * size, dtype=bool)
        used[keys] = True
        place = np.cumsum(used) - 1
        get = self.units.__getitem__
        parts = [get(" " + units[k] if k < size else units[k - size]) for k in np.flatnonzero(used).tolist()]
        out = gathered(parts, place[keys], offsets)
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.encode(texts[i].as_py())
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids: token bytes gathered by the offset table, invalid UTF-8 replaced."""
        tokens = np.frombuffer(ids, dtype="<u4")
        out = []
        for i in range(0, len(tokens), 1 << 18):
            part = tokens[i : i + (1 << 18)]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            shift = np.repeat(self.starts[part] - ends + lengths, lengths)
            out.append(self.blob[shift + np.arange(len(shift))].tobytes())
        return b"".join(out).decode("utf-8", errors="replace")


@cache
def codec(name: str) -> Codec:
    return Codec(received(name))


def encoded(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, ids (little-endian unsigned 32-bit, as binary), decoded text."""
    ship(df.sparkSession)
    name = send_file(df.sparkSession, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(name)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = use.encode_all(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(ids, pa.binary()), pa.array(map(use.decode, ids), pa.string())], ["key", "ids", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(work, f"key {kind}, ids binary, decoded string")
    return out.withColumnRenamed("key", key)


def digests(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the ids and of the decoded text."""
    ship(df.sparkSession)
    name = send_file(df.sparkSession, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(name)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for part in slices(batch, "text"):
                for ids in use.encode_all(part.column("text")):
                    counts.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_text.append(hashlib.sha256(use.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(work, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
