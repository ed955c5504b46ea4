"""Operator 11: alignment of two tokenizers over the corpus, each different text once.

1. Texts are grouped by their full text (summed up before the shuffle), which gives each
   different text once with its multiplicity.
2. Tasks tokenise and align those. A text falls into units at blanks and line breaks that
   follow a character which is not white space, and at signs that follow a letter; both
   tokenizers end a token there whatever stands around, so a unit's alignment is that of its place in any text, and each different
   unit of a chunk of texts is aligned once. Tokens that overlap are a link; offsets where
   tokens of both end cut a text into groups.
3. A chunk gives one row for each id pair it holds, with its links weighted by multiplicity.
   Pair counts are summed up over the corpus; a pair is best if no other pair of its B id
   has more. Each chunk asks for the counts of its own pairs, once each, so that a pair that
   stands in every text is one row a chunk and not one a text, and its texts are summed
   up from them.
4. Measures are joined back to the ids by a digest of the text. Texts with very many copies
   are dealt over several join keys.

Nulls: null and empty texts have no tokens (zeros, '' as digest), nor have texts whose
joined token bytes differ from a space and the text (U+2581 in a text is one cause). A null
id is kept as any other. Repeated rows count, and come back, once each. Ties for best all
count. Very long texts are aligned whole, as a chunk of their own. Other columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maillage.llm.bpe import PATTERN, byte_alphabet
from maillage.llm.common import joined_back, joined_bytes, received, send_file, ship, slices, stored

#: Bytes of texts in a chunk, and of units that a tokenizer gets in one call, about.
CHUNK_BYTES, RUN_BYTES = 4 << 20, 1 << 13
#: Signs that start a unit after a letter.
SIGNS = ".,;:!?"
#: What the piece vocabulary writes for a blank.
BLANK = "\u2581"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
#: Code points of white space that UTF-8 writes in three bytes.
WHITE = [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def piece_bytes(piece: str) -> bytes:
    """Bytes that a piece of a byte-fallback vocabulary stands for."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(BLANK, " ").encode()


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Different values of two ascending arrays, ascending."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    return both[np.diff(both, prepend=-1) != 0]


class Tokens:
    """Both tokenizers."""

    def __init__(self, byte_path: str, piece_path: str):
        from sentencepiece import SentencePieceProcessor

        with open(byte_path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if i not in special}
        texts = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            texts[i] = t
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if made == sorted(made) and len(set(made)) == len(made):  # then ids are ranks of merging
            from tiktoken import Encoding

            self.a = Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(byte_path)
            whole.no_truncation()
            whole.no_padding()
            whole.encode_special_tokens = True
            self.a = lambda text: whole.encode(text, add_special_tokens=False).ids
        self.b = SentencePieceProcessor(model_file=piece_path).encode
        pieces = self.b.__self__
        pieces = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        self.texts_a, self.texts_b = texts, [piece_bytes(p) for p in pieces]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.texts_a, self.texts_b))
        digits = [str(i).encode() for i in range(max(len(texts), len(pieces)))]
        self.wide = np.array([len(d) for d in digits])
        self.digits = np.array(digits, dtype=f"S{self.wide.max() + 1}").view(np.uint8).reshape(len(digits), -1)
        # A unit may start where no piece goes on.
        within = {c for p in pieces for c in p.lstrip(BLANK)}
        self.cuts = [ord(c) for c, stands_for in ((" ", BLANK), ("\n", "\n")) if stands_for not in within]
        joint = {p[i] for p in pieces for i in range(1, len(p)) if p[i - 1] in string.ascii_letters}
        self.signs = [ord(c) for c in SIGNS if c not in joint]

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """A ids and B ids of units in a row; None if their bytes are not those of the units."""
        # A unit before them: the piece tokenizer puts a blank before what it gets.
        text = "a" + data.decode()
        found = []
        for ids, texts in ((self.a(" " + text), self.texts_a), (self.b(text, num_threads=1), self.texts_b)):
            if b"".join([texts[i] for i in ids]) != b" a" + data:
                return None
            first = 1 if texts[ids[0]] == b" a" else 2
            found.append(np.array(ids[first:], dtype=np.int64))
        return found[0], found[1]


@cache
def tokens(byte_name: str, piece_name: str) -> Tokens:
    return Tokens(received(byte_name), received(piece_name))


def solid(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each end surely is not white space."""
    p1, p2, p3 = (data[ends - k].astype(np.int64) for k in (1, 2, 3))
    white = [int.from_bytes(chr(c).encode(), "big") for c in WHITE]
    return ((p1 > 0x20) & (p1 < 0x7F)) | ((p1 >= 0x80) & (p2 != 0xC2) & ~np.isin(p3 << 16 | p2 << 8 | p1, white))


def letters(values: np.ndarray) -> np.ndarray:
    return ((values | 0x20) >= ord("a")) & ((values | 0x20) <= ord("z"))


def units(texts: pa.Array, cuts: list[int], signs: list[int]) -> tuple[pa.Array, np.ndarray]:
    """Units of a space and each text, and the range of each text."""
    texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
    _, places, blob = texts.buffers()
    places = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(blob, dtype=np.uint8)[: places[-1]]
    at = np.flatnonzero(np.isin(data, cuts))
    at = at[at > places[0] + 2]
    points = np.flatnonzero(np.isin(data, signs))
    points = points[points > places[0]]
    bounds = merged(merged(at[solid(data, at)], points[letters(data[points - 1])]), places[:-1])
    ranges = np.concatenate((np.searchsorted(bounds, places[:-1]), [len(bounds)]))
    bounds = np.concatenate((bounds, places[-1:])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), blob]), ranges


@dataclass
class Aligned:
    """Different units, aligned: of each its numbers and group text, of each link its unit and pair."""

    bad: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[bytes]  # each group ends with `;`
    unit: np.ndarray
    pair: np.ndarray  # A id << 32 | B id


def aligned(use: Tokens, found: pa.Array) -> Aligned:
    """Alignment of different units.

    Units in a row are given to the tokenizers in one call, where each begins with white
    space and the one before it does not end with it."""
    n = len(found)
    array, sizes = joined_bytes(found)
    ends, data = np.cumsum(sizes), array.tobytes()
    whole = solid(array, np.maximum(ends, 3)) if n and ends[-1] >= 3 else np.zeros(n, dtype=bool)
    whole &= sizes >= 3
    # Units that begin with a sign only stand alone after a letter.
    alone = np.isin(array[ends - sizes], use.signs)
    whole &= ~alone
    whole[:-1] &= ~alone[1:]
    bad = np.zeros(n, dtype=bool)
    ids_a, ids_b, kept = [], [], []

    def encode(low: int, high: int) -> None:
        got = use.of(data[ends[low] - sizes[low] : ends[high - 1]])
        if got is not None:
            ids_a.append(got[0])
            ids_b.append(got[1])
            kept.append(np.arange(low, high))
        elif high - low == 1:
            bad[low] = True
        else:
            encode(low, (low + high) // 2)
            encode((low + high) // 2, high)

    low = 0
    while low < n:
        # A run ends after RUN_BYTES, and with a unit that has an open end.
        high = max(int(np.searchsorted(ends, ends[low] - sizes[low] + RUN_BYTES)), low + 1)
        open_ends = np.flatnonzero(~whole[low:high])
        high = low + int(open_ends[0]) + 1 if len(open_ends) else min(high, n)
        encode(low, high)
        low = high
    of_unit = np.concatenate(kept) if kept else np.zeros(0, dtype=np.int64)
    a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (ids_a, ids_b))
    # Which bytes end a token of A, of B, a unit; how many do so far.
    mark = lambda ends: np.bincount(ends, minlength=total + 1).astype(bool)
    total = int(sizes[of_unit].sum())
    is_a, is_b, is_u = (mark(np.cumsum(x)) for x in (use.sizes_a[a], use.sizes_b[b], sizes[of_unit]))
    both = is_a & is_b
    up_a, up_b, up_u, up_g = (np.cumsum(x, dtype=np.int64) for x in (is_a, is_b, is_u, both))
    # Between two ends next to each other lies one token of A and one of B: a link.
    seams, stops = np.flatnonzero(is_a | is_b), np.flatnonzero(both)
    at_a, at_b = up_a[seams] - is_a[seams], up_b[seams] - is_b[seams]
    unit = of_unit[up_u[seams] - is_u[seams]]
    # Units end where groups do.
    tops = np.flatnonzero(is_u)
    count = lambda up: np.bincount(of_unit, np.diff(up[tops], prepend=0), minlength=n).astype(np.int64)
    # Text of groups: A's ids, then B's, each with the sign that follows it.
    group_a, group_b = (up_g[ends] - both[ends] for ends in (np.flatnonzero(is_a), np.flatnonzero(is_b)))
    place_a = np.arange(len(a)) + np.concatenate(([0], up_b[stops]))[group_a]
    place_b = np.arange(len(b)) + up_a[stops][group_b]
    ids = np.zeros(len(a) + len(b), dtype=np.int64)
    signs = np.full(len(ids), ord(","), dtype=np.uint8)
    ids[place_a], ids[place_b] = a, b
    signs[place_a[up_a[stops] - 1]], signs[place_b[up_b[stops] - 1]] = ord("|"), ord(";")
    wide = use.wide[ids]
    text = use.digits[ids]
    text[np.arange(len(ids)), wide] = signs
    text = text[np.arange(text.shape[1]) <= wide[:, None]].tobytes()
    n_a, n_b = count(up_a), count(up_b)
    cuts = np.concatenate(([0], np.cumsum(wide + 1)))[np.concatenate(([0], np.cumsum(n_a + n_b)))]
    groups = [text[x:y] for x, y in itertools.pairwise(cuts.tolist())]
    return Aligned(bad, n_a, n_b, count(up_g), groups, unit, a[at_a] << 32 | b[at_b])


def chunk_rows(use: Tokens, digests: pa.Array, texts: pa.Array, copies: np.ndarray) -> pa.RecordBatch:
    """Rows of one chunk: its texts, and last its table of units and pairs."""
    flat, ranges = units(texts, use.cuts, use.signs)
    found = flat.dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = aligned(use, found.dictionary)
    bad = np.logical_or.reduceat(of.bad[codes], ranges[:-1])
    links = np.bincount(of.unit, minlength=len(of.bad))
    numbers = [np.where(bad, 0, np.add.reduceat(x[codes], ranges[:-1])) for x in (of.n_a, of.n_b, of.n_groups, links)]
    shas = []
    for wrong, a, b in zip(bad.tolist(), ranges[:-1].tolist(), ranges[1:].tolist(), strict=True):
        here = b"" if wrong else b"".join([of.groups[c] for c in codes[a:b].tolist()])[:-1]
        shas.append("" if wrong else hashlib.sha256(here).hexdigest())
    # Pairs of good texts only: what stands in bad texts is not a link.
    each = np.diff(ranges)
    good = np.repeat(~bad, each)
    weight = np.zeros(len(of.bad), dtype=np.int64)
    np.add.at(weight, codes[good], np.repeat(copies, each)[good])
    pairs, place = np.unique(of.pair, return_inverse=True)
    counts = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(counts, place, weight[of.unit])
    n, none = len(texts), pa.nulls
    ends = pa.array(np.concatenate(([0], np.cumsum(np.where(bad, 0, each)))), pa.int32())
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([digests[0].as_py()] * (n + 1), pa.binary()), pa.concat_arrays([digests.cast(pa.binary()), none(1, pa.binary())]),
            *(pa.concat_arrays([pa.array(x, pa.int64()), none(1, pa.int64())]) for x in (copies, *numbers)),
            pa.array([*shas, None], pa.string()), pa.concat_arrays([pa.ListArray.from_arrays(ends, pa.array(codes[good], pa.int32())), one(of.unit, pa.int32())]),
            pa.concat_arrays([none(n, pa.list_(pa.int32())), one(place, pa.int32())]),
            pa.concat_arrays([none(n, pa.list_(pa.int64())), one(pairs, pa.int64())]), pa.concat_arrays([none(n, pa.list_(pa.int64())), one(counts, pa.int64())]),
        ],
        ["chunk", "digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "units", "places", "pairs", "counts"],
    )


CHUNK = "chunk binary, digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units array<int>, places array<int>, pairs array<long>, counts array<long>"


def chunks(texts: DataFrame, byte_path: str, piece_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of aligned chunks of different texts (text, copies), as chunk_rows gives them.

    A row of a text (digest not null): its numbers and its units; the row of a chunk's table:
    its links as (unit, place of the pair), its pairs and how many links hold them."""
    spark = texts.sparkSession
    ship(spark)
    names = send_file(spark, byte_path), send_file(spark, piece_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = tokens(*names)
        for batch in batches:
            for part in slices(batch, "text", chunk_bytes):
                yield chunk_rows(use, part.column("digest"), part.column("text"), part.column("copies").to_numpy())

    return texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text", "copies").mapInArrow(work, CHUNK)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Rows (pair, count, best) over the corpus; pair: A id << 32 | B id."""
    rows = aligned.where("digest is null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count")).where("count > 0")
    # At most as many rows of one B id as A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def summed(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Texts of one chunk with n_best and count_sum. right: (place, count, best) of its pairs."""
    is_text = pc.is_valid(left.column("digest"))
    table, texts = left.filter(pc.invert(is_text)), left.filter(is_text)
    flat = lambda column: column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    unit, place = flat(table.column("units")), flat(table.column("places"))
    count = np.zeros(int(place.max()) + 1 if len(place) else 0, dtype=np.int64)
    best = np.zeros(len(count), dtype=np.int64)
    at = right.column("place").to_numpy()
    count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
    codes = flat(texts.column("units"))
    units = int(max(unit.max(initial=-1), codes.max(initial=-1))) + 1
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(texts.column("units")).to_numpy())))
    out = {c: texts.column(c) for c in ("digest", "copies", "n_a", "n_b", "n_groups", "n_links")}
    for name, values in (("n_best", best), ("count_sum", count)):
        of_unit = np.zeros(units, dtype=np.int64)
        np.add.at(of_unit, unit, values[place])
        so_far = np.concatenate(([0], np.cumsum(of_unit[codes])))
        out[name] = pa.array(so_far[ends[1:]] - so_far[ends[:-1]], pa.int64())
    return pa.table({**out, "groups_sha256": texts.column("groups_sha256")})


def measured(texts: DataFrame, byte_path: str, piece_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (digest, copies, measures) of different texts (text, copies)."""
    aligned = stored(chunks(texts, byte_path, piece_path, chunk_bytes))
    counts = stored(pair_counts(aligned))
    asked = aligned.where("digest is null").select(F.col("chunk").alias("asking"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("asking", "place", "count", "best")
    rows = aligned.select("chunk", "digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "units", "places")
    kind = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("chunk").cogroup(answers.groupBy("asking")).applyInArrow(summed, kind)


def alignments(df: DataFrame, byte_path: str, piece_path: str, text: str = "text", key: str = "doc_id", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of all rows of df."""
    docs = df.select(df[key].alias("key"), df[text].alias("text"))
    some = docs.where("text <> ''")
    found = stored(measured(some.groupBy("text").agg(F.count("*").alias("copies")), byte_path, piece_path, chunk_bytes))
    digest = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
    rows = joined_back(docs.select("key", digest.alias("digest")), found.drop("copies"), "digest", found.select("digest", "copies"))
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in MEASURES]
    return rows.select(F.col("key").alias(key), *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
