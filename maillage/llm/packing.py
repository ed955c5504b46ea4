"""Operator 1: best-fit packing of tokenised documents in bulk-synchronous rounds.

1. Tokenise: each document becomes pieces of at most `capacity` tokens.
2. Deal pieces over shards by a hash of their key, as many shards as the number of pieces
   asks for, and rank the pieces of one length within a shard. Pieces of one length are a
   run; they are interchangeable, so a shard's runs, at most `capacity` rows, are all that
   the matching needs, whatever its number of pieces.
3. Match, each shard in a task of its own: runs of pieces and runs of gaps are sorted by
   size, and a sweep from large to small gives each piece the smallest free gap that
   holds it (its successor). Where more pieces than gaps meet, ranks decide: the first
   ranks are placed, the rest go on to the next larger gap or the next round. Gaps are updated
   and the sweep is repeated until nothing moves; what then remains of the round's size
   class opens new sequences. Size classes go from large to small.
4. Each piece looks up its rank's placement: placements are runs of ranks, found by the
   last one that starts at or before the piece's rank, in one window over (shard, length).

A shard loses at most its last, not full sequence against one shard for all.

Nulls: a null text is packed as an empty one, a null key stays null. Empty documents have
one token, the closing id. Repeated rows are packed once each. Texts are never cut but
into pieces. Ties (equal lengths) go by key, then piece. An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maillage.llm.bpe import byte_alphabet
from maillage.llm.common import Words, joined_bytes, received, send_file, ship, slices, stored, taken

CAPACITY = 4096
#: Expected number of pieces in a shard.
SHARD_PIECES = 250_000
#: What closes a word for the encoder (a control character, so not in a usual unit).
END = "\x01"
#: Kinds of bytes of units: letters (Latin ones of two bytes too), digits, signs, others.
LETTER, DIGIT, SIGN, OTHER = range(4)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[0x21:0x7F] = SIGN
KINDS[ord("0") : ord("9") + 1] = DIGIT
for _low, _high in ((ord("A"), ord("Z")), (ord("a"), ord("z")), (0x80, 0xBF), (0xC3, 0xC8)):
    KINDS[_low : _high + 1] = LETTER


class Tokens:
    """Ids of a word-level vocabulary file.

    The vocabulary drops white space and ends each word with a token that says so. The units
    of a batch (runs without white space), each different one once, are split into words that
    an END closes, and joined into one string; as END merges with a word's last byte before
    all else, ranks of merging by ids give the vocabulary's tokens of all words in one call. The
    last tokens of words tell the units apart again."""

    #: Fixed value: how this kind of vocabulary splits normalised text into words.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["model"]
        of, close = byte_alphabet(), spec.get("end_of_word_suffix") or "</w>"
        vocab: dict[str, int] = spec["vocab"]
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["merges"]]
        made = [vocab[m] for m in merges]
        ranks, closing = {}, []
        for token, i in vocab.items():
            word, last = (token[: -len(close)], END) if token.endswith(close) and token != close else (token, "")
            if token not in self.special and all(c in of for c in word):
                ranks[bytes(of[c] for c in word) + last.encode()] = i
                closing += [i] * bool(last)
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[closing] = True
        single = [i for t, i in ranks.items() if len(t) == 1 or (len(t) == 2 and t.endswith(END.encode()))]
        #: Whether ids are ranks of merging, single bytes first; else the library encodes all.
        self.ranked = made == sorted(set(made)) and len(single) == 512 and max(single) < made[0]
        self.encode_words = Encoding("words", pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={}).encode_ordinary if self.ranked else None

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def closed(self, units: pa.Array) -> tuple[str, np.ndarray]:
        """Units in a row, each word closed by END, and their numbers of words."""
        data, sizes = joined_bytes(pc.utf8_lower(units))
        kind = KINDS[data]
        ends = np.ones(len(data), dtype=bool)
        ends[:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        stops = np.cumsum(sizes)
        ends[stops - 1] = True
        out = np.full(len(data) + int(ends.sum()), ord(END), dtype=np.uint8)
        out[np.arange(len(data)) + np.cumsum(ends) - ends] = data
        return out.tobytes().decode(), np.diff(np.cumsum(ends)[stops - 1], prepend=0)

    def split(self, units: pa.Array) -> tuple[str, np.ndarray]:
        """The same by PATTERN, for units with apostrophes and signs among letters."""
        closed = pc.replace_substring_regex(pc.utf8_lower(units), f"({self.PATTERN})", rf"\1{END}")
        return "".join(closed.to_pylist()), pc.count_substring(closed, END).to_numpy(zero_copy_only=False)

    def units(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different units in a row, and where each unit's start and how many they are."""
        n = len(found)
        if not n:
            return (np.zeros(0, dtype="<u4"), *(np.zeros(0, dtype=np.int64) for _ in range(2)))
        data, sizes = joined_bytes(found)
        firsts = np.cumsum(sizes) - sizes
        before = np.concatenate(([0], data[:-1]))
        # Other scripts and controls are left to the library, and I with a dot (two letters in lower case).
        odd = np.logical_or.reduceat((KINDS[data] == OTHER) | ((before == 0xC4) & (data == 0xB0)), firsts)
        for special in self.special:
            odd |= pc.match_substring(found, special).to_numpy(zero_copy_only=False)
        odd |= not self.ranked
        signs = (data == ord("'")) | ((before == 0xC3) & ((data == 0x97) | (data == 0xB7)))
        slow = np.logical_or.reduceat(signs, firsts) & ~odd
        starts, lengths = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        parts, total = [], 0
        for which, close in ((~odd & ~slow, self.closed), (slow, self.split)):
            if which.any():
                text, words = close(found.filter(pa.array(which)))
                ids = np.array(self.encode_words(text), dtype="<u4")
                ends = np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1))[np.concatenate(([0], np.cumsum(words)))]
                starts[which], lengths[which] = total + ends[:-1], np.diff(ends)
                parts.append(ids)
                total += len(ids)
        for i in np.flatnonzero(odd).tolist():
            parts.append(self._whole(found[i].as_py()))
            starts[i], lengths[i] = total, len(parts[-1])
            total += lengths[i]
        return np.concatenate(parts), starts, lengths

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts (null: none) as little-endian unsigned 32-bit integers."""
        words = Words(texts)
        found, codes = words.coded()
        return taken(*self.units(found), codes, words.offsets)


@cache
def tokens(name: str) -> Tokens:
    return Tokens(received(name))


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, closing: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32) of the tokenised documents, each closed by an id."""
    ship(df.sparkSession)
    name = send_file(df.sparkSession, path)
    end = np.array([closing], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = tokens(name)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, nth, starts, lengths, crcs = [], [], [], [], []
                for i, ids in enumerate(use.encode(part.column("text"))):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at : at + 4 * capacity]
                        rows.append(i)
                        nth.append(n)
                        starts.append(at // 4)
                        lengths.append(len(cut) // 4)
                        crcs.append(zlib.crc32(cut))
                columns = [part.column("key").take(pa.array(rows, pa.int64())), pa.array(nth, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "piece", "start", "length", "ids_crc32"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(work, f"key {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("key", key)


def match_runs(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, how many, first sequence, offset) of runs of pieces.

    The first of `how many` ranks goes to the first sequence, and so on; a placement fills
    that many sequences of one gap at one offset."""
    out: list[tuple[int, int, int, int, int]] = []
    waiting = {int(n): [0, int(c)] for n, c in zip(lengths, counts, strict=True) if c}  # length: first rank, pieces
    gaps: list[tuple[int, int, int]] = []  # gap, first sequence, sequences
    opened = 0

    def sweep(low: int, high: int) -> bool:
        """One round: each gap takes one piece with a length in (low, high] at most."""
        nonlocal gaps
        runs = sorted((n for n in waiting if low < n <= high), reverse=True)
        open_gaps = sorted(gaps)
        stack: list[tuple[int, int, int]] = []
        updated: list[tuple[int, int, int]] = []
        moved = False
        for length in runs:
            while open_gaps and open_gaps[-1][0] >= length:
                stack.append(open_gaps.pop())  # the smallest that fits ends on top
            first, left = waiting[length]
            while left and stack:
                gap, sequence, free = stack.pop()
                n = min(left, free)
                out.append((length, first, n, sequence, capacity - gap))
                if gap > length:
                    updated.append((gap - length, sequence, n))
                if n < free:
                    stack.append((gap, sequence + n, free - n))
                first, left, moved = first + n, left - n, True
            waiting[length] = [first, left]
            if not left:
                del waiting[length]
        gaps = open_gaps + stack + updated
        return moved

    high = capacity
    share = 1
    while waiting:
        low = capacity // (share + 1) if share < 64 else 0  # this many fit into a sequence
        while sweep(low, high):
            pass
        rest = sorted((n for n in waiting if low < n <= high), reverse=True)
        while rest:
            # Open sequences for the largest that are left, then let the others fill them.
            length = rest[0]
            first, left = waiting[length]
            n = -(-left // (capacity // length))
            out.append((length, first, n, opened, 0))
            if length < capacity:
                gaps.append((capacity - length, opened, n))
            opened += n
            waiting[length] = [first + n, left - n]
            if left == n:
                del waiting[length]
            while sweep(low, high):
                pass
            rest = sorted((n for n in waiting if low < n <= high), reverse=True)
        high, share = low, share + 1
        if high == 0:
            break
    return out


def packed(parts: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, key: str = "doc_id") -> DataFrame:
    """The pieces with sequence_id and offset. Sequence ids: shard * 2^40 + number."""
    ship(parts.sparkSession)
    # The number of a row deals repeated rows over the shards as well; it is written down.
    parts = stored(parts.withColumn("_nth", F.monotonically_increasing_id()))
    shards = max(1, -(-parts.count() // shard_pieces))
    parts = parts.withColumn("shard", F.pmod(F.xxhash64(key, "piece", "ids_crc32", "_nth"), F.lit(shards)).cast("int"))
    runs = parts.groupBy("shard", "length").agg(F.count("*").alias("n"))

    def work(runs: pd.DataFrame) -> pd.DataFrame:
        rows = match_runs(runs["length"].to_numpy(), runs["n"].to_numpy(), capacity)
        found = pd.DataFrame(rows, columns=["length", "rank", "n", "sequence", "offset"])
        found.insert(0, "shard", runs["shard"].iloc[0])
        return found

    placed = runs.groupBy("shard").applyInPandas(work, "shard int, length long, rank long, n long, sequence long, offset long")
    of_run = Window.partitionBy("shard", "length")
    ranked = parts.withColumn("rank", F.row_number().over(of_run.orderBy(key, "piece", "ids_crc32", "_nth")).cast("long") - 1)
    both = ranked.withColumn("place", F.lit(None).cast("struct<rank:long,sequence:long,offset:long>")).unionByName(
        placed.select("shard", "length", "rank", F.struct("rank", "sequence", "offset").alias("place")), allowMissingColumns=True
    )
    found = F.last("place", ignorenulls=True).over(of_run.orderBy("rank", F.col("place").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("found", found).where("place is null")
    sequence = F.shiftleft(F.col("shard").cast("long"), 40) + F.col("found.sequence") + F.col("rank") - F.col("found.rank")
    return out.select(key, "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), F.col("found.offset").alias("offset"))
