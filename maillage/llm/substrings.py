"""Operator 2: removal of passages that already stand earlier, by FM-indexes of shards.

A window is `length` consecutive words of one document. A window whose words also start
earlier (in a document with a smaller key, or earlier in its own) goes, with every word it
covers. How the windows meet:

1. Stretches. Each window is named by the least hash of the `gram`-word grams in it (its
   anchor), so equal windows have equal anchors. Successive windows with one anchor, at
   most MOST of them, make a stretch; it has their words. Of equal stretches only the
   first is looked into further: in the others every window goes. This is done in each
   batch before anything is shuffled, so a passage that stands in a third of all documents
   costs a row a batch; then over all batches.
2. Shards. Stretches whose anchor stands at several places are sent, with their words, to
   the shard of their anchor. A shard holds whole anchors, about SHARD_WORDS words.
3. FM-index. Each shard is indexed: suffix array, Burrows-Wheeler transform in a wavelet
   matrix with ranked bit blocks. Its stretches are streamed from their ends by backward
   search, all in step; when a match is longer than `length`, it is widened to the rows
   that share `length` words. That gives for each window the interval of all its places;
   if the least of them is before its own place, the window goes.
4. The windows that go, grouped by document, are joined to the texts, whose words are
   taken out.

Words are compared as text in the index; hashes only choose who meets whom. Documents are
told apart by key and a hash of their text, so a repeated row is treated like its twin
(neither is before the other), and rows with one key and different texts are different
documents of equal rank, of which the smaller hash counts as the earlier. A null key
comes after all others; documents without a key are told apart by 69 bits of two hashes.
Null and empty texts have no words. Texts of any length are taken whole. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.llm.common import Words, ship, slices, stored

LENGTH = 20
GRAM = 8
#: Windows of a stretch.
MOST = 16
SHARD_WORDS = 1_000_000
LAST_KEY = (1 << 63) - 1
#: Bits of a text's hash that tell documents of one key apart, and of another one in the
#: stead of a null key. With the start of a stretch (30 bits: a text of 2 GB has fewer words)
#: and its windows, the first make one number, in the order of documents and starts.
MARK_BITS, NULL_BITS, START_BITS = 29, 40, 30


class Bits:
    """Bit vector with constant-time rank: 64-bit blocks and counts before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class WaveletMatrix:
    """Occurrences of a symbol before a place, over any alphabet of integers."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.depth = max(int(largest).bit_length(), 1)
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.depth)):
            bits = (symbols >> level & 1).astype(np.uint8)
            self.levels.append((Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels, strict=True):
            ones = bits.rank(i)
            i = np.where(symbol >> level & 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """FM-index of stretches of words. codes: words as 1, 2, ...; offsets: where stretches begin and end."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, length: int):
        counts = np.diff(offsets)
        stretches = len(counts)
        self.starts = offsets[:-1] + np.arange(stretches)  # in the indexed text, which has a mark after each stretch
        n = len(codes) + stretches
        text = np.zeros(n, dtype=np.int64)
        place = np.arange(len(codes)) + np.repeat(np.arange(stretches), counts)
        text[place] = codes
        # Ranks by the first 1, 2, 4, ... symbols; marks are all different, so no two
        # suffixes agree beyond a stretch.
        rank = text + stretches
        rank[self.starts + counts] = np.arange(stretches)
        self.length, seen, by_length = length, 1, None
        while True:
            if 2 * seen > length and by_length is None:
                by_length = rank, length - seen
            second = np.zeros(n, dtype=np.int64)
            second[:-seen] = rank[seen:] + 1
            key = rank * (n + stretches + int(codes.max(initial=0)) + 2) + second
            order = np.argsort(key)
            ordered = key[order]
            new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            seen *= 2
            if new[-1] == n - 1 and by_length is not None:
                break
        self.rows = order  # the suffix array
        first, shift = by_length
        along = np.minimum(order + shift, n - 1)
        same = (first[order[1:]] == first[order[:-1]]) & (first[along[1:]] == first[along[:-1]])
        self.group = np.concatenate(([0], np.cumsum(~same)))  # rows that share their first `length` symbols
        self.group_starts = np.flatnonzero(np.concatenate(([True], ~same)))
        self.group_ends = np.append(self.group_starts[1:], n)
        last = text[order - 1]
        self.wavelet = WaveletMatrix(last, int(text.max(initial=0)))
        totals = np.bincount(text, minlength=int(text.max(initial=0)) + 1)
        self.before = np.cumsum(totals) - totals  # rows of smaller symbols
        self.zero = self.wavelet.walk(np.arange(len(totals)), np.zeros(len(totals), dtype=np.int64))

    def extend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.wavelet.walk(symbol, i) - self.zero[symbol]

    def matching(self, codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Streams stretches from their ends, all in step. Gives, step by step, stretches,
        places in them, and the first and last (excluded) row of the suffixes that share
        `length` words from there; a stretch that stops matching starts anew."""
        ends = offsets[1:].copy()
        alive = np.flatnonzero(ends > offsets[:-1])
        low, high, depth = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.rows)), np.zeros(len(ends), np.int64)
        while len(alive):
            ends[alive] -= 1
            symbol = codes[ends[alive]]
            a, b = self.extend(symbol, low[alive]), self.extend(symbol, high[alive])
            empty = a >= b
            a[empty], b[empty] = 0, len(self.rows)
            depth[alive] = np.where(empty, 0, depth[alive] + 1)
            long = depth[alive] > self.length
            group = self.group[a[long]]
            a[long], b[long] = self.group_starts[group], self.group_ends[group]
            low[alive], high[alive] = a, b
            found = depth[alive] >= self.length
            depth[alive] = np.minimum(depth[alive], self.length)
            if found.any():
                who = alive[found]
                yield who, ends[who] - offsets[who], a[found], b[found]
            alive = alive[ends[alive] > offsets[alive]]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sums(values: np.ndarray, width: int) -> np.ndarray:
    """Order-aware hash of each `width` values in a row, wrapping."""
    out = np.zeros(max(len(values) - width + 1, 0), dtype=np.uint64)
    factor = 1
    for k in range(width):
        out += values[k : k + len(out)] * np.uint64(factor)
        factor = factor * 0x100000001B3 % (1 << 64)
    return _mixed(out)


def word_hashes(words: Words) -> np.ndarray:
    found, codes = words.coded()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in found.cast(pa.large_binary()).to_pylist()), dtype=np.uint64, count=len(found))[codes]


def stretches_of(words: Words, length: int, gram: int) -> dict[str, np.ndarray]:
    """Stretches of texts: text number, start, windows, anchor, content hash, and whether
    the anchor stands in them more than once."""
    hashes = word_hashes(words)
    counts = np.diff(words.offsets)
    grams = _sums(hashes, gram)
    least, width, want = grams, 1, length - gram + 1
    while width < want:
        step = min(width, want - width)
        least = np.minimum(least[: max(len(least) - step, 0)], least[step:])
        width += step
    windows = np.maximum(counts - length + 1, 0)
    ends = np.cumsum(windows)
    text = np.repeat(np.arange(len(counts)), windows)
    begin = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - windows, windows)
    at = begin + np.repeat(words.offsets[:-1], windows)
    anchor = least[at]
    cut = np.ones(len(at), dtype=bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(cut)
    since = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(cut | (since % MOST == 0))
    n = np.diff(np.append(first, len(at)))
    start, anchor = at[first], anchor[first]
    # Content: the hashes of all windows, by differences of a running sum.
    whole = _sums(hashes, length)
    content = np.zeros(len(first), dtype=np.uint64)
    repeats = np.zeros(len(first), dtype=np.int64)
    for k in range(MOST):
        on = np.flatnonzero(n > k)
        content[on] = _mixed(content[on] * np.uint64(31) + whole[start[on] + k] + np.uint64(k))
    for k in range(MOST + length - gram):
        on = np.flatnonzero(n + length - gram > k)
        repeats[on] += grams[start[on] + k] == anchor[on]
    return {"text": text[first], "start": begin[first], "n": n, "anchor": anchor, "content": content, "again": repeats > 1}


def _place(start: np.ndarray, mark: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits of the text's hash, start and number of windows in one sortable number."""
    return mark.astype(np.int64) << START_BITS + 4 | start.astype(np.int64) << 4 | (n.astype(np.int64) - 1)


def _unplace(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return place >> 4 & (1 << START_BITS) - 1, (place & 15) + 1


def identity(df: DataFrame, text: str, key: str) -> list[Column]:
    """key without null, and mark: together they name a document."""
    unnamed = F.lit(LAST_KEY) - F.pmod(F.xxhash64(df[text], F.lit(1)), F.lit(1 << NULL_BITS))
    mark = F.pmod(F.xxhash64(df[text]), F.lit(1 << MARK_BITS))
    return [F.coalesce(df[key].cast("long"), unnamed).alias("key"), mark.alias("mark")]


def keyed(df: DataFrame, text: str, key: str) -> DataFrame:
    """(key, mark, text, id): what names a document, its text, and its key as it is."""
    return df.select(*identity(df, text, key), df[text].alias("text"), df[key].alias("id"))


def places(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (key, place, anchor, goes) of stretches that need a look: `goes`: all its
    windows go; else it is the first of its kind, and is to be searched for."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                s = stretches_of(words, length, gram)
                key, mark = (part.column(c).to_numpy()[s["text"]] for c in ("key", "mark"))
                found.append((s["anchor"], s["content"], key, _place(s["start"], mark, s["n"]), s["again"]))
            if not found:
                continue
            anchor, content, key, place, again = map(np.concatenate, zip(*found, strict=True))
            # Of equal stretches in the batch, all but the first (and its twins) go.
            order = np.lexsort((place, key, content, anchor))
            anchor, content, key, place, again = (x[order] for x in (anchor, content, key, place, again))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            goes = (key != key[head]) | (place != place[head])
            weight = np.ones(len(order), dtype=np.int32)
            np.add.at(weight, head[~new], 1)
            weight = np.minimum(weight + again, 2)
            keep = new | goes
            # What goes already needs no partner: it is spread by its place.
            anchor = np.where(goes, _mixed(place.astype(np.uint64) ^ key.astype(np.uint64)), anchor)
            weight = np.where(goes, 0, weight)
            columns = (anchor.view(np.int64), content.view(np.int64), key, place, weight.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["anchor", "content", "key", "place", "weight"])

    rows = docs.mapInArrow(work, "anchor long, content long, key long, place long, weight int")
    alike = Window.partitionBy("anchor", "content")
    rows = rows.withColumn("head", F.min(F.when(F.col("weight") > 0, F.struct("key", "place"))).over(alike)).withColumn("total", F.sum("weight").over(Window.partitionBy("anchor")))
    is_head = F.col("head").eqNullSafe(F.struct("key", "place"))
    goes = (F.col("weight") == 0) | ~is_head
    return rows.where(goes | (F.col("total") > 1)).select("key", "place", "anchor", goes.alias("goes"))


def search(stretches: pd.DataFrame, length: int) -> pd.DataFrame:
    """One shard: windows (key, place) of its stretches that also start earlier."""
    stretches = stretches.drop_duplicates(["key", "place"])
    key, place = stretches["key"].to_numpy(), stretches["place"].to_numpy()
    words = Words(pa.array(stretches["words"], pa.large_string()))
    codes = words.coded()[1].astype(np.int64) + 1
    index = FMIndex(codes, words.offsets, length)
    # Places in the order of documents and starts, for every row of the index.
    start, _ = _unplace(place)
    counts = np.diff(words.offsets) + 1  # with the mark after it
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owner)) - index.starts[owner]
    mark = place >> START_BITS + 4
    order = np.lexsort((start[owner] + within, mark[owner], key[owner]))
    standing = np.empty(len(order), dtype=np.int64)
    standing[order] = np.arange(len(order))
    # A window of two stretches that overlap stands at one place.
    a, b = order[1:], order[:-1]
    other = (key[owner[a]] != key[owner[b]]) | (mark[owner[a]] != mark[owner[b]]) | (start[owner[a]] + within[a] != start[owner[b]] + within[b])
    standing[order] = np.concatenate(([0], np.cumsum(other)))
    least = np.minimum.reduceat(standing[index.rows], index.group_starts)
    out = []
    for who, at, low, _ in index.matching(codes, words.offsets):
        earlier = least[index.group[low]] < standing[index.starts[who] + at]
        who, at = who[earlier], at[earlier]
        out.append((key[who], _place(start[who] + at, mark[who], np.ones(len(who), dtype=np.int64))))
    keys, found = map(np.concatenate, zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2
    return pd.DataFrame({"key": keys, "place": found})


def doubled(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (key, mark, places): windows of each document that also start earlier."""
    ship(docs.sparkSession)
    seen = stored(places(docs, length, gram))
    mark = F.shiftright("place", START_BITS + 4).alias("mark")
    heads = seen.where("not goes").groupBy("key", mark).agg(F.collect_list(F.struct("place", "anchor")).alias("heads"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                heads = part.column("heads")
                row = pc.list_parent_indices(heads).to_numpy()
                items = pc.list_flatten(heads)
                place, anchor = (items.field(k).to_numpy() for k in (0, 1))
                start, n = _unplace(place)
                begin = words.offsets[row] + start
                sizes = n + length - 1
                ends = np.cumsum(sizes)
                which = np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), words.flat.take(pa.array(which)).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row)), pa.array(place), pa.array(anchor), pc.binary_join(lists, " ")], ["key", "place", "anchor", "words"])

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            waiting.append(frame)
            size += int(_unplace(frame["place"].to_numpy())[1].sum()) + length * len(frame)
            if size < SHARD_WORDS:
                continue
            both = pd.concat(waiting, ignore_index=True)
            rest = both["anchor"] == both["anchor"].iloc[-1]  # its stretches may go on
            if not rest.all():
                yield search(both[~rest], length)
                both = both[rest]
            waiting, size = [both], int(_unplace(both["place"].to_numpy())[1].sum()) + length * len(both)
        if size:
            yield search(pd.concat(waiting, ignore_index=True), length)

    cuts = docs.join(heads, ["key", "mark"]).select("key", "text", "heads").mapInArrow(cut, "key long, place long, anchor long, words string")
    searched = cuts.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(shards, "key long, place long")
    gone = seen.where("goes").select("key", "place").union(searched)
    return gone.groupBy("key", mark).agg(F.collect_list("place").alias("places"))


def take_out(texts: pa.Array, places: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, how many go, and the others joined by a space."""
    words = Words(texts)
    row = pc.list_parent_indices(places).to_numpy()
    start, n = _unplace(pc.list_flatten(places).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = words.offsets[row] + start
    change = np.zeros(len(words.flat) + 1, dtype=np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + n + length - 1, -1)
    stays = np.cumsum(change)[:-1] == 0
    counts = np.diff(words.offsets)
    left = np.concatenate(([0], np.cumsum(stays)))[words.offsets]
    words.flat, words.offsets = words.flat.filter(pa.array(stays)), left
    return counts, counts - np.diff(left), words.joined().cast(pa.string())


def thinned(df: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, n_words, n_removed, kept): the words left of each document, joined by a space."""
    ship(df.sparkSession)
    docs = keyed(df, text, key)
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, removed, kept = take_out(part.column("text"), part.column("places"), length)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(counts), pa.array(removed), kept], ["id", "n_words", "n_removed", "kept"])

    out = docs.join(doubled(docs, length, gram), ["key", "mark"], "left").select("id", "text", "places").mapInArrow(work, f"id {kind}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", key)


def cleaned(df: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", key: str = "doc_id", chars: str = "n_chars") -> DataFrame:
    """The table with repeated passages taken out of its texts: the words left, joined by
    a space, where something went (`chars`: code points of the new text); as it is elsewhere."""
    ship(df.sparkSession)
    names, own = df.columns, keyed(df, text, key)
    rows = df.select(F.struct(*names).alias("row"), *identity(df, text, key))
    met = rows.join(doubled(own, length, gram), ["key", "mark"], "left").select(F.col(f"row.{text}").alias("text"), "places", "row")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, removed, kept = take_out(part.column("text"), part.column("places"), length)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(removed > 0), kept], ["row", "less", "kept"])

    out = met.mapInArrow(work, T.StructType([T.StructField("row", df.schema), T.StructField("less", T.BooleanType()), T.StructField("kept", T.StringType())]))
    new = {text: F.when(F.col("less"), F.col("kept")).otherwise(F.col(f"row.{text}"))}
    if chars in names:
        new[chars] = F.when(F.col("less"), F.length("kept").cast("long")).otherwise(F.col(f"row.{chars}"))
    return out.select(*(new.get(n, F.col(f"row.{n}")).alias(n) for n in names))
