"""Operator 9: WARC archives with a two-level capture index.

Writing. Every page becomes a WARC/1.1 record, gzipped on its own, in archives that tasks
write to the shared folder; the row of a record says in which archive it is, where, and
how long. Of records with equal payloads of at least `least` bytes the one with the
smallest page id is a response, the others revisit it (no payload, a reference to it).

Index. Captures are sorted by their reversed-host key (`com,example,www)/path`) and page
id over all partitions, and cut into blocks of BLOCK_LINES lines, each compressed; the
block directory, one line a block (its first key, its number), is the sparse upper level.
Both are Parquet tables in the order of the keys.

Reading. A lookup finds, by binary search in the (distributed, sorted) directory, the
blocks that can hold its key, opens only these, and reads only its records' byte ranges.
Reading all captures opens all blocks, and reads each archive's ranges in order.

An attempt of a task writes an archive of its own name, and rows only name archives of
attempts that succeeded; so lost executors leave unused files, never wrong rows.

Nulls: a null html is an empty payload, a null url an empty target with the key ")/". A
null page id is written like others, sorts before all and is the response of its payload.
Repeated rows (same id and payload) are all written, and are all responses where the
first is. Long payloads are kept whole. An empty table gives no archives.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.llm.common import shared_dir, ship, slices, stored

#: Payloads shorter than this are never revisited.
LEAST = 100
#: Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 64 << 20
BLOCK_LINES = 500
#: Date of all captures: the tables have none, and archives should not depend on the clock.
DATE = "2026-01-01T00:00:00Z"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder's file."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def host_key(url: str | None) -> str:
    """Sortable key of an address: host labels reversed, no scheme, no www, no fragment."""
    try:
        found = urlsplit((url or "").strip())
        host, port = (found.hostname or "").lower().rstrip("."), found.port
    except ValueError:
        return f")/{url}"
    labels = host.split(".") if host else []
    if len(labels) > 2 and labels[0] == "www":
        labels = labels[1:]
    key = ",".join(reversed(labels)) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){found.path or '/'}" + (f"?{found.query}" if found.query else "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC record, with HTTP header and payload, gzipped as a member of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    name = "null" if page_id is None else page_id
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> dict:
    """Headers (lower case), HTTP header and payload of a gzipped record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record starts here")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record is not as long as it says")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return headers | {"http": http.decode(), "payload": payload}


def marked(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages (page_id, url, html, digest, revisit, refers_to). The first of each payload is
    found by a minimum that is summed up before the shuffle, and joined back by an
    equi-join whose skewed side Spark can split."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("at", F.coalesce("page_id", F.lit(-(1 << 63))))
    long = F.octet_length("html") >= least
    firsts = rows.where(long).groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    met = rows.join(firsts, "digest", "left")
    is_first = F.col("first").isNull() | ~long | (F.col("at") == F.col("first"))
    return met.select("page_id", "url", "html", "digest", "at", is_first.alias("is_first"), F.when(long, F.col("first")).alias("first"))


def written(pages: DataFrame, root: str | None = None, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives below `root` (default: a new folder in the shared one). Captures
    (host_key, page_id, url, archive, offset, length), stored."""
    spark = pages.sparkSession
    ship(spark)
    base = root or f"{shared_dir(spark)}/maillage-warc-{uuid.uuid4().hex}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, size, raw = None, "", 0, 0
        for batch in batches:
            for part in slices(batch, "html"):
                rows: list[tuple] = []
                for page_id, url, html, digest, at, is_first, first in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if out is None:
                        store, path = place(base)
                        store.create_dir(path, recursive=True)
                        name, size, raw = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(place(name)[1], compression=None)
                    payload = html.encode()
                    member = record(page_id, url, payload, digest, None if first == -(1 << 63) else first, not is_first)
                    out.write(member)
                    rows.append((host_key(url), page_id, url, name, size, len(member)))
                    size, raw = size + len(member), raw + len(payload)
                    if raw >= archive_bytes:
                        out.close()
                        out = None
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), part.column("page_id"), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.int64())], ["host_key", "page_id", "url", "archive", "offset", "length"])
        if out is not None:
            out.close()

    kind = pages.schema["page_id"].dataType.simpleString()
    return stored(marked(pages, least).mapInArrow(work, f"host_key string, page_id {kind}, url string, archive string, offset long, length long"))


def indexed(captures: DataFrame, block_lines: int = BLOCK_LINES) -> tuple[DataFrame, DataFrame]:
    """The two levels: blocks (part, block, first_key, last_key, lines, data) and the
    directory (part, first_key, last_key, block), in parts by ranges of keys, stored."""
    ship(captures.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None

        part = TaskContext.get().partitionId()

        def block(rows: pd.DataFrame) -> dict:
            text = io.StringIO()
            rows[["host_key", "page_id", "archive", "offset", "length"]].to_json(text, orient="values", force_ascii=False)
            return {"part": part, "block": uuid.uuid4().hex, "first_key": rows["host_key"].iloc[0], "last_key": rows["host_key"].iloc[-1], "lines": len(rows), "data": zlib.compress(text.getvalue().encode(), 6)}

        for frame in frames:
            frame = frame.astype({"page_id": "Int64"})
            both = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            full = len(both) // block_lines * block_lines
            if full:
                yield pd.DataFrame([block(both.iloc[i : i + block_lines]) for i in range(0, full, block_lines)])
            rest = both.iloc[full:]
        if rest is not None and len(rest):
            yield pd.DataFrame([block(rest)])

    order = ["host_key", "page_id", "archive", "offset"]
    sorted_rows = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = stored(sorted_rows.mapInPandas(work, "part int, block string, first_key string, last_key string, lines int, data binary"))
    return blocks, stored(blocks.select("part", "first_key", "last_key", "block"))


def opened(blocks: DataFrame) -> DataFrame:
    """The captures in blocks: (host_key, page_id, archive, offset, length)."""
    ship(blocks.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        for batch in batches:
            for data in batch.column("data").to_pylist():
                rows = json.loads(zlib.decompress(data))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["host_key", "page_id", "archive", "offset", "length"])

    return blocks.select("data").mapInArrow(work, "host_key string, page_id long, archive string, offset long, length long")


def records(captures: DataFrame) -> DataFrame:
    """Reads captures' byte ranges: (page_id, target, record_type, payload, payload_digest, payload_bytes, refers_to)."""
    ship(captures.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = []
                for page_id, archive, offset, length in zip(*(batch.slice(at, 500).column(c).to_pylist() for c in ("page_id", "archive", "offset", "length")), strict=True):
                    if archive != name:
                        if file is not None:
                            file.close()
                        store, path = place(archive)
                        name, file = archive, store.open_input_file(path)
                    file.seek(offset)
                    got = parsed(file.read(length))
                    if got["warc-record-id"] != f"<urn:page:{'null' if page_id is None else page_id}>":
                        raise ValueError(f"{archive} has another record at {offset}")
                    refers = got.get("warc-refers-to", "<urn:page:null>")[len("<urn:page:") : -1]
                    size = int(got["http"].rpartition("Content-Length: ")[2].split("\r\n")[0])
                    payload = got["payload"] if got["warc-type"] == "response" else None
                    if payload is not None and (len(payload) != size or f"sha256:{hashlib.sha256(payload).hexdigest()}" != got["warc-payload-digest"]):
                        raise ValueError(f"the payload at {offset} of {archive} is not what its digest says")
                    rows.append((page_id, got["warc-target-uri"], got["warc-type"], payload, got["warc-payload-digest"].removeprefix("sha256:"), size, None if refers == "null" else int(refers)))
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "target", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to"])
        if file is not None:
            file.close()

    narrow = captures.select("page_id", "archive", "offset", "length").repartition("archive").sortWithinPartitions("archive", "offset")
    return narrow.mapInArrow(work, "page_id long, target string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long")


def looked_up(blocks: DataFrame, directory: DataFrame, urls: DataFrame) -> DataFrame:
    """Captures of the addresses in `urls` (url). Keys are searched for in the first and
    last keys of the directory's parts (one pair a part), then in the lines of the parts
    that can hold them; only the blocks found are opened."""
    ship(urls.sparkSession)
    parts = sorted((r["first"], r["last"], r["part"]) for r in directory.groupBy("part").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).collect())
    firsts, lasts, numbers = [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts]

    @F.pandas_udf("struct<host_key:string,parts:array<int>>")
    def find(found: pd.Series) -> pd.DataFrame:
        keys = found.map(host_key)
        return pd.DataFrame({"host_key": keys, "parts": [numbers[bisect_left(lasts, k) : bisect_right(firsts, k)] for k in keys]})

    def search(lines: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values(["first_key", "last_key"])
        first, last, names = lines["first_key"].tolist(), lines["last_key"].tolist(), lines["block"].tolist()
        return pd.DataFrame([(k, b) for k in keys["host_key"] for b in names[bisect_left(last, k) : bisect_right(first, k)]], columns=["host_key", "block"])

    wanted = urls.select(find("url").alias("k")).select("k.host_key", F.explode("k.parts").alias("part")).distinct()
    hits = stored(directory.groupBy("part").cogroup(wanted.groupBy("part")).applyInPandas(search, "host_key string, block string"))
    found = opened(blocks.join(hits.select("block").distinct(), "block", "left_semi"))
    return found.join(hits.select("host_key").distinct(), "host_key", "left_semi")
