"""WARC archives of pages, and a two-level capture index to read them by url.

Writing: every page is a record, its payload the html in UTF-8. Of pages with equal payloads the
one with the largest id is the response, the others are revisits that name it. Winners are found
per salted digest group, then per digest, and go back to the pages by a salted join, the one
shuffle of the html. Each task packs its records, one gzip member each, into archives of bounded
size. An archive is one row of the written table: its name, its bytes (a valid `.warc.gz` file),
and its captures (url key, offset, length).

Index: captures are sorted by their url key, whose host is reversed (`org,example)/path`), in parts
of about PART_LINES, and cut into compressed blocks of BLOCK_LINES lines; the directory holds the
first and last key of each block, and the range of keys of each part of the index.

Reading: wanted keys find their part by binary search in the table of parts, whose number is
checked, and their blocks by binary search in the directory of the part, which is read without the
blocks themselves. A part that many keys fall in is searched by several tasks, each with a copy of
its directory. Only the blocks found are moved and unpacked. Their lines of wanted keys are joined
to the archives, whose partitions follow their bytes, and each record is read from its byte range
alone.

Null html is an empty payload. A null url is written as `urn:x-page:` with the id. A row with a
null id is a response, and no response for others. Rows that repeat an id are records of their
own. Extra columns are ignored. Empty tables give empty archives and results.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, task_number, texts
from opinara.llm.salting import SALTS, salted_join
from opinara.operators.joins import keyed_lookup
from opinara.session import materialize

ARCHIVE_BYTES = 4 << 20
ARCHIVE_RECORDS = 2000
BLOCK_LINES = 512
PART_LINES = 1_000_000
MAX_PARTS = 100_000
#: Wanted keys that one task looks up in a directory.
KEYS_PER_TASK = 250_000
#: Compressed bytes of archives that one task reads, more where that makes over READ_TASKS tasks.
READ_BYTES = 16 << 20
READ_TASKS = 50_000
LEAST_PAYLOAD = 0
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = (
    "archive string, bytes long, content binary, "
    "captures array<struct<key: string, offset: long, length: long>>"
)
LINES = "key string, archive string, offset long, length long"
URL = re.compile(r"(?s)^.*?://([^/?#]*)(.*)$")


@dataclass
class Collection:
    """Written archives with their index: `key` ranges of `parts`, and blocks of lines."""

    archives: DataFrame
    index: DataFrame
    parts: DataFrame


def url_key(url: str) -> str:
    """Sort key of a url: reversed host, then the rest; other strings are their own key."""
    found = URL.match(url)
    if not found:
        return url
    return ",".join(reversed(found[1].lower().split("."))) + ")" + found[2]


def page_url(url: str | None, page: int | None) -> str:
    """The url as it stands in a header line."""
    if url is None:
        return f"urn:x-page:{page}"
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str, payload: bytes, original: int | None) -> bytes:
    """A response record, or a revisit of `original`, as one gzip member."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head + (payload if original is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if original is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{original}>", f"WARC-Profile: {PROFILE}"]
    whole = b"\r\n\r\n".join(["\r\n".join(lines).encode(), block, b""])
    return gzip.compress(whole, 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of a record."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = _fields(head)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def _originals(pages: DataFrame, key: str, least: int) -> DataFrame:
    """`sha, bytes, original` of the payloads that several pages share."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    marks = pages.select(F.col(key).alias("id"), *_payload_marks()).filter(F.col("bytes") >= least)
    return (
        marks.groupBy("sha", "bytes", salt.alias("salt"))
        .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n"))
        .groupBy("sha", "bytes")
        .agg(F.max("original").alias("original"), F.sum("n").alias("n"))
        .filter("n > 1 AND original IS NOT NULL")
        .drop("n")
    )


def _payload_marks() -> list[Column]:
    payload = F.coalesce("html", F.lit(""))
    return [F.sha2(payload, 256).alias("sha"), F.octet_length(payload).alias("bytes")]


def write(pages: DataFrame, key: str = "page_id", least: int = LEAST_PAYLOAD) -> Collection:
    """Write the pages `url, html` and their index to the shared folder. Runs jobs."""
    marked = pages.select(F.col(key).cast("long").alias("id"), "url", "html", *_payload_marks())
    rows = salted_join(marked, _originals(pages, key, least), ["sha", "bytes"], "id").select(
        "id",
        "url",
        "html",
        F.when(F.col("id") < F.col("original"), F.col("original")).alias("original"),
    )
    archives = materialize(rows.mapInArrow(_packed, ARCHIVES), "archives")
    lines = archives.select("archive", F.explode("captures").alias("c")).select(
        "c.key", "archive", "c.offset", "c.length"
    )
    captures = archives.agg(F.sum(F.size("captures"))).first()[0] or 0
    tasks = task_number(pages.sparkSession, captures, PART_LINES)
    ordered = lines.repartitionByRange(tasks, "key", "archive", "offset").sortWithinPartitions(
        "key", "archive", "offset"
    )
    schema = "part int, block int, first string, last string, lines binary"
    index = materialize(ordered.mapInArrow(_index_blocks, schema), "capture-index")
    parts = index.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return Collection(archives, index, materialize(parts, "index-parts"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of a task's pages."""
    task, number = TaskContext.get().partitionId(), 0
    content, captures = bytearray(), []

    def archive() -> pa.RecordBatch:
        name = f"pages-{task:06d}-{number:06d}.warc.gz"
        kind = pa.list_(
            pa.struct([("key", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name]),
                pa.array([len(content)], pa.int64()),
                pa.array([bytes(content)], pa.binary()),
                pa.array([captures], kind),
            ],
            ["archive", "bytes", "content", "captures"],
        )

    for block in blocks(batches, "html"):
        columns = (block.column(c).to_pylist() for c in ("id", "url", "original"))
        for page, url, original, html in zip(*columns, texts(block, "html")):
            url = page_url(url, page)
            member = record(page, url, html.encode("utf-8", "surrogatepass"), original)
            captures.append({"key": url_key(url), "offset": len(content), "length": len(member)})
            content += member
            if len(content) >= ARCHIVE_BYTES or len(captures) >= ARCHIVE_RECORDS:
                yield archive()
                number += 1
                content, captures = bytearray(), []
    if captures:
        yield archive()


def _index_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, held = TaskContext.get().partitionId(), 0, []

    def block(lines: list[tuple]) -> pa.RecordBatch:
        packed = zlib.compress("\n".join(map("\t".join, lines)).encode("utf-8", "surrogatepass"))
        values = [part, number, lines[0][0], lines[-1][0], packed]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kind) for v, kind in zip(values, kinds)],
            ["part", "block", "first", "last", "lines"],
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "archive", "offset", "length")]
        held += [(k, a, str(o), str(n)) for k, a, o, n in zip(*columns)]
        while len(held) >= BLOCK_LINES:
            yield block(held[:BLOCK_LINES])
            held, number = held[BLOCK_LINES:], number + 1
    if held:
        yield block(held)


def lookup(collection: Collection, keys: DataFrame) -> DataFrame:
    """`key, archive, offset, length` of all captures of the distinct `key`s asked for.

    Runs jobs: the keys with their parts and the lines of the blocks found are written.
    """
    ranges = collection.parts.limit(MAX_PARTS + 1).collect()
    if len(ranges) > MAX_PARTS:
        raise ValueError(f"over {MAX_PARTS} parts of the index")
    ranges = sorted((r["first"], r["last"], r["part"]) for r in ranges)
    firsts, lasts = [r[0] for r in ranges], [r[1] for r in ranges]

    def assigned(batches):
        for batch in batches:
            found, parts = [], []
            for key in batch.column("key").to_pylist():
                low, high = bisect_left(lasts, key), bisect_right(firsts, key)
                for at in range(low, high):
                    found.append(key)
                    parts.append(ranges[at][2])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(parts, pa.int32())], ["key", "part"]
            )

    wanted = keys.select("key").filter("key IS NOT NULL").distinct()
    wanted = materialize(wanted.mapInArrow(assigned, "key string, part int"), "wanted-keys")
    lines = wanted_blocks(collection, wanted).mapInArrow(_unpacked, LINES)
    return keyed_lookup(materialize(lines, "lines"), wanted, "key", "left_semi")


def wanted_blocks(collection: Collection, wanted: DataFrame) -> DataFrame:
    """The index blocks whose range holds one of the keys `wanted(key, part)`."""
    # A row for each part at most, whose number is checked.
    crowds = wanted.groupBy("part").agg(
        F.ceil(F.count(F.lit(1)) / KEYS_PER_TASK).cast("int").alias("salts")
    )
    salt = F.pmod(F.xxhash64("key"), F.col("salts")).cast("int").alias("salt")
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    searched = wanted.join(F.broadcast(crowds), "part").select("part", salt, "key")
    directory = collection.index.select("part", "block", "first", "last")
    directory = directory.join(F.broadcast(crowds), "part").select(*directory.columns, every)
    found = (
        searched.groupBy("part", "salt")
        .cogroup(directory.groupBy("part", "salt"))
        .applyInPandas(_searched, "part int, block int")
    )
    return collection.index.join(found.distinct(), ["part", "block"], "left_semi")


def page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of pages `page_id, url`, for `mapInArrow`."""
    for batch in batches:
        rows = zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist())
        found = [url_key(page_url(url, page)) for url, page in rows]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["key"])


def _searched(keys: pd.DataFrame, directory: pd.DataFrame) -> pd.DataFrame:
    """Blocks of one part that may hold one of the keys."""
    directory = directory.sort_values("block")
    firsts, lasts, numbers = (directory[c].tolist() for c in ("first", "last", "block"))
    found: set[int] = set()
    for key in keys["key"]:
        found.update(range(bisect_left(lasts, key), bisect_right(firsts, key)))
    part = directory["part"].iloc[0] if found else 0
    return pd.DataFrame({"part": part, "block": [numbers[at] for at in sorted(found)]})


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of index blocks."""
    for batch in batches:
        for packed in batch.column("lines").to_pylist():
            lines = zlib.decompress(packed).decode("utf-8", "surrogatepass").split("\n")
            keys, archives, offsets, lengths = zip(*(line.rsplit("\t", 3) for line in lines))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array(archives, pa.string()),
                    pa.array(map(int, offsets), pa.int64()),
                    pa.array(map(int, lengths), pa.int64()),
                ],
                ["key", "archive", "offset", "length"],
            )


def read(collection: Collection, located: DataFrame) -> DataFrame:
    """The records at the places of `lookup`: ids, payload sizes and digests, kinds, html.

    An archive holds at most ARCHIVE_RECORDS records, so its list of ranges is bounded. Runs a job.
    """
    total = collection.archives.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-total // max(READ_BYTES, total // READ_TASKS)))
    ranges = located.repartition(tasks, "archive").groupBy("archive").agg(
        F.collect_list(F.struct("key", "offset", "length")).alias("ranges")
    )
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string, html string"
    )
    return (
        collection.archives.select("archive", "content")
        .repartition(tasks, "archive")
        .join(ranges, "archive")
        .select("content", "ranges")
        .mapInArrow(_records, schema)
    )


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = (
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("html", pa.string()),
    )
    for batch in batches:
        for i in range(batch.num_rows):
            content = batch.column("content")[i].as_buffer()
            rows = []
            for place in batch.column("ranges")[i].as_py():
                member = content.slice(place["offset"], place["length"]).to_pybytes()
                headers, http, payload = parse(member)
                kind, stated = headers["WARC-Type"], headers["WARC-Payload-Digest"][len("sha1:") :]
                if kind == "response" and digest(payload) != stated:
                    raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                rows.append(
                    (
                        _page(headers["WARC-Record-ID"]),
                        int(http["Content-Length"]),
                        stated,
                        kind,
                        _page(headers.get("WARC-Refers-To")),
                        headers["WARC-Target-URI"],
                        payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
                    )
                )
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, (_, t) in zip(columns, names)], [n for n, _ in names]
            )
