"""WARC archives of pages: records compressed one by one with a Zstandard dictionary that leads the file.

Each task writes one file into a shared folder: a skippable frame that holds the dictionary, then a frame for each
record, first a warcinfo record. The dictionary is trained on the file's own first records (SAMPLE_BYTES at most,
DICTIONARY_BYTES long); a file with too little text for that carries its first record's bytes as a raw dictionary.
Files have names drawn at random, and a task returns a row for each block of records (file, where the block begins and
ends, how many). These rows are written as a table, the catalogue: a file of a lost or repeated attempt isn't in it.
Blocks are read side by side, by their places.

A payload of DEDUP_BYTES or more that occurs several times is a response once, at the page with the largest page_id
(ties: the least url), and a revisit elsewhere. Smaller payloads and rows with a null page_id are always responses. A
null html is an empty payload; a null url becomes "urn:page:" and the id. Extra columns are ignored. A reader recomputes
the digest of each response and fails if it differs from the header.

Files are opened with pyarrow, so the folder may be on any store it knows (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.llm.common import slices, stored
from profilematch.operators.skew import MAX_BROADCAST_ROWS, expand_join
from profilematch.session import fits, shared_folder

DEDUP_BYTES = 1000
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 64 << 10
BLOCK_BYTES = 4 << 20
#: Bytes before compression that one task reads back, on average.
TASK_BYTES = 64 << 20
LEVEL = 3
# Fixed values of the formats: the dictionary's skippable frame, and the profile of revisit records.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CATALOGUE = "file string, first long, past long, records long, raw_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, record_id string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)


def planned(pages: DataFrame, dedup_bytes: int = DEDUP_BYTES) -> DataFrame:
    """(page_id, url, html, record_type, refers_to, refers_url): which rows are written whole, and what the others revisit."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    able = F.col("page_id").isNotNull() & (F.octet_length("html") >= dedup_bytes)
    rows = rows.withColumn("same", F.when(able, F.sha2("html", 256)))
    listed = rows.where(F.col("same").isNotNull()).groupBy("same", "page_id", "url").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("page_id")).alias("less"), "url", "n")).alias("best")
    copies = listed.groupBy("same").agg(F.sum("n").alias("copies"), F.max("page_id").alias("refers_to"), best)
    copies = copies.where(F.col("copies") > 1).select("same", "refers_to", F.col("best.url").alias("refers_url"), F.col("best.n").alias("n"))
    copies = stored(copies, "warc-copies")
    joined = expand_join(rows, copies, "same", "page_id", fits(copies, MAX_BROADCAST_ROWS), "left")
    chosen = F.coalesce((F.col("page_id") == F.col("refers_to")) & F.col("url").eqNullSafe(F.col("refers_url")), F.lit(False))
    columns = ["page_id", "url", "html", "record_type", "refers_to", "refers_url"]
    kind = F.when(F.col("refers_to").isNull() | chosen, "response").otherwise("revisit")
    out = joined.withColumn("record_type", kind)
    if copies.where(F.col("n") > 1).isEmpty():
        return out.select(*columns)
    # rows that equal the chosen one in id, url and text: one of them stays, the others are made from it
    equal = chosen & (F.col("n") > 1)
    one = out.where(equal).dropDuplicates(["same"]).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
    one = one.withColumn("record_type", F.when(F.col("k") == 1, "response").otherwise("revisit"))
    return out.where(~F.coalesce(equal, F.lit(False))).select(*columns).union(one.select(*columns))


def _record_id(page_id: int | None, url: str | None, digest: bytes, whole: bool) -> str:
    """The same at each attempt for a response that others may refer to; else drawn at random."""
    if page_id is None or not whole:
        return f"<urn:uuid:{uuid.uuid4()}>"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr((page_id, url, digest)).encode()).digest()[:16], version=5)}>"


def _uri(page_id: int | None, url: str | None) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else f"urn:page:{'' if page_id is None else page_id}"


def _record(date: str, page_id, url, html: str, kind: str, refers_to, refers_url, deduplicated: bool) -> bytes:
    payload = html.encode()
    sha1 = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    whole = deduplicated and kind == "response"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, url, sha1, whole)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(page_id, url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
    ]
    if kind == "revisit":
        lines += [
            f"WARC-Refers-To: {_record_id(refers_to, refers_url, sha1, True)}",
            f"WARC-Refers-To-Target-URI: {_uri(refers_to, refers_url)}",
            f"WARC-Profile: {PROFILE}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    if page_id is not None:
        lines.append(f"X-Page: {page_id}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _info(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    lines = [
        "WARC/1.1",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {date}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
        "",
        "",
    ]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def trained(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary of the records; raw content where there is too little to train on."""
    size = max(1024, min(DICTIONARY_BYTES, sum(map(len, records)) // 8))
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    folder = re.sub(r"^file:/+", "/", folder)
    return fs.FileSystem.from_uri(folder)


class _Writer:
    """One file: holds back the first records until there are enough to train the dictionary."""

    def __init__(self, folder: str, date: str) -> None:
        self.system, path = _file_system(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.system.create_dir(path, recursive=True)
        self.out = self.system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.date, self.at, self.held, self.size = date, 0, [_info(date)], 0
        self.pack = None
        self.block = [0, 0, 0]  # where it begins, records, bytes before compression

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _start(self) -> None:
        book = trained(self.held)
        raw = book.as_bytes()
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=book)
        self.block[0] = self.at
        held, self.held = self.held, []
        for record in held:
            yield from self.add(record)

    def add(self, record: bytes) -> Iterator[tuple]:
        if self.pack is None:
            self.held.append(record)
            self.size += len(record)
            if self.size >= SAMPLE_BYTES:
                yield from self._start()
            return
        self._put(self.pack.compress(record))
        self.block[1] += 1
        self.block[2] += len(record)
        if self.block[2] >= BLOCK_BYTES:
            yield self._ended()

    def _ended(self) -> tuple:
        first, n, raw = self.block
        self.block = [self.at, 0, 0]
        return self.name, first, self.at, n, raw

    def close(self) -> Iterator[tuple]:
        if self.pack is None:
            yield from self._start()
        if self.block[1]:
            yield self._ended()
        self.out.close()


def write_archives(pages: DataFrame, folder: str | None = None, dedup_bytes: int = DEDUP_BYTES) -> DataFrame:
    """Archives of all rows of ``pages`` (page_id, url, html) in ``folder``. Returns their catalogue, a stored table."""
    if folder is None:
        folder = os.path.join(shared_folder(pages.sparkSession), "profilematch", f"warc-{uuid.uuid4().hex}")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    schema = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("first", "past", "records", "raw_bytes")]])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for part in slices(batch, "html"):
                writer = writer or _Writer(folder, date)
                columns = [part.column(c).to_pylist() for c in ("page_id", "url", "html", "record_type", "refers_to", "refers_url")]
                for page_id, url, html, kind, refers_to, refers_url in zip(*columns):
                    record = _record(date, page_id, url, html, kind, refers_to, refers_url, refers_to is not None)
                    if found := list(writer.add(record)):
                        yield rows(found)
        if writer is not None and (found := list(writer.close())):
            yield rows(found)

    catalogue = planned(pages, dedup_bytes).mapInArrow(run, CATALOGUE)
    return stored(catalogue.withColumn("file", F.concat(F.lit(folder.rstrip("/") + "/"), "file")), "warc-catalogue")


def _dictionary(file) -> zstandard.ZstdCompressionDict:
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary")
    return zstandard.ZstdCompressionDict(file.read(size))


def _parsed(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of bytes."""
    held = b""
    while True:
        while b"\r\n\r\n" not in held:
            more = stream.read(1 << 16)
            if not more:
                if held:
                    raise ValueError("a record is cut off")
                return
            held += more
        head, _, held = held.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        need = int(headers["Content-Length"]) + 4
        parts = [held]
        have = len(held)
        while have < need and (more := stream.read(max(1 << 16, need - have))):
            parts.append(more)
            have += len(more)
        held = b"".join(parts)
        if len(held) < need:
            raise ValueError("a record is cut off")
        yield headers, held[: need - 4]
        held = held[need:]


def _row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers["WARC-Type"]
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(headers[name]) if name in headers else None
    return (
        number("X-Page"),
        headers["WARC-Target-URI"],
        kind,
        headers["WARC-Record-ID"].strip("<>"),
        number("X-Refers-To-Page"),
        digest.hex(),
        size,
        payload if kind == "response" else None,
    )


def read_archives(catalogue: DataFrame) -> DataFrame:
    """All records of the files in ``catalogue`` but warcinfo; payload is null for revisits, its size and digest are not."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first, past in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "past"))):
                system, path = _file_system(name)
                with system.open_input_file(path) as file:
                    unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(file))
                    file.seek(first)
                    data = file.read(past - first)
                held, size = [], 0
                with unpack.stream_reader(data, read_across_frames=True) as stream:
                    for headers, block in _parsed(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        held.append(_row(headers, block))
                        size += len(block)
                        if size >= BLOCK_BYTES:
                            yield batch_of(held)
                            held, size = [], 0
                if held:
                    yield batch_of(held)

    raw = catalogue.agg(F.sum("raw_bytes")).first()[0] or 0
    tasks = max(catalogue.sparkSession.sparkContext.defaultParallelism, raw // TASK_BYTES)
    # with a number of its own: these rows are few and short, and would be gathered in one task otherwise
    return catalogue.select("file", "first", "past").repartition(tasks, "file", "first").mapInArrow(run, RECORDS)


def payloads(records: DataFrame) -> DataFrame:
    """``records`` with the payload of the response for each revisit, as a replay tool would show it."""
    heads = records.where(F.col("record_type") == "response")
    heads = heads.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("whole"))
    revisits = records.where(F.col("record_type") == "revisit").withColumn("on", F.concat_ws(":", "refers_to", "payload_digest"))
    heads = heads.select(F.concat_ws(":", "refers_to", "payload_digest").alias("on"), "whole").join(
        revisits.select("on").distinct(), "on", "left_semi"
    )
    heads = heads.groupBy("on").agg(F.any_value("whole").alias("whole"))
    filled = expand_join(revisits, heads, "on", "record_id", False).withColumn("payload", F.col("whole"))
    columns = records.columns
    return records.where(F.col("record_type") == "response").select(*columns).union(filled.select(*columns))
