"""WARC archives with Zstandard: one frame for each record, the dictionary in front.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, plain
or itself compressed, and goes on with one frame per record. The writer trains a dictionary on
the first ``SAMPLE`` bytes of each archive's records; where there are too few records to train
on, the archive has no such frame. A record whose payload is that of another one, and at least
``least`` bytes long, is a revisit that refers to it and has no payload.

The reader takes rows of (path, content), as Spark's ``binaryFile`` source or ``write_archives``
give them, decodes frame by frame, and raises ValueError, naming archive and record, if a header
is missing or malformed, a length differs from the bytes there are, a digest differs from the
payload, or a frame ends early.

Defined cases: a null html is an empty payload; a null url leaves WARC-Target-URI out; a null
page_id is written as an empty one and read as null. Of equal payloads the row with the largest
page_id is the response; rows that repeat that id are responses too, and if all ids are null all
are. Line breaks in a url are percent-encoded. Columns beyond page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import stage

# Fixed values of the formats.
SKIPPABLE, FRAME = (0x184D2A5D).to_bytes(4, "little"), (0xFD2FB528).to_bytes(4, "little")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")

#: Compressed bytes after which an archive is closed, bytes that a dictionary is trained on,
#: and bytes of a dictionary.
ARCHIVE, SAMPLE, DICTIONARY = 4 << 20, 1 << 20, 32 << 10
#: Compressed bytes handed to the decoder at a time.
READ = 64 << 10

ARCHIVES = "path string, content binary"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, payload, and of a revisit the page it refers to."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    long = rows.filter(F.octet_length("payload") >= least)
    copied = long.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Short and empty pages, which share digests, take no part in the join, and the repeated
    # digests are written, so that a page with very many copies can be split over tasks.
    found = long.join(stage(copied, "copied"), "digest", "left")
    refers = F.when(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    found = found.select("page_id", "url", "payload", refers.alias("refers_to"))
    short = rows.filter(F.octet_length("payload") < least)
    return found.unionByName(short.select("page_id", "url", "payload", F.lit(None).cast(found.schema["refers_to"].dataType).alias("refers_to")))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The bytes of one record."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(quote(c) if ord(c) < 33 else c for c in url))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY, records)
    except zstandard.ZstdError:  # too few or too short to train on
        return None


class _Archive:
    """Collects records; the first ones wait until the dictionary is trained."""

    def __init__(self):
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.size = 0
        self.frames: list[bytes] = []
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, data: bytes) -> None:
        if self.compressor is None:
            self.waiting.append(data)
            self.waiting_bytes += len(data)
            if self.waiting_bytes >= SAMPLE:
                self._start()
        else:
            self._frame(data)

    def _start(self) -> None:
        trained = _dictionary(self.waiting)
        if trained is not None:
            raw = trained.as_bytes()
            self.frames.append(SKIPPABLE + len(raw).to_bytes(4, "little") + raw)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained)
        for data in self.waiting:
            self._frame(data)
        self.waiting = []

    def _frame(self, data: bytes) -> None:
        self.frames.append(self.compressor.compress(data))
        self.size += len(self.frames[-1])

    def content(self) -> bytes:
        if self.compressor is None:
            self._start()
        return b"".join(self.frames)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    partition, number, archive, any_record = TaskContext.get().partitionId(), 0, _Archive(), False

    def closed() -> pa.RecordBatch:
        path = f"part-{partition:06}-{number:06}.warc.zst"
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([archive.content()], pa.binary())], ["path", "content"])

    for batch in batches:
        columns = [batch.column(name) for name in ("page_id", "url", "payload", "refers_to")]
        for values in zip(*columns):
            archive.add(record(*(value.as_py() for value in values)))
            any_record = True
            if archive.size >= ARCHIVE:
                yield closed()
                number, archive, any_record = number + 1, _Archive(), False
    if any_record:
        yield closed()


def write_archives(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Archives (path, content) with a record for each page, none much over ``ARCHIVE`` bytes
    unless one record is."""
    return with_revisits(pages, least).mapInArrow(_write, ARCHIVES)


def _load_dictionary(content: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    if content[:4] != SKIPPABLE:
        return None, 0
    end = 8 + int.from_bytes(content[4:8], "little")
    raw = content[8:end]
    if len(raw) != end - 8:
        raise ValueError("the dictionary ends early")
    if raw[:4] == FRAME:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return zstandard.ZstdCompressionDict(raw), end


def frames(content: bytes) -> Iterator[bytes]:
    """The records of an archive, each from a frame of its own."""
    trained, at = _load_dictionary(content)
    decoder = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(content):
        if content[at : at + 4] != FRAME:
            raise ValueError(f"no frame at byte {at}")
        one, parts = decoder.decompressobj(), []
        while not one.eof:
            piece = content[at : at + READ]
            if not piece:
                raise ValueError("the last frame ends early")
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def _page(urn: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise ValueError(f"not a record id: {urn}")
    return int(urn[10:-1]) if urn[10:-1] else None


def parse(data: bytes) -> dict:
    """The fields of one record, checked."""
    head, split, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not split or version != VERSION:
        raise ValueError(f"not a record: {data[:40]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.decode().partition(": ")
        if not colon or name in fields:
            raise ValueError(f"bad header line: {line!r}")
        fields[name] = value
    if missing := [name for name in NEEDED if name not in fields]:
        raise ValueError(f"missing {missing}")
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(rest) - 4}")
    http, split, payload = block.partition(b"\r\n\r\n")
    sizes = [line[16:] for line in http.split(b"\r\n") if line.startswith(b"Content-Length: ")]
    if not split or len(sizes) != 1:
        raise ValueError("bad http head")
    kind, digest = fields["WARC-Type"], base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if kind == "response":
        if len(payload) != int(sizes[0]) or hashlib.sha1(payload).digest() != digest:
            raise ValueError("the payload isn't the one that was written")
    elif kind != "revisit" or payload or "WARC-Refers-To" not in fields:
        raise ValueError(f"bad {kind} record")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload_bytes": int(sizes[0]),
        "payload_digest": digest.hex(),
        "payload": payload if kind == "response" else None,
    }


def _read(payloads: bool):
    names = [part.split()[0] for part in RECORDS.split(", ")] + ["payload"] * payloads
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in RECORDS.split(", ")] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, at = [], 0
                try:
                    for at, data in enumerate(frames(content.as_py())):
                        rows.append(parse(data))
                except (ValueError, zstandard.ZstdError) as error:
                    raise ValueError(f"{path.as_py()}, record {at}: {error}") from error
                yield pa.RecordBatch.from_arrays([pa.array([row[n] for row in rows], t) for n, t in zip(names, types)], names)

    return run


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record of ``archives`` (path, content); its payload if asked for."""
    schema = RECORDS + ", payload binary" * payloads
    return archives.select("path", "content").mapInArrow(_read(payloads), schema)
