"""WARC archives compressed record by record with an embedded dictionary.

An archive starts with a skippable Zstandard frame that holds the dictionary;
each record follows as a frame of its own, so one record can be read from its
offset with the dictionary alone.  The dictionary is trained on the first
records of the archive it serves.  Records whose payload another record holds
are written as ``revisit`` records (identical payload digest): headers without
the body.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir, scratch_path, ship_package

# Magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 64 * 1024
# Records (and bytes of them) that an archive's dictionary is trained on.
TRAIN_RECORDS = 1000
TRAIN_BYTES = 4 << 20
ARCHIVE_BYTES = 256 << 20
MIN_REVISIT_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def record_bytes(page_id, url: str, payload: bytes, digest: str, size: int, refers_to, refers_url) -> bytes:
    """One WARC/1.1 record: a response, or a revisit when ``refers_to`` is given."""
    sha1 = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", _record_id(page_id)), ("WARC-Target-URI", _one_line(url)), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", sha1)]
    block = http + (payload if refers_to is None else b"")
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to)),
                 ("WARC-Refers-To-Target-URI", _one_line(refers_url)), ("WARC-Refers-To-Date", DATE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _record_id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _one_line(url) -> str:
    return " ".join((url or "").split())


def _page_id(value: str):
    text = value[len("<urn:page:"):-1]
    return None if text == "null" else int(text)


class Writer:
    """Writes one archive to a binary stream; memory is bounded by the training sample."""

    def __init__(self, sink, level: int = 3):
        self.sink, self.level, self.waiting, self.held, self.compress, self.size = sink, level, [], 0, None, 0

    def add(self, record: bytes) -> None:
        if self.compress:
            self._put(self.compress(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if len(self.waiting) >= TRAIN_RECORDS or self.held >= TRAIN_BYTES:
            self._start()

    def close(self) -> None:
        if not self.compress:
            self._start()

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.size += len(data)

    def _start(self) -> None:
        import zstandard

        try:
            raw = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:1 << 17] for r in self.waiting]).as_bytes()
        except zstandard.ZstdError:  # too few records to train on: their own bytes serve
            raw = b"".join(r[:1 << 14] for r in self.waiting)[-DICTIONARY_BYTES:]
        known = zstandard.ZstdCompressionDict(raw)
        known.precompute_compress(level=self.level)
        self.compress = zstandard.ZstdCompressor(level=self.level, dict_data=known, write_checksum=True,
                                                 write_content_size=True).compress
        packed = zstandard.ZstdCompressor(level=9).compress(raw)
        self._put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        for record in self.waiting:
            self._put(self.compress(record))
        self.waiting = []


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive stream, one record at a time."""
    import zstandard

    head = source.read(8)
    if len(head) < 8:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    raw = zstandard.ZstdDecompressor().decompress(source.read(size))
    frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    plain = io.BufferedReader(frames.stream_reader(source, read_across_frames=True, closefd=False), 1 << 20)
    while line := plain.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := plain.readline()) != b"\r\n":
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        block = plain.read(int(fields["Content-Length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end as it should")
        yield fields, block


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, payload) with digest, size and what a revisit refers to.

    Only ids and digests take part in the search for equal payloads; the revisit
    rows, keyed by page, then meet the pages.  Rows that share the largest page
    id of a payload are all responses.
    """
    rows = pages.select("page_id", "url", "payload", F.sha1("payload").alias("digest"),
                        F.octet_length("payload").cast("long").alias("size"))
    narrow = rows.where(F.col("size") >= min_bytes).select("page_id", "url", "digest", "size")
    last = (narrow.groupBy("digest", "size").agg(
        F.max(F.struct("page_id", "url")).alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "size", F.col("last.page_id").alias("refers_to"),
                               F.col("last.url").alias("refers_url")))
    # The digest stays in the key: rows may share a page id.
    again = (narrow.select("page_id", "digest", "size").distinct().join(last, ["digest", "size"])
             .where(F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to")))
             .where(F.col("refers_to").isNotNull())
             .select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to", "refers_url"))
    return rows.join(again, rows["page_id"].eqNullSafe(again["_page"]) & (rows["digest"] == again["_digest"]),
                     "left").drop("_page", "_digest")


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``with_revisits``' rows to archives under ``folder`` (any file system
    that pyarrow opens by URI); returns the checkpointed list (path, records).

    Each task writes archives of at most ``ARCHIVE_BYTES`` under a name of its
    own attempt and lists them when they are complete, so files of lost or
    repeated attempts are never listed.  The list has one row for each archive.
    """
    ship_package(rows.sparkSession)
    checkpoint_dir(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        path = sink = writer = None
        count = 0

        def finished():
            writer.close()
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    path, count = f"{base}/{uuid.uuid4().hex}.warc.zst", 0
                    sink = fs.open_output_stream(path, compression=None)
                    writer = Writer(sink)
                writer.add(record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["size"],
                                        row["refers_to"], row["refers_url"]))
                count += 1
                if writer.size >= ARCHIVE_BYTES:
                    yield finished()
                    writer = None
        if writer is not None:
            yield finished()

    listed = rows.select("page_id", "url", "payload", "digest", "size", "refers_to", "refers_url")
    return listed.mapInArrow(write, "path string, records bigint").checkpoint()


def open_folder(folder: str):
    """File system and path of a folder given by URI or plain path; makes the folder."""
    from pyarrow import fs as pafs

    fs, base = (pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:")
                else (pafs.LocalFileSystem(), folder))
    fs.create_dir(base, recursive=True)
    return fs, base


def read_archives(listed: DataFrame, folder: str) -> DataFrame:
    """Read listed archives back, one row for each record, streaming within a task."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        for batch in batches:
            for path, expected in zip(*(c.to_pylist() for c in batch.columns)):
                out: list[dict] = []
                seen = 0
                with fs.open_input_stream(path, compression=None) as source:
                    for fields, block in read_records(source):
                        out.append(_row(fields, block))
                        seen += 1
                        if len(out) >= 1000:
                            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                            out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                if seen != expected:
                    raise ValueError(f"{path}: {seen} records, {expected} were written")

    spread = listed.repartition(max(1, listed.rdd.getNumPartitions()), "path")
    return spread.mapInArrow(read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                   "record_type string, refers_to bigint")


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _row(fields: dict[str, str], block: bytes) -> dict:
    """What a record says, with a response's payload checked against its headers."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length:")).split(b":")[1])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload differs from its digest")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page_id(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": _page_id(refers) if refers else None}


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html), then read all back.

    Rows: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.
    A null html is an empty payload, a null url an empty target.  Of records with
    equal payloads of at least ``min_bytes`` the one with the largest page id is
    the response; rows without an id revisit it too.  Repeated rows are written
    and returned repeatedly; those with the largest id are all responses.  Other
    columns are ignored; an empty table writes no archive.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = with_revisits(pages.select("page_id", "url", payload.alias("payload")), min_bytes)
    return read_archives(write_archives(rows, folder), folder)
