"""WARC archives in Zstandard with a dictionary per archive (operator 1).

An archive is a skippable frame that holds the dictionary, then one frame per
record, so that any record can be read with the dictionary and its own frame
alone. The dictionary is trained on the archive's first records, at most
train_bytes of them, which the writer holds; the rest is streamed. A set of
records too small to train on gives a raw-content dictionary of their bytes.

Of records with equal payloads of at least min_revisit bytes, that with the
largest page id is the response and the others revisit it; shorter payloads
are always responses. Payloads are matched by SHA-1 and length; only ids,
digests and lengths are grouped. The repeated digests are sent to every task
if few, so that no payload is shuffled; else payloads of min_revisit bytes or
more meet them in a join, which can split a common digest.

Archives go to a folder that all executors share, under a name of the task
attempt's own. The manifest names the archives of the attempts that counted;
what a lost or repeated attempt left behind is not in it, and not read.

Defined results: a null payload is empty; a null page id is written as an
empty header and read back as null (it is the response of its group only if
all ids are null; of rows with the group's largest id, if repeated, all are
responses); an empty table gives no archive and an empty result; other
columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, sent_if_small, slices, utf8, written

#: Fixed value: the skippable frame's magic number for dictionaries.
DICTIONARY_MAGIC = 0x184D2A5D
MIN_REVISIT = 1000
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pages")

MANIFEST_SQL = "archive string, n_records long, n_bytes long"
RECORD_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, archive string, offset long"
_RECORD = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("target_uri", pa.string()), ("archive", pa.string()), ("offset", pa.int64())]
)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to) of each row; refers_to is null
    for responses."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(utf8(payload_col), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    long = F.col("size") >= min_revisit
    groups = rows.where(long).groupBy("sha1", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    shared = groups.where("n > 1 and last is not null").select(F.col("sha1").alias("s"), F.col("size").alias("z"), "last")
    shared = sent_if_small(written(shared, "shared"))
    # short payloads, many of them equal, are spread by a key that meets none
    rows = rows.withColumn("key", F.when(long, F.col("sha1")).otherwise(F.xxhash64("page_id", "url").cast("string")))
    met = rows.join(shared, (F.col("key") == F.col("s")) & (F.col("size") == F.col("z")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return met.select("page_id", "url", "payload", "sha1", refers.cast("long").alias("refers_to"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def _header_text(value: object) -> str:
    """A header value on one line."""
    return "" if value is None else "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))


def make_record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP headers only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_header_text(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        f"X-Page-ID: {_header_text(page_id)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines)
    return {k.decode().lower(): v.strip().decode() for k, _, v in pairs}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and the payload that the record holds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head.split(b"\r\n")[1:])
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _fields(http.split(b"\r\n")[1:]), payload


def train(records: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """A dictionary of at most `size` bytes."""
    try:
        return zstandard.train_dictionary(size, records, k=200, d=8)
    except zstandard.ZstdError:  # too few or too small
        return zstandard.ZstdCompressionDict(b"".join(records)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """One archive: dictionary frame, then a frame for each record."""

    def __init__(self, stream, dict_bytes: int, train_bytes: int, level: int):
        self.stream, self.dict_bytes, self.train_bytes, self.level = stream, dict_bytes, train_bytes, level
        self.held: list[bytes] = []
        self.held_bytes = self.n_records = self.n_bytes = self.raw_bytes = 0
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, record: bytes) -> None:
        self.n_records += 1
        self.raw_bytes += len(record)
        if self.compressor is not None:
            self._put(self.compressor.compress(record))
            return
        self.held.append(record)
        self.held_bytes += len(record)
        if self.held_bytes >= self.train_bytes:
            self._start()

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def _start(self) -> None:
        own = train(self.held, self.dict_bytes)
        data = own.as_bytes()
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=own, write_checksum=True, write_content_size=True)
        for record in self.held:
            self._put(self.compressor.compress(record))
        self.held.clear()

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.stream.close()


def write_archives(records: DataFrame, folder: str, dict_bytes: int = 32 << 10, train_bytes: int = 2 << 20, archive_bytes: int = 256 << 20, level: int = 3, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of plan_records() to archives under folder, a URI that
    all executors can write to; returns the manifest, a written table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        attempt = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"  # no other attempt has this name
        out, names = None, []

        def finish() -> tuple[str, int, int]:
            out.close()
            return names[-1], out.n_records, out.n_bytes

        done = []
        for batch in slices(batches):
            for page_id, url, payload, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and out.raw_bytes >= archive_bytes:
                    done.append(finish())
                    out = None
                if out is None:
                    names.append(f"{root}/part-{attempt}-{len(names):04d}.warc.zst")
                    out = ArchiveWriter(fs.open_output_stream(names[-1], compression=None), dict_bytes, train_bytes, level)
                out.add(make_record(page_id, url, payload, sha1, refers_to, date))
        if out is not None:
            done.append(finish())
        for path, n, size in done:
            yield pa.RecordBatch.from_pydict({"archive": [path.rpartition("/")[2]], "n_records": [n], "n_bytes": [size]})

    return written(records.mapInArrow(write, MANIFEST_SQL), "manifest")


def frames(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset of the frame, record) of an archive, one record at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't start with a dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    at, rest = 8 + size, b""
    while rest or (rest := stream.read(chunk)):
        frame, parts, start = reader.decompressobj(), [], at
        while True:
            parts.append(frame.decompress(rest))
            at += len(rest)
            if frame.eof:
                rest = frame.unused_data
                at -= len(rest)
                break
            if not (rest := stream.read(chunk)):
                raise ValueError("the archive ends within a record")
        yield start, b"".join(parts)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives that the manifest names. Digest and
    length of a response are taken from the payload read, and must agree with
    its header; those of a revisit are its header's."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, record in frames(stream):
                        warc, http, payload = parse_record(record)
                        digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
                        size, refers = int(http["content-length"]), warc.get("x-refers-to-page-id")
                        if warc["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"{name}: the payload at {offset} doesn't match its digest")
                        page = warc["x-page-id"]
                        rows.append((int(page) if page else None, size, digest, warc["warc-type"], int(refers) if refers else None, warc["warc-target-uri"], name, offset))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    return manifest.select("archive").mapInArrow(read, RECORD_SQL)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None, **options) -> DataFrame:
    """Write all rows to archives, then read the archives back."""
    folder = folder or new_path(pages.sparkSession, "warc")
    manifest = write_archives(plan_records(pages, id_col, url_col, payload_col), folder, **options)
    return read_archives(manifest, folder)
