"""Operator 5: WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``frame_bytes``
of WARC text; a bundle is a file of frames that ends in a seek table (a skippable
frame with the compressed and plain size of each frame, and a footer).  The index
maps each record to (bundle, frame, offset in the frame, length), so a record is
read by decompressing its frame alone.

Each task writes its own bundles under the shared folder, with a name of its
own for each attempt, and returns the index rows; the index is stored, so only
bundles of attempts that succeeded are ever listed.  Bundles are written and read
with the file system of the folder's URI (pyarrow).

Equal payloads (by SHA-1 and length) of ``least_bytes`` or more: the one with the
smallest page_id is a response, the others are revisits that refer to it.

Edge cases: null html is an empty payload; a null page_id sorts last and writes
no page header; rows that repeat the smallest page_id are responses too.  URLs
are written on one line.  Extra columns are ignored; empty tables give an empty
index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.tables import stored
from linewise.session import scratch_path

# Fixed values of the seekable format.
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

INDEX = "page_id long, record_type string, bundle string, frame int, offset long, length long"
RECORD = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; ``refers_to`` (the response's page_id) makes it a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
            f"WARC-Date: {date}", "WARC-Target-URI: " + "%20".join((url or "").split()),
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers in lower case, body, place after the record)."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    begin = end + 4
    stop = begin + int(head["content-length"])
    return head, data[begin:stop], stop + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(place, compressed size, plain size) of each frame, from the end of the file."""
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    raw, at, out = file.read(8 * n), 0, []
    for k in range(n):
        packed, plain = struct.unpack_from("<II", raw, 8 * k)
        out.append((at, packed, plain))
        at += packed
    return out


class _Bundle:
    def __init__(self, folder: str, level: int):
        self.path = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        fs, path = file_system(self.path)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.file, self.level, self.sizes, self.records, self.plain, self.total = fs.open_output_stream(path, compression=None), level, [], [], 0, 0

    def add(self, page_id, kind: str, record: bytes):
        self.records.append((page_id, kind, record, self.plain))
        self.plain += len(record)

    def close_frame(self):
        rows = [(p, k, self.path, len(self.sizes), at, len(r)) for p, k, r, at in self.records]
        if rows:
            frame = zstandard.ZstdCompressor(level=self.level).compress(b"".join(r for _, _, r, _ in self.records))
            self.file.write(frame)
            self.sizes.append((len(frame), self.plain))
            self.total += len(frame)
        self.records, self.plain = [], 0
        return rows

    def close(self):
        self.file.write(seek_table(self.sizes))
        self.file.close()


def _write(batches, folder: str, frame_bytes: int, bundle_bytes: int, date: str, level: int):
    bundle = None
    for batch in batches:
        rows = []
        for page_id, url, payload, digest, first in zip(*(batch.column(c).to_pylist() for c in
                                                          ("page_id", "url", "payload", "digest", "refers_to"))):
            if bundle is None:
                bundle = _Bundle(folder, level)
            base32 = base64.b32encode(bytes.fromhex(digest)).decode()
            bundle.add(page_id, "response" if first is None else "revisit",
                       warc_record(page_id, url, payload, base32, first, date))
            if bundle.plain >= frame_bytes:
                rows += bundle.close_frame()
                if bundle.total >= bundle_bytes:
                    bundle.close()
                    bundle = None
        yield _index(rows)
    if bundle is not None:
        yield _index(bundle.close_frame())
        bundle.close()


def _index(rows):
    cols = list(zip(*rows)) or [()] * 6
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                           names=["page_id", "record_type", "bundle", "frame", "offset", "length"])


def write_bundles(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least_bytes: int = 0, frame_bytes: int = 1 << 20, bundle_bytes: int = 64 << 20,
                  date: str = "2024-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write one record per row into bundles under ``folder``; returns the stored index."""
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    firsts = (rows.where(F.col("size") >= least_bytes).groupBy("digest", "size")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    planned = rows.join(firsts, ["digest", "size"], "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    write = partial(_write, folder=folder, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes, date=date, level=level)
    return stored(planned.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, INDEX), "warc-index")


def _record_row(head: dict, body: bytes):
    number = lambda key: int(head[key]) if key in head else None
    if head["warc-type"] == "response":
        payload = body[body.index(b"\r\n\r\n") + 4:]
        return number("x-page-id"), "response", len(payload), base32_sha1(payload), None
    return (number("x-page-id"), head["warc-type"], number("x-payload-length"),
            head["warc-payload-digest"].removeprefix("sha1:"), number("x-refers-to-page-id"))


def _read(batches):
    for batch in batches:
        frames: dict[str, list[int]] = {}
        for name, frame in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist()):
            frames.setdefault(name, []).append(frame)
        for name, wanted in frames.items():
            fs, path = file_system(name)
            size = fs.get_file_info(path).size
            with fs.open_input_file(path) as file:
                table = read_seek_table(file, size)
                for frame in sorted(wanted):
                    at, packed, _ = table[frame]
                    file.seek(at)
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(file.read(packed))
                    rows, place = [], 0
                    while place < len(data):
                        head, body, place = parse_record(data, place)
                        rows.append(_record_row(head, body))
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          names=["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"])


def read_bundles(index: DataFrame, *, frames_per_task: int = 8) -> DataFrame:
    """page_id, record_type, payload_bytes, payload_digest, refers_to of every record of the index's bundles.

    Frames are dealt to tasks by a stated number of partitions, which adaptive
    execution does not merge; each task finds its frames by the seek tables.
    """
    frames = index.select("bundle", "frame").distinct()
    tasks = max(1, -(-frames.count() // frames_per_task))
    return frames.repartition(tasks, "bundle", "frame").mapInArrow(_read, RECORD)


def read_record(bundle: str, frame: int, offset: int, length: int) -> tuple[dict, bytes]:
    """One record by its index entry: only its frame is read and decompressed."""
    fs, path = file_system(bundle)
    with fs.open_input_file(path) as file:
        at, packed, _ = read_seek_table(file, fs.get_file_info(path).size)[frame]
        file.seek(at)
        data = zstandard.ZstdDecompressor().decompressobj().decompress(file.read(packed))
    head, body, _ = parse_record(data[offset:offset + length])
    return head, body


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write all pages, then read all archives back."""
    return read_bundles(write_bundles(pages, scratch_path(pages.sparkSession, "warc"), **options))
