"""WARC records in ZIP packages: writing, and reading by byte ranges without extraction.

A package is a ZIP file with two stored (uncompressed) members: archive/data.warc.gz, one gzip member for each record,
and indexes/index.cdxj, a line for each record with its place in the archive. Tasks write packages of bounded size to
the shared folder under names of their own; what counts is the manifest, written by Spark's committer, so the files of
lost or repeated attempts are never read.

Reading takes four steps: the end of central directory is found in the file's tail, with its ZIP64 records where a
field is saturated; the central directory gives the members; a stored member's data begins after its local header; the
index is read and cut into splits of bounded size, and each split is one range read, in which the index's lengths tell
where records lie. Splits are dealt to a stated number of tasks: a list of splits is small, whatever it stands for.

Defined results: a null payload is empty; a null URL is left out; records keep the id they were given (repeated ids
too) and payloads of any length; columns other than record_id, url and payload don't enter. Of rows with equal payloads of `least_bytes` or more, those with the largest id are responses, the others revisit
it; a null id is the smallest. Digests are checked while reading, and a mismatch fails the job. An empty table gives an
empty manifest and no records.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, stored

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
LEAST_BYTES = 1000
LEVEL = 4
STAMP = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


# -- ZIP directories ---------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header_at: int


def _zip64(extra: bytes, values: list[int]) -> list[int]:
    """Saturated 32-bit values, replaced in order by those of the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            body, k = extra[at + 4 : at + 4 + n], 0
            for i, v in enumerate(values):
                if v == 0xFFFFFFFF:
                    (values[i],) = struct.unpack_from("<Q", body, k)
                    k += 8
            break
        at += 4 + n
    return values


def read_directory(file, size: int) -> list[Member]:
    """Members of the ZIP file by its central directory."""
    tail = min(size, 22 + 65535 + 20)
    file.seek(size - tail)
    block = file.read(tail)
    at = block.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, begin = struct.unpack_from("<HII", block, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or begin == 0xFFFFFFFF:
        if at < 20 or block[at - 20 : at - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (end64,) = struct.unpack_from("<Q", block, at - 20 + 8)
        file.seek(end64)
        record = file.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, begin = struct.unpack_from("<QQQ", record, 32)
    file.seek(begin)
    directory, at, members = file.read(length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, full = struct.unpack_from("<II", directory, at + 20)
        names, extras, comments = struct.unpack_from("<HHH", directory, at + 28)
        (header_at,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + names].decode("utf-8", "replace")
        full, packed, header_at = _zip64(directory[at + 46 + names : at + 46 + names + extras], [full, packed, header_at])
        members.append(Member(name, method, packed, header_at))
        at += 46 + names + extras + comments
    return members


def data_begin(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; it can't be read by ranges")
    file.seek(member.header_at)
    header = file.read(30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    names, extras = struct.unpack_from("<HH", header, 26)
    return member.header_at + 30 + names + extras


def _open(uri: str):
    store, path = arrow_fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


# -- records -----------------------------------------------------------------------------------------------------
def build_record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record, as a gzip member: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Date: {STAMP}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    return gzip.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def parse_record(raw: bytes, with_payload: bool) -> tuple:
    """A row of RECORDS from an inflated record; fails if a response's payload does not match its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    bare = lambda name: fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else None
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    length = len(payload) if kind == "response" else int(fields["Payload-Length"])
    return bare("WARC-Record-ID"), kind, fields.get("WARC-Target-URI"), bare("WARC-Refers-To"), digest, length, payload if with_payload and kind == "response" else None


class _Package:
    """A package under way: records go to the ZIP as they come, the index when it is closed."""

    def __init__(self, folder: str) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = arrow_fs.FileSystem.from_uri(self.uri)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.lines: list[str] = []
        self.at = 0

    def add(self, record_id: str, record: bytes) -> None:
        self.data.write(record)
        self.lines.append(json.dumps({"id": record_id, "offset": self.at, "length": len(record)}))
        self.at += len(record)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines) + "\n")
        self.zip.close()
        self.out.close()
        return self.uri, len(self.lines), self.at


def plan_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(record_id, url, payload, digest, refers_to) from (record_id, url, payload); the payload column is not shuffled
    where the table of repeated digests is small enough for a broadcast join, else the join may split hot digests."""
    rows = pages.withColumn("payload", F.coalesce("payload", F.lit("").cast("binary")))
    rows = rows.withColumn("digest", F.sha1("payload"))
    again = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.max("record_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    again = stored(again.where("n > 1 AND kept IS NOT NULL").select("digest", "kept"), "warc-again")
    joined = rows.join(again, "digest", "left")
    other = F.col("kept").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("kept"))
    return joined.select("record_id", "url", "payload", "digest", F.when(other, F.col("kept")).alias("refers_to"))


def write_packages(planned: DataFrame, folder: str | None = None, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write records to packages; gives the manifest (uri, records, archive_bytes)."""
    folder = folder or scratch_path(planned.sparkSession, "warc")
    store, path = arrow_fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*[batch.column(k) for k in range(5)], strict=True):
                package = package or _Package(folder)
                name = "" if page_id.as_py() is None else str(page_id.as_py())
                to = None if refers_to.as_py() is None else str(refers_to.as_py())
                package.add(name, build_record(name, url.as_py(), payload.as_py(), digest.as_py(), to))
                if package.at >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_pydict({"uri": [d[0] for d in done], "records": [d[1] for d in done], "archive_bytes": [d[2] for d in done]}, schema=MANIFEST)

    return stored(planned.select("record_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "uri string, records long, archive_bytes long"), "warc-manifest")


MANIFEST = pa.schema([("uri", pa.string()), ("records", pa.int64()), ("archive_bytes", pa.int64())])
SPLITS = pa.schema([("uri", pa.string()), ("begin", pa.int64()), ("lengths", pa.list_(pa.int64()))])


def find_splits(packages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(uri, begin, lengths): ranges of whole records with the lengths of these, from each package's directory and index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for uri in batch.column("uri").to_pylist():
                with _open(uri) as file:
                    members = {m.name: m for m in read_directory(file, file.size())}
                    data, index_at = data_begin(file, members[ARCHIVE]), data_begin(file, members[INDEX])
                    file.seek(index_at)
                    index = file.read(members[INDEX].size).decode()
                begin, lengths, size = 0, [], 0
                for line in filter(None, index.split("\n")):
                    entry = json.loads(line)
                    if lengths and (size + entry["length"] > split_bytes or entry["offset"] != begin + size):
                        rows.append((uri, data + begin, lengths))
                        lengths, size = [], 0
                    begin = begin if lengths else entry["offset"]
                    lengths.append(entry["length"])
                    size += entry["length"]
                if lengths:
                    rows.append((uri, data + begin, lengths))
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, SPLITS, strict=True)], schema=SPLITS)

    return packages.select("uri").mapInArrow(run, "uri string, begin long, lengths array<long>")


def read_records(packages: DataFrame, with_payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the packages of a manifest, as rows of RECORDS."""
    size = packages.agg(F.sum("archive_bytes"), F.count(F.lit(1))).first()
    tasks = max(1, (size[0] or 0) // split_bytes + size[1])
    splits = find_splits(packages, split_bytes).repartition(tasks, "uri", "begin")
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, begin, lengths in zip(*[batch.column(c).to_pylist() for c in ("uri", "begin", "lengths")], strict=True):
                with _open(uri) as file:
                    file.seek(begin)
                    data = memoryview(file.read(sum(lengths)))
                rows, at = [], 0
                for length in lengths:
                    rows.append(parse_record(zlib.decompress(data[at : at + length], wbits=31), with_payload))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return splits.mapInArrow(run, RECORDS)
