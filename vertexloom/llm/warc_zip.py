"""WARC records in ZIP packages: written by tasks, read back by ranges.

A package is a ZIP file with two stored (uncompressed) members: the WARC
records of one task, and an index with the offset and length of each record
in the other member. The reader takes the end of the file, follows the
end-of-central-directory records (ZIP64 ones too) to the central directory,
finds the stored members' bytes from their local headers, reads the index,
and then range-reads chunks of whole records. Nothing is unpacked to disk.

Of pages with equal payloads one is written whole, as a response; the others
are revisits that refer to it and carry no payload; the length of the full
payload stays in their HTTP header. Packages are written once: their list is
a table in the shared folder, and a package left by a lost task is in no list.

Files are opened with pyarrow's file systems, so the folder can be any that
all workers can open by its URI; one without a scheme is on Spark's default
file system, and a scheme that they can't open raises before anything runs.
Payloads that may be shared are shuffled by digest where the digests of
copies are too many to broadcast.

Defined cases: a null html is an empty payload; a null url gives no target
URI; pages without an id are responses (a revisit must name its response),
and a group in which no page has an id is all responses; of repeated rows
with the largest id all are responses; a very long html is one record, kept
whole; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.functions.settle import place_for_workers
from vertexloom.llm.common import counted_join, shared_path, small_batches, table, written

PACKAGE_BYTES = 256 << 20
CHUNK_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
RECORDS, INDEX = "archive/data.warc", "indexes/index.tsv"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _parsed(record: bytes) -> tuple:
    """(page, payload's length, digest, type, page referred to) of one record; a response's digest is checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't hold its payload")
    return _page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], _page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None


def _write_packages(folder: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        rows = (row for batch in batches for row in batch.to_pylist())
        row = next(rows, None)
        while row is not None:
            name, places, at = f"{uuid.uuid4().hex}.zip", [], 0
            with files.open_output_stream(f"{root}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
                with package.open(RECORDS, "w", force_zip64=True) as member:
                    while row is not None and at < package_bytes:
                        record = _record(row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"], row["revisit"])
                        member.write(record)
                        places.append(f"{at}\t{len(record)}\n")
                        at += len(record)
                        row = next(rows, None)
                with package.open(INDEX, "w", force_zip64=True) as member:
                    member.write("".join(places).encode())
            yield pa.RecordBatch.from_pydict({"package": [name], "records": [len(places)], "bytes": [at]})

    return run


def write_packages(pages: DataFrame, folder: str, least: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record for each page; the written list of packages. Payloads under ``least`` bytes are never revisits."""
    small_batches(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"))
    same = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("refers_to"))
    same = written(same.filter("n > 1 and refers_to is not null").select("digest", "refers_to", "n"), "warc-same")
    joined = counted_join(rows, same, ["digest"], "left", "n")
    revisit = F.coalesce(F.col("page_id") != F.col("refers_to"), F.lit(False))
    made = joined.select("page_id", "url", "html", "refers_to", revisit.alias("revisit")).mapInArrow(_write_packages(place_for_workers(pages.sparkSession, folder), package_bytes), "package string, records long, bytes long")
    return written(made, "warc-packages")


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (place of its bytes, their number) of the stored members of a ZIP file."""

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if 0xFFFF in (entries,) or 0xFFFFFFFF in (length, start) or tail[end - 20 : end - 16] == b"PK\x06\x07":
        (at,) = struct.unpack("<Q", tail[end - 12 : end - 4])
        record = read(at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack("<QQQ", record[32:56])
    central, at, found = read(start, length), 0, {}
    for _ in range(entries):
        if central[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is cut off")
        (method,) = struct.unpack("<H", central[at + 10 : at + 12])
        packed, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", central[at + 20 : at + 34])
        (local,) = struct.unpack("<I", central[at + 42 : at + 46])
        name = central[at + 46 : at + 46 + n_name].decode()
        extra = central[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # the 64-bit values stand in this order, each only where the short field is full
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        at += 46 + n_name + n_extra + n_comment
        if method == 0:
            own_name, own_extra = struct.unpack("<HH", read(local + 26, 4))
            found[name] = (local + 30 + own_name + own_extra, plain)
    return found


def _chunks(folder: str, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out: dict[str, list] = {"package": [], "start": [], "lengths": []}
                with files.open_input_file(f"{root}/{name}") as file:
                    members = directory(file, file.size())
                    base, at = members[RECORDS][0], members[INDEX][0]
                    file.seek(at)
                    index = file.read(members[INDEX][1]).decode()
                for line in index.splitlines():
                    offset, length = map(int, line.split("\t"))
                    if not out["lengths"] or sum(out["lengths"][-1]) >= chunk_bytes or len(out["lengths"][-1]) >= 2000:
                        out["package"].append(name)
                        out["start"].append(base + offset)
                        out["lengths"].append([])
                    out["lengths"][-1].append(length)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("package", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))]))

    return run


def _records(folder: str):
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                with files.open_input_file(f"{root}/{row['package']}") as file:
                    file.seek(row["start"])
                    for length in row["lengths"]:
                        rows.append(_parsed(file.read(length)))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)

    return run


def read_packages(packages: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each record of the packages: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = place_for_workers(packages.sparkSession, folder)
    tasks = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = packages.select("package").repartition(tasks).mapInArrow(_chunks(folder, chunk_bytes), "package string, start long, lengths array<long>")
    return chunks.repartition(tasks).mapInArrow(_records(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    return read_packages(write_packages(table(spark, sf_dir, "pages"), folder), folder)


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (
  SELECT hex, count(*) AS n, max(page_id) AS top FROM p GROUP BY hex)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - i % 4 * 5)::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN n > 1 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id <> top THEN top END AS refers_to
FROM p JOIN g USING (hex)
"""
