"""Web pages as WARC records in ZIP packages, and back by range reads.

A package holds, uncompressed, ``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` (one line a record, with offset and length), so that a record is
a range of the package. Each task writes a package of its own and the packages' table,
one file, lists those that count; reading deals packages to tasks by their bytes. So no
more files are made through Spark's writers than the data asks for: where Hadoop has no
native library, each costs the executor processes, made from the whole of its JVM.

Repeated payloads become revisit records. Only (page, digest) pairs are shuffled to find
them; a digest held by a third of all pages is aggregated before the shuffle, and the
pages themselves are shuffled by page and digest, which spreads them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.files import make_file, make_folder, new_folder, open_file
from freightlens.llm.ragged import slices
from freightlens.llm.zip_archive import ZipArchive

# Fixed values of the WARC 1.1 and package formats.
WARC, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RESULT = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "target_uri string")
#: Bytes of a package read at a time; packages that together have no more are read by one task.
WINDOW = 4 << 20


def _page_uri(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page_of(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def _one_line(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit carries the reply's head only."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{_page_uri(page_id)}>"),
              ("WARC-Date", DATE), ("WARC-Target-URI", _one_line(url) if url else _page_uri(page_id)),
              ("WARC-Payload-Digest", f"sha1:{_base32(digest)}")]
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{_page_uri(refers_to)}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields, reply fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[:int(fields["content-length"])]
    reply, _, payload = block.partition(b"\r\n\r\n")
    replied = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in reply.decode("latin-1").split("\r\n")[1:])}
    return fields, replied, payload


def _roles(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that revisit another."""
    narrow = pages.select("page_id", "payload_digest").where(F.octet_length("html") >= least)
    shared = (narrow.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
              .where("n > 1 and refers_to is not null").drop("n"))
    return (narrow.join(shared, "payload_digest").where("not (page_id <=> refers_to)")
            .select(F.col("page_id").alias("role_page"), F.col("payload_digest").alias("role_digest"), "refers_to").distinct())


def write_packages(pages: DataFrame, folder: str | None = None, least_revisit: int = 1000) -> str:
    """Write a record per row of (page_id, url, html), return the folder.

    Of equal payloads of at least ``least_revisit`` bytes the largest page_id's is the
    response. A null html is an empty payload; a null page_id can only revisit; rows that
    repeat the largest page_id are all responses. An empty table gives no package.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "packages")
    make_folder(folder)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1("html"))
    roles = _roles(rows, least_revisit)
    ready = rows.join(roles, rows.page_id.eqNullSafe(roles.role_page) & (rows.payload_digest == roles.role_digest), "left")
    ready = ready.select("page_id", "url", F.encode("html", "utf-8").alias("html"), "payload_digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = Package(folder)
                out.add(row)
        if out is not None:
            yield pa.RecordBatch.from_pydict({"path": [out.close()], "n_records": [len(out.index)], "n_bytes": [out.size]})

    listed = ready.mapInArrow(write, "path string, n_records long, n_bytes long").repartition(1)  # a row a package
    listed.write.parquet(f"{folder}/packages")
    return folder


class Package:
    """Streams records into a package; only the index waits for the end."""

    def __init__(self, folder: str):
        self.stream, self.path = make_file(folder, "pages-wacz")
        self.archive = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.archive.open(WARC, "w", force_zip64=True)
        self.index: list[bytes] = []
        self.offset, self.digest = 0, hashlib.sha256()

    def add(self, row: dict) -> None:
        revisit = row["refers_to"] is not None
        raw = gzip.compress(record(row["page_id"], row["url"], row["html"], row["payload_digest"], row["refers_to"], revisit), 4, mtime=0)
        self.member.write(raw)
        self.digest.update(raw)
        entry = {"url": row["url"], "digest": f"sha1:{_base32(row['payload_digest'])}", "filename": "data.warc.gz",
                 "offset": self.offset, "length": len(raw), "type": "revisit" if revisit else "response"}
        self.index.append(f"{_page_uri(row['page_id'])} 19700101000000 {json.dumps(entry)}\n".encode())
        self.offset += len(raw)

    def close(self) -> str:
        self.member.close()
        with self.archive.open(INDEX, "w", force_zip64=True) as member:
            for line in self.index:
                member.write(line)
        resources = [{"name": "data.warc.gz", "path": WARC, "bytes": self.offset, "hash": f"sha256:{self.digest.hexdigest()}"},
                     {"name": "index.cdxj", "path": INDEX, "bytes": sum(map(len, self.index))}]
        self.archive.writestr(PACKAGE, json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": resources}))
        self.archive.close()
        self.size = self.stream.tell()
        self.stream.close()
        return self.path


def package_records(path: str) -> Iterator[tuple[dict, dict, bytes]]:
    """Parsed records of a package, located by its index and read in windows."""
    with open_file(path) as file:
        archive = ZipArchive(file)
        entries = [json.loads(line.split(b" ", 2)[2]) for line in archive.read(INDEX).splitlines()]
        entries.sort(key=lambda e: e["offset"])
        base, size = archive.data_at(WARC), archive.members[WARC].size
        start, window = 0, b""
        for entry in entries:
            a, b = entry["offset"], entry["offset"] + entry["length"]
            if b > size:
                raise ValueError(f"{path}: a record beyond the end of {WARC}")
            if a < start or b > start + len(window):
                start, window = a, file.read_at(min(max(WINDOW, b - a), size - a), base + a)
            yield parse(gzip.decompress(window[a - start:b - start]))


def read_packages(spark, folder: str) -> DataFrame:
    """A row a record of all packages of ``folder``; digests and sizes of responses are
    taken from the payload and held against the record's own fields, those of revisits
    are what the record says of the payload it stands for."""
    found = sorted(spark.read.parquet(f"{folder}/packages").select("n_bytes", "path").collect())  # a row a file
    shares = [([found[i].path for i in range(a, b)],) for a, b in slices(np.array([row.n_bytes for row in found]), WINDOW)]
    listed = spark.createDataFrame(shares, "paths array<string>").repartition(max(1, len(shares)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            for path in pc.list_flatten(batch.column("paths")).to_pylist():
                rows = []
                for fields, reply, payload in package_records(path):
                    said = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    n_bytes, kind = int(reply["content-length"]), fields["warc-type"]
                    if kind == "response" and (len(payload) != n_bytes or hashlib.sha1(payload).hexdigest() != said):
                        raise ValueError(f"{path}: the payload of {fields['warc-record-id']} is not what its record says")
                    rows.append((_page_of(fields["warc-record-id"]), n_bytes, said, kind,
                                 _page_of(fields.get("warc-refers-to")), fields["warc-target-uri"]))
                columns = zip(*rows) if rows else [[]] * len(names)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return listed.mapInArrow(read, RESULT)
