"""WARC archives with an index first: write records, index them, read selected ones back by byte range.

Writing. Every page becomes one record, a gzip member of its own, in an archive file of
the task that holds it. A page whose payload (UTF-8 of the html) has at least ``MIN_SHARED``
bytes and equals that of a page with a larger id becomes a ``revisit`` record: its block holds
the HTTP header with the payload's length, and it refers to the page with the largest id, which
is a ``response``. The index has one row per record: page, file, offset, length, URL, digest.

Reading. Selected index rows are dealt by file and block of ``READ_BLOCK`` bytes, sorted by
offset, and adjacent ranges (gaps up to ``GAP``) are coalesced to single reads of at most
``READ_SPAN`` bytes. A record's digest is checked against its payload.

Archives are written through ``pyarrow.fs`` to a folder that all executors share. A file's name
holds the task's partition and a unique part, and only the index rows of the attempt that
succeeded name it, so a task that is run again leaves at most an unnamed file behind. The index is
stored before anything reads it.

Defined results: a null html is an empty payload; a null URL leaves its header out; line ends
in a URL are percent-encoded in the header. Rows that repeat the largest page id of a shared
payload are all responses. Rows with a null id are ordinary records without an id.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship
from obsframe.session import scratch_path

MIN_SHARED = 1000
FILE_BYTES = 1 << 30
READ_BLOCK = 16 << 20
READ_SPAN = 8 << 20
GAP = 64 << 10
INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, record_type string, refers_to long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload string"
URN = "urn:x-page:"
# Fixed value: the profile that the WARC 1.1 standard names for this kind of revisit.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(folder: str):
    """The file system of a folder as Spark names it, and the folder's path in it."""
    from pyarrow import fs
    if re.match(r"file:/(?!//)", folder):
        folder = "file:///" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def plan_records(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """``page_id, url, html, payload_digest, refers_to`` (null for responses).

    Digests of copies are combined on the map side; only digests that occur twice are joined back."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.sha1(html).alias("payload_digest"))
    shared = (p.where(F.octet_length("html") >= min_shared).groupBy("payload_digest")
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    shared = materialise(shared, "warc-shared-payloads")
    return p.join(shared, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last")).alias("refers_to"))


def _member(record: bytes) -> bytes:
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0) as z:
        z.write(record)
    return out.getvalue()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC 1.1 record, not compressed."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _id(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(URN)
    return int(digits) if digits else None


def parse_record(record: bytes) -> tuple:
    """A row of ``RECORDS``; the payload of a revisit is null."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record of a wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload does not match its digest")
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return (_id(fields["WARC-Record-ID"]), url, kind, _id(fields.get("WARC-Refers-To")), size, digest,
            payload.decode() if kind == "response" else None)


def _int(x) -> int | None:
    return None if x is None or x != x else int(x)


def write_archives(pages: DataFrame, folder: str, min_shared: int = MIN_SHARED, date: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives below ``folder`` and return their stored index."""
    ship(pages.sparkSession)
    stamp = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page, url, html, digest, refers in zip(b["page_id"].astype(object), b["url"], b["html"], b["payload_digest"],
                                                           b["refers_to"].astype(object), strict=True):
                    page, refers = _int(page), _int(refers)
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    member = _member(make_record(page, url, html.encode(), digest, refers, stamp))
                    out.write(member)
                    rows.append((page, url, name, at, len(member), digest, "response" if refers is None else "revisit", refers))
                    at += len(member)
                found = pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])
                yield found.astype({"page_id": "Int64", "refers_to": "Int64"})
        finally:
            if out is not None:
                out.close()

    return materialise(plan_records(pages, min_shared).mapInPandas(write, INDEX), "warc-index")


def spans(offsets: list[int], lengths: list[int], gap: int = GAP, most: int = READ_SPAN) -> list[tuple[int, int, int, int]]:
    """Coalesced reads (first row, past last row, start byte, past end byte) of ranges sorted by offset."""
    out: list[tuple[int, int, int, int]] = []
    for i, (o, n) in enumerate(zip(offsets, lengths, strict=True)):
        if out and o - out[-1][3] <= gap and o + n - out[-1][2] <= most:
            out[-1] = (out[-1][0], i + 1, out[-1][2], max(out[-1][3], o + n))
        else:
            out.append((i, i + 1, o, o + n))
    return out


def deal_reads(index: DataFrame, block_bytes: int = READ_BLOCK) -> DataFrame:
    """Index rows in as many tasks as the selected records' bytes ask for: the rows themselves are tiny, so a count
    left to Spark would follow their size and put many GB of archive into one task."""
    selected = index.agg(F.sum("length")).first()[0] or 0
    block = F.floor(F.col("offset") / block_bytes)
    return (index.select("file", "offset", "length", block.alias("block"))
            .repartition(max(1, -(-selected // block_bytes)), "file", "block").sortWithinPartitions("file", "offset"))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records (``RECORDS``) that the index rows name."""
    ship(index.sparkSession)
    names = [c.split()[0] for c in RECORDS.split(", ")]
    dealt = deal_reads(index)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = file_system(folder)
        for b in batches:
            for name, g in b.groupby("file", sort=False):
                offsets, lengths = g["offset"].tolist(), g["length"].tolist()
                with store.open_input_file(f"{base}/{name}") as f:
                    for lo, hi, start, end in spans(offsets, lengths):
                        data = f.read_at(end - start, start)
                        rows = [parse_record(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in zip(offsets[lo:hi], lengths[lo:hi], strict=True)]
                        yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt.mapInPandas(read, RECORDS)


def archive_folder(spark) -> str:
    """A new folder for archives in the shared scratch space."""
    return scratch_path(spark, f"warc-{uuid.uuid4().hex}")
