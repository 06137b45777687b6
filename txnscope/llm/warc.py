"""WARC archives: writing captures, and assembling transactions from records.

``write_archives`` writes three records per page (request, response or revisit,
metadata), each its own gzip member, into bounded files of the shared folder. Pages
with equal payloads are found by their SHA-1: the smallest page id is the response,
the others are revisit records that refer to it. ``read_records`` reads archives file
by file, and ``assemble`` joins request, main and metadata records through their
``WARC-Concurrent-To`` identifiers into one nested row per capture.

A payload may be shared by any share of the pages: the smallest id is pre-aggregated
per (digest, salt), so neither the aggregate nor the join gathers a digest's pages in
one task.

Defined cases: null html is an empty payload; a null url leaves the target header out;
control characters of urls are percent-encoded; null page ids never become the
referred page while the payload has a page with an id; rows that repeat a page id and
payload are all responses when it is the smallest; an empty table writes no file; a
request or metadata record without a main record gives a row whose main record is null;
other columns of the table are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import create_file, open_file, read_table, shared_folder, task_file, written

SALTS = 64
FILE_BYTES = 64 << 20           # payload bytes after which a task begins a new file
LEAST_REVISIT_BYTES = 0
CAPTURED = "2024-01-01T00:00:00Z"
# fixed values of the WARC 1.1 format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = ("file string, record_id string, record_type string, concurrent_to string, "
                 "refers_to string, target_uri string, payload_digest string, payload_bytes long, "
                 "fields map<string,string>, block binary")
MANIFEST_SCHEMA = "path string, n_records long"


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def main_record_id(digest: str) -> str:
    """The id of the response that revisits of a payload refer to."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(digest.encode()).digest())}>"


def record(kind: str, record_id: str, block: bytes, content_type: str, date: str,
           headers: list[tuple[str, str | None]]) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}",
             f"WARC-Date: {date}"]
    lines += [f"{k}: {v}" for k, v in headers if v is not None]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def _header_uri(url) -> str | None:
    if url is None or (isinstance(url, float) and url != url):
        return None
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _capture(page_id, url, payload: bytes, digest: str, first_page, own_id: str,
             run: str, date: str) -> bytes:
    uri = _header_uri(url)
    revisit = first_page is not None
    main = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if revisit:
        main += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", main_record_id(digest))]
    out = record("revisit" if revisit else "response", own_id,
                 http if revisit else http + payload,
                 "application/http; msgtype=response", date, main)
    other = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", own_id)]
    path = re.sub(r"^[a-zA-Z][\w+.-]*://[^/?#]*", "", uri or "").split("#")[0] or "/"
    host = re.sub(r"^[a-zA-Z][\w+.-]*://", "", uri or "").split("/")[0].split("?")[0].split("#")[0]
    get = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    ids = [f"<urn:uuid:{uuid.uuid5(uuid.UUID(run), f'{own_id}{k}')}>" for k in ("q", "m")]
    fields = f"payload-bytes: {len(payload)}\r\n"
    if page_id is not None:
        fields = f"page-id: {page_id}\r\n" + fields
    return (record("request", ids[0], get, "application/http; msgtype=request", date, other) + out
            + record("metadata", ids[1], fields.encode(), "application/warc-fields", date, other))


def with_first_page(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, sha1 and the smallest page id of equal payloads."""
    base = (pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                         F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
            .withColumn("sha1", F.sha1("payload"))
            .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS))))
    salted = base.groupBy("sha1", "salt").agg(F.min("page_id").alias("m"))
    first = salted.select("sha1", "salt", F.min("m").over(Window.partitionBy("sha1")).alias("first"))
    return (base.join(first.hint("shuffle_hash"), ["sha1", "salt"])
            .withColumn("first", F.when(F.octet_length("payload") >= least, F.col("first"))))


def write_archives(pages: DataFrame, folder: str, date: str = CAPTURED,
                   least: int = LEAST_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages' records; returns the manifest (path, n_records) of the files."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = str(uuid.uuid4())
        out, uri, size, n, made, used = None, "", 0, 0, [], set()
        for b in batches:
            for page, url, payload, sha1, first in zip(
                    b["page_id"], b["url"], b["payload"], b["sha1"], b["first"]):
                if out is None:
                    uri = task_file(folder, ".warc.gz")
                    out, size, n = create_file(uri), 0, 0
                page = None if pd.isna(page) else int(page)
                first = None if pd.isna(first) else int(first)
                digest = base32_digest(sha1)
                revisit = first is not None and page != first
                record_id = main_record_id(digest)
                # rows that repeat the smallest page share a salt, so a task sees them all
                if revisit or first is None or digest in used:
                    record_id = f"<urn:uuid:{uuid.uuid4()}>"
                else:
                    used.add(digest)
                payload = bytes(payload)
                out.write(_capture(page, url, payload, digest, first if revisit else None,
                                   record_id, own, date))
                size, n = size + len(payload), n + 3
                if size >= file_bytes:
                    out.close()
                    made.append((uri, n))
                    out = None
        if out is not None:
            out.close()
            made.append((uri, n))
        yield pd.DataFrame(made, columns=["path", "n_records"])
    rows = with_first_page(pages, least).select("page_id", "url", "payload", "sha1", "first")
    return written(rows.mapInPandas(run, MANIFEST_SCHEMA), "warc-manifest")


def parse_archive(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of a gzipped archive; names in lower case."""
    at = 0
    while at < len(data):
        unpacker = zlib.decompressobj(31)
        raw = unpacker.decompress(data[at:at + (1 << 16)])
        fed = at + (1 << 16)
        while not unpacker.eof:
            if fed >= len(data):
                raise ValueError("the archive ends inside a record")
            raw += unpacker.decompress(data[fed:fed + (1 << 20)])
            fed += 1 << 20
        at = min(fed, len(data)) - len(unpacker.unused_data)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        yield headers, rest[:int(headers["content-length"])]


def _row(file: str, h: dict, block: bytes, with_blocks: bool) -> tuple:
    kind, fields, size = h["warc-type"], None, None
    if kind == "metadata":
        fields = [(k, v) for k, v in (x.split(": ", 1) for x in block.decode().split("\r\n") if x)]
    elif kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if h["warc-payload-digest"] != f"sha1:{digest}":
            raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
    return (file, h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"),
            h.get("warc-target-uri"), (h.get("warc-payload-digest") or "").removeprefix("sha1:")
            or None, size, dict(fields) if fields is not None else None,
            block if with_blocks else None)


def read_records(manifest: DataFrame, with_blocks: bool = True) -> DataFrame:
    """One row per record of the manifest's archives; responses are held against their
    digests. ``with_blocks`` false leaves the blocks out of the rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split(" ")[0] for x in RECORD_SCHEMA.split(", ")]
        for b in batches:
            for path in b["path"]:
                with open_file(path) as f:
                    data = f.read()
                rows, size = [], 0
                for h, block in parse_archive(data):
                    rows.append(_row(path, h, block, with_blocks))
                    size += len(block) if with_blocks else 200
                    if size > 4 << 20:
                        yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
                        rows, size = [], 0
                yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInPandas(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: transaction, main (response or revisit), and all its
    requests and metadata records as arrays in the order of their ids. A record belongs to
    the record it is concurrent to; a chain of two (metadata of a request, or a response
    that names its request) is followed. Of several main records of a capture the one with
    the smallest id is main."""
    links = records.where("concurrent_to IS NOT NULL").select(
        F.col("record_id").alias("_of"), F.col("concurrent_to").alias("_next"))
    keyed = (records.join(links, F.col("concurrent_to") == F.col("_of"), "left")
             .withColumn("transaction", F.coalesce("_next", "concurrent_to", "record_id")))
    columns = [c for c in records.columns if c != "concurrent_to"]

    def all_of(kind):
        held = F.collect_list(F.when(F.col("record_type") == kind, F.struct(*columns)))
        return F.array_sort(held, lambda x, y: F.when(x["record_id"] < y["record_id"], -1)
                            .when(x["record_id"] > y["record_id"], 1).otherwise(0))
    is_main = F.col("record_type").isin("response", "revisit")
    return keyed.groupBy("transaction").agg(
        F.min_by(F.when(is_main, F.struct(*columns)), F.when(is_main, F.col("record_id"))).alias("main"),
        all_of("request").alias("requests"), all_of("metadata").alias("metadata"))


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(read_table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    # written first: the join is then planned by the records' size, not the manifest's
    records = written(read_records(manifest, with_blocks=False), "warc-records")
    fields = F.try_element_at("metadata", F.lit(1))["fields"]      # this writer's only one
    captures = written(assemble(records).select(
        fields["page-id"].cast("bigint").alias("page_id"),
        F.coalesce(F.col("main.payload_bytes"), fields["payload-bytes"].cast("bigint"))
        .alias("payload_bytes"),
        F.col("main.payload_digest").alias("payload_digest"),
        F.col("main.record_type").alias("record_type"),
        F.col("main.record_id").alias("record_id"),
        F.col("main.refers_to").alias("refers_to_record"),
        F.col("main.target_uri").alias("target_uri")), "captures")
    revisits = captures.where("record_type = 'revisit'")
    referred = captures.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
    return (captures.where("record_type = 'response'")
            .withColumn("refers_to", F.lit(None).cast("bigint")).select(*out)
            .unionByName(revisits.join(referred, "refers_to_record", "left").select(*out)))
