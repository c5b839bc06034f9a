"""WARC archives: written one gzip member per record, read back sequentially.

Writer: pages go to archives of about ``ARCHIVE_BYTES`` compressed bytes in a folder
all executors share. Of records with equal payloads of at least ``REVISIT_BYTES``
bytes the one with the smallest page_id is a response and the others revisit it: a
revisit record holds the HTTP head (whose Content-Length is the payload's) and no
payload. A task writes under a name of its own attempt and renames when the archive
is complete; the manifest, written as Parquet, lists the archives that count, so a
task that is run again leaves at most a file that nothing reads.

Reader: a task streams an archive through an incremental zlib decompressor, one
gzip member after another, cuts the record at its Content-Length, and compares the
digests of block and payload. It holds one record and one chunk at a time. Damage
(a broken member, a short block, a wrong digest) raises ``WarcError`` or, with
``strict=False``, gives a row with ``error`` set and goes on with the next whole member. A revisit's announced digest is
compared with the response that it refers to (``dangling_revisits``).

Equal payloads are found by a partially aggregated ``groupBy`` of SHA-256 digests;
the pages join the digests that occur twice or more, and Spark splits hot ones.

Edge cases: very long pages are written and read whole, one record at a time; a null html is an empty payload; a null url is an empty target; pages
with the smallest page_id of their group are responses even where ids repeat; null
ids come last and are written as an empty id; an empty table gives no archive and
no rows. Extra columns of the pages are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, stored, table

ARCHIVE_BYTES, REVISIT_BYTES, CHUNK = 64 << 20, 100, 1 << 16
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that is not what its framing or digests say."""


def _digest(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One gzip member with one record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url or '', safe=_URL)}", "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: {_digest(block)}", f"WARC-Payload-Digest: {_digest(payload)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


_URL = "".join(chr(c) for c in range(33, 127))


MAGIC = b"\x1f\x8b\x08"


def members(stream, strict: bool = True) -> Iterator[bytes | WarcError]:
    """The decompressed members of a gzip stream, read by chunks; holds one member.

    A broken one raises WarcError or, if not strict, is given as one, and reading goes on at the next place
    where a whole member begins (what looks like a beginning inside damage is passed over).
    """
    held, damaged = bytearray(), False
    while True:
        z, parts, at, error = zlib.decompressobj(31), [], 0, None
        while not z.eof and error is None:
            if at == len(held):
                chunk = stream.read(CHUNK)
                if not chunk:
                    break
                held += chunk
            try:
                parts.append(z.decompress(bytes(held[at:])))
                at = len(held)
            except zlib.error as e:
                error = f"broken gzip member: {e}"
        if z.eof:
            yield b"".join(parts)
            del held[: len(held) - len(z.unused_data)]
            damaged = False
            continue
        if not held:
            return
        error = WarcError(error or "the last gzip member is cut short")
        if strict:
            raise error
        if not damaged:
            yield error
        damaged, start = True, 1
        while (found := held.find(MAGIC, start)) < 0:
            chunk = stream.read(CHUNK)
            if not chunk:
                return
            del held[:-2]
            held += chunk
            start = 0
        del held[:found]


def parse(member: bytes) -> dict:
    """The fields of a record, with its payload; raises WarcError on damage."""
    head, found, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC head")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError) as e:
        raise WarcError("no content length") from e
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"the block has {len(rest) - 4} bytes, not {size}")
    if _digest(block) != fields.get("warc-block-digest"):
        raise WarcError("the block's digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    revisit = fields.get("warc-type") == "revisit"
    if length is None or not revisit and (len(payload) != length or _digest(payload) != fields.get("warc-payload-digest")):
        raise WarcError("the payload is not the one announced")
    page = lambda name: int(x) if (x := fields.get(name, "")[len("<urn:page:") : -1]) and x != "None" else None
    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri", ""), "record_type": fields["warc-type"], "refers_to": page("warc-refers-to"), "payload_bytes": length, "payload_digest": digest, "payload": None if revisit else payload}


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive the pages under folder. Returns the manifest: archive, records, bytes."""
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    large = pages.where(size >= REVISIT_BYTES).select(digest.alias("digest"), "page_id")
    first = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_id")
    first = stored(first, "payload-groups")
    rows = pages.select("page_id", "url", "html", digest.alias("digest")).join(first, "digest", "left").select("page_id", "url", "html", "first_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)
        out, name, n, size, done = None, "", 0, 0, []

        def close() -> None:
            out.close()
            where.move(f"{path}/_{name}", f"{path}/{name}")
            done.append((f"{folder}/{name}", n, size))

        for b in batches:
            for page_id, url, html, first_id in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = where.open_output_stream(f"{path}/_{name}", compression=None)
                data = record(page_id, url, (html or "").encode(), first_id, first_id is not None and page_id != first_id)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*done, strict=True)) or ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["archive", "records", "bytes"])

    return stored(rows.mapInArrow(write, "archive string, records long, bytes long"), "manifest")


RECORD = "archive string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def read_archives(manifest: DataFrame, strict: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """The records of the archives that the manifest lists, one archive after another."""
    fields = [(x.split()[0], _TYPES[x.split()[1]]) for x in RECORD.split(", ")]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in fields], names=[k for k, _ in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column("archive").to_pylist():
                where, path = fs.FileSystem.from_uri(archive)
                rows, held = [], 0
                with where.open_input_stream(path, compression=None) as stream:
                    it = members(stream, strict)
                    while True:
                        try:
                            if (member := next(it, None)) is None:
                                break
                            if isinstance(member, WarcError):
                                raise member
                            rows.append(parse(member) | {"archive": archive})
                        except WarcError as e:
                            if strict:
                                raise WarcError(f"{archive}: {e}") from e
                            rows.append({"archive": archive, "error": str(e)})
                        held += len(rows[-1].get("payload") or b"") + 200
                        if held >= batch_bytes:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    n = max(1, manifest.count())
    return manifest.select("archive").repartition(n).mapInArrow(read, RECORD)


def dangling_revisits(records: DataFrame) -> DataFrame:
    """Revisits whose response is not among the records or has another payload digest."""
    held = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest").distinct()
    return records.where("record_type = 'revisit'").join(held, ["refers_to", "payload_digest"], "left_anti")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest = write_archives(pages, new_path(spark, "warc"))
    records = stored(read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")
    if not (bad := dangling_revisits(records)).isEmpty():
        raise WarcError(f"a revisit without its response: page {bad.first().page_id}")
    return records


SQL_OP2 = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha256(html) as payload_digest from p),
g as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from g
"""
