"""Deduplicated WARC archives: revisit resolution, writing and reading back.

The headers of all records (page id, address, payload digest and size) are shuffled by
digest; of the records with one digest the one with the largest page id becomes the
response and the others revisits that refer to it. Equal headers are combined with a
count before the shuffle, payloads take no part in it. Only then the one payload per
response is joined to its header, on the page id, and archives are written.

Every record is its own gzip member. Tasks write to file names of their own under the
shared folder, and the list of files is stored by Spark after the tasks succeeded: files
of lost or repeated attempts are not in the list, so readers never see them. Paths go
through ``pyarrow.fs``, so the folder may be local, HDFS, S3 or GCS.

Defined results: a NULL payload is empty, a NULL address gives no target header.
Payloads shorter than ``least_bytes`` are never revisits. Of rows equal in page id,
address and payload one is the response and the others revisit it. NULL page ids are
smaller than all others and read back as NULL. An empty table gives an archive list and
records without rows. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import scratch_folder, stored

# The record format and the profile of revisits.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # of conv() to base 32


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a text or binary column in upper-case base32."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.upper(F.conv(F.substring(digest, start, chars), 16, 32)), chars * 4 // 5, "0")
        for start, chars in ((1, 15), (16, 15), (31, 10))
    ]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def page_headers(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Headers with record_type, refers_to and copy (0 for the first of equal rows).

    ``headers`` has page_id, url, payload_bytes and payload_digest.
    """
    keys = ["page_id", "url", "payload_bytes", "payload_digest"]
    equal = headers.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    originals = (
        equal.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "url")).alias("first"))
    )
    joined = equal.join(originals, ["payload_digest", "payload_bytes"], "left")
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).withColumn(
        "copy", F.col("copy") - 1
    )
    is_first = (
        F.col("first.page_id").eqNullSafe(F.col("page_id"))
        & F.col("first.url").eqNullSafe(F.col("url"))
        & (F.col("copy") == 0)
    )
    response = F.col("first").isNull() | is_first
    return copies.select(
        *keys,
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("first.page_id")).alias("refers_to"),
        F.when(~response, F.col("first.url")).alias("refers_to_url"),
        "copy",
    )


def _row_key(page: Column, url: Column, digest: Column) -> list[Column]:
    """Join keys that are never NULL and differ wherever the three columns do."""
    return [
        F.coalesce(page.cast("string"), F.lit("none")).alias("page_key"),
        F.coalesce(F.concat(F.lit(":"), url), F.lit("")).alias("url_key"),
        digest.alias("digest_key"),
    ]


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    folder: str | None = None,
    date: dt.datetime | None = None,
    file_bytes: int = 256 << 20,
) -> DataFrame:
    """Write ``pages`` as WARC files; returns the stored list of files (path, records).

    ``folder`` defaults to a new one in the shared folder. A file is closed after
    ``file_bytes`` compressed bytes.
    """
    spark = pages.sparkSession
    base = folder or f"{scratch_folder(spark)}/warc-{uuid.uuid4().hex}"
    stamp = (date or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    headers = page_headers(pages, id_col, url_col, payload_col)
    records = stored(resolve_revisits(headers, least_bytes))

    # One payload per different row, then one row per response: equal rows are combined
    # before the shuffle, and the join of the two has unique keys on both sides.
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    page = F.col(id_col).cast("long")
    payloads = (
        pages.select(
            *_row_key(page, F.col(url_col), base32_sha1(payload)), payload.alias("payload")
        )
        .groupBy("page_key", "url_key", "digest_key")
        .agg(F.first("payload").alias("payload"))
    )
    fields = ["page_id", "url", "payload_bytes", "payload_digest", "refers_to", "refers_to_url"]
    key = _row_key(F.col("page_id"), F.col("url"), F.col("payload_digest"))
    responses = (
        records.filter("record_type = 'response'")
        .groupBy(*fields)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("*", *key)
        .join(payloads, ["page_key", "url_key", "digest_key"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("copy"))
    )
    revisits = records.filter("record_type = 'revisit'").withColumn(
        "payload", F.lit(None).cast("string")
    )
    to_write = responses.select(*fields, "copy", "payload").unionByName(
        revisits.select(*fields, "copy", "payload")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = ArchiveFiles(base, stamp, file_bytes)
        for batch in batches:
            for row in batch.to_pylist():
                files.add(row)
        yield pa.RecordBatch.from_pydict(files.close(), schema=FILE_LIST)

    listed = to_write.mapInArrow(write, "path string, records long")
    return stored(listed.filter("records > 0"))


FILE_LIST = pa.schema([("path", pa.string()), ("records", pa.int64())])


class ArchiveFiles:
    """The archives of one task."""

    def __init__(self, base: str, stamp: str, file_bytes: int):
        self.system, self.base = pa.fs.FileSystem.from_uri(base)
        self.prefix = base[: len(base) - len(self.base)] if "://" in base else ""
        self.stamp, self.file_bytes = stamp, file_bytes
        self.out = None
        self.paths: list[str] = []
        self.records: list[int] = []

    def add(self, row: dict) -> None:
        if self.out is None:
            self.system.create_dir(self.base, recursive=True)
            path = f"{self.base}/part-{uuid.uuid4().hex}.warc.gz"
            self.out = self.system.open_output_stream(path, compression=None)
            self.paths.append(self.prefix + path)
            self.records.append(0)
            name = path.rsplit("/", 1)[-1]
            info = f"software: ebbtide\r\nformat: {VERSION}\r\n".encode()
            self._write(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                    ("WARC-Date", self.stamp),
                    ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields"),
                ],
                info,
            )
        self._write(*record(row, self.stamp))
        self.records[-1] += 1
        if self.out.tell() >= self.file_bytes:
            self._finish()

    def _write(self, fields: list[tuple[str, str]], block: bytes) -> None:
        fields = [*fields, ("Content-Length", str(len(block)))]
        head = "".join(f"{name}: {value}\r\n" for name, value in fields)
        data = f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"
        self.out.write(gzip.compress(data, 6, mtime=0))

    def _finish(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None

    def close(self) -> dict[str, list]:
        self._finish()
        return {"path": self.paths, "records": self.records}


def record_id(page_id: int | None, copy: int, url: str | None, digest: str) -> str:
    """Unique per record: pages may share an id but then differ in address or payload."""
    name = hashlib.sha1(f"{digest} {url is None} {url}".encode()).hexdigest()[:20]
    return f"<urn:ebbtide:page:{'none' if page_id is None else page_id}:{copy}:{name}>"


def address(url: str) -> str:
    """``url`` without characters that would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(row: dict, stamp: str) -> tuple[list[tuple[str, str]], bytes]:
    """Header fields and block of a response (with payload) or a revisit (without)."""
    revisit = row["payload"] is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], row["copy"], row["url"], row["payload_digest"])),
        ("WARC-Date", stamp),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", address(row["url"])))
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            (
                "WARC-Refers-To",
                record_id(row["refers_to"], 0, row["refers_to_url"], row["payload_digest"]),
            ),
            ("WARC-Refers-To-Date", stamp),
        ]
        if row["refers_to_url"] is not None:
            fields.append(("WARC-Refers-To-Target-URI", address(row["refers_to_url"])))
        return fields, http.encode()
    block = http.encode() + row["payload"].encode()
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    return [*fields, ("WARC-Block-Digest", f"sha1:{digest}")], block


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    inflate, out = zlib.decompressobj(31), []
    data = stream.read(chunk)
    while data:
        out.append(inflate.decompress(data))
        if inflate.eof:
            yield b"".join(out)
            data, inflate, out = inflate.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(chunk)
    if out:
        raise ValueError("the archive ends inside a record")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    length = int(fields["content-length"])
    if len(rest) != length + 4:
        raise ValueError("the record does not have the length it states")
    return fields, rest[:length]


def _page_of(name: str | None) -> int | None:
    page = name.split(":")[-3] if name else "none"
    return None if page == "none" else int(page)


def described(fields: dict[str, str], block: bytes) -> dict:
    """What a response or revisit record says, its payload checked against the digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?i)^content-length: *(\d+)", http, re.MULTILINE)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (
        len(payload) != stated
        or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
    ):
        raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    return {
        "page_id": _page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": stated,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _page_of(fields.get("warc-refers-to")),
        "warc_date": fields["warc-date"],
        "payload": None if revisit else payload,
    }


RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("warc_date", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_archives(files: DataFrame, with_payload: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """The response and revisit records of the listed files.

    ``files`` has a ``path`` column. Without payloads they are still checked.
    """
    fields = [f for f in RECORDS if with_payload or f.name != "payload"]
    schema = pa.schema(fields)
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = pa.fs.FileSystem.from_uri(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    rows, size = [], 0
                    for raw in members(stream):
                        head, block = parse(raw)
                        if head["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(described(head, block))
                        size += 500 + (len(block) if with_payload else 0)
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    # One file a task: the files were cut to a bounded size.
    wanted = max(1, files.count())
    spread = files.select("path").repartition(wanted)
    return spread.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in fields))
