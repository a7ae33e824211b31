"""WARC archives with an index written first, and reads by coalesced byte ranges.

Every task writes the records of its rows as gzip members of one archive file
with a name of its own, and hands out an index row per record: file, offset,
length, URL and digest. The index is a table, so it only ever names files of
tasks that ended well; a file that a lost task left is named by nothing. Readers
sort the wanted index rows by file and offset, join neighbours into ranges and
read each range at once.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelab.llm.files import byte_ranges, spread_by_stretch
from ratelab.llm.skew import join_unique
from ratelab.llm.tasks import map_batches

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed, so that equal input gives equal archives.
DATE = "1970-01-01T00:00:00Z"
INDEX_SCHEMA = "page_id bigint, url string, digest string, file string, offset bigint, length bigint"


@dataclass(frozen=True)
class WarcRule:
    """Payloads of at least ``revisit_bytes`` are stored once. A range spans gaps of up to
    ``gap_bytes`` and ends at ``range_bytes``, or at the end of a longer record."""

    revisit_bytes: int = 0
    gap_bytes: int = 1 << 14
    range_bytes: int = 1 << 22
    level: int = 1


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Percent-encodes what would end a header line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _header_text(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to, refers_to_url) -> bytes:
    """One record, not compressed; without a payload it is a revisit."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http + (payload or b"")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}")
    fields = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{name}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = _header_value(url)
    if page_id is not None:
        fields["WARC-X-Page-ID"] = str(page_id)
    if payload is None:
        fields["WARC-Profile"] = PROFILE
        fields["WARC-X-Refers-To-Page-ID"] = str(refers_to)
        if refers_to_url is not None:
            fields["WARC-Refers-To-Target-URI"] = _header_value(refers_to_url)
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Fields, the payload's full size as the HTTP header has it, and the payload that is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    return fields, size, payload


def roles(pages: DataFrame, rule: WarcRule) -> DataFrame:
    """``pages`` (``page_id, url, html``) with ``refers_to`` and ``refers_to_url``, null for responses.

    Payloads are equal when their SHA-256 and length are. Only hashes are
    grouped; pages are shuffled once, to meet the first page of their group.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.withColumn("key", F.sha2(body, 256)).withColumn("size", F.octet_length(body))
    first = hashed.groupBy("key").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("first"))
    joined = join_unique(hashed, first, "key")
    again = (
        (F.col("size") >= rule.revisit_bytes)
        & F.col("first.page_id").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    )
    return joined.select(
        "page_id",
        "url",
        "html",
        F.when(again, F.col("first.page_id")).alias("refers_to"),
        F.when(again, F.col("first.url")).alias("refers_to_url"),
    )


def write_warc(pages: DataFrame, folder: str, rule: WarcRule = WarcRule()) -> DataFrame:
    """Writes archives and ``index.parquet`` below ``folder`` and returns the index.

    ``pages`` has ``page_id, url, html``. A null payload counts as empty. Of
    equal payloads the one with the smallest page id is a response, the others
    revisit it; rows that repeat that id are responses too, and a group without
    any id has responses only. Null urls and ids are left out of the headers and
    read back as null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        file, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            if out is None:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(f"{base}/{file}", compression=None)
            rows = []
            for page_id, url, html, refers_to, refers_to_url in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = payload_digest(payload)
                stored = payload if refers_to is None else None
                data = record(page_id, url, stored, digest, len(payload), refers_to, refers_to_url)
                packer = zlib.compressobj(rule.level, zlib.DEFLATED, 31)
                data = packer.compress(data) + packer.flush()
                out.write(data)
                rows.append((page_id, url, digest, file, offset, len(data)))
                offset += len(data)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                    names=["page_id", "url", "digest", "file", "offset", "length"],
                )
        if out is not None:
            out.close()

    ready = roles(pages.select("page_id", "url", "html"), rule)
    index = f"{folder}/index.parquet"
    map_batches(ready, run, INDEX_SCHEMA).write.parquet(index)
    return pages.sparkSession.read.schema(INDEX_SCHEMA).parquet(index)


def read_warc(index: DataFrame, folder: str, rule: WarcRule = WarcRule()) -> DataFrame:
    """The records that rows of an index name: ``page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload``.

    Payload size and digest are of the full payload: counted and computed from
    it for a response, as the headers say for a revisit, whose own payload is
    null. Index rows are spread by file and stretch of a file, so a large
    archive is read by many tasks.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    schema = (
        "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint,"
        " payload_digest string, payload binary"
    )

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            at = 0
            while at < len(files):
                end = at + 1
                while end < len(files) and files[end] == files[at]:
                    end += 1
                with system.open_input_file(f"{base}/{files[at]}") as source:
                    for lo, hi in byte_ranges(offsets[at:end], lengths[at:end], rule.gap_bytes, rule.range_bytes):
                        lo, hi = at + lo, at + hi
                        data = source.read_at(offsets[hi - 1] + lengths[hi - 1] - offsets[lo], offsets[lo])
                        rows = [
                            _read_row(data[offsets[i] - offsets[lo] : offsets[i] - offsets[lo] + lengths[i]])
                            for i in range(lo, hi)
                        ]
                        yield pa.RecordBatch.from_pylist(
                            [dict(zip(names, row)) for row in rows],
                            schema=pa.schema(
                                [
                                    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                                    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                                    ("payload_digest", pa.string()), ("payload", pa.binary()),
                                ]
                            ),
                        )
                at = end

    spread = spread_by_stretch(index.select("file", "offset", "length"), 4 * rule.range_bytes)
    return map_batches(spread, run, schema)


def _read_row(packed: bytes):
    fields, size, payload = parse_record(zlib.decompress(packed, 31))
    kind = fields["WARC-Type"]
    page_id, url, refers_to = (
        fields.get(k) for k in ("WARC-X-Page-ID", "WARC-Target-URI", "WARC-X-Refers-To-Page-ID")
    )
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        found = payload_digest(payload)
        if found != digest or len(payload) != size:
            raise ValueError(f"record of page {page_id} is damaged")
    return (
        None if page_id is None else int(page_id),
        None if url is None else _header_text(url),
        kind,
        None if refers_to is None else int(refers_to),
        size,
        digest,
        payload if kind == "response" else None,
    )
