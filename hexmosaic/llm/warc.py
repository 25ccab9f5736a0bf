"""WARC archives: one gzip member per record, and a sequential reader.

Writing: every partition writes one archive into the shared folder, a response record for the first
page with a payload and a revisit record for every other. Reading: members are inflated one after
the other in pieces, records are framed by their content length, and the payload is checked against
its digest, so memory is bounded by one record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import filesystem, new_folder, table

VERSION = b"WARC/1.1"
PIECE = 1 << 16
#: Level of gzip; 1 to 9.
LEVEL = 4


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit has an empty block; payload length and digest stay in its headers."""
    block = payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}')}>"),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("WARC-Payload-Length", str(len(payload))),
    ]
    if kind == "revisit":
        fields += [("WARC-Refers-To-Page-ID", str(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


class Inflated(io.RawIOBase):
    """Bytes of all gzip members of a stream, inflated piece by piece."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.rest, self.unzip = raw, b"", None

    def readable(self) -> bool:
        return True

    def readinto(self, to) -> int:
        while True:
            if not self.rest:
                self.rest = self.raw.read(PIECE)
                if not self.rest:
                    if self.unzip is not None:
                        raise ValueError("archive ends inside a record")
                    return 0
            self.unzip = self.unzip or zlib.decompressobj(31)
            out = self.unzip.decompress(self.rest, len(to))
            self.rest = self.unzip.unconsumed_tail
            if self.unzip.eof:
                self.rest, self.unzip = self.unzip.unused_data, None
            if out:
                to[: len(out)] = out
                return len(out)


def read_records(raw: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record; ends the job on a broken frame or a wrong digest."""
    stream = io.BufferedReader(Inflated(raw), PIECE)
    while line := stream.readline():
        if line.strip() != VERSION:
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode().partition(":")
            head[k] = v.strip()
        length = int(head["Content-Length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"page {head.get('WARC-Page-ID')}: block is not {length} bytes")
        if head["WARC-Type"] == "response" and "sha1:" + payload_digest(block) != head["WARC-Payload-Digest"]:
            raise ValueError(f"page {head.get('WARC-Page-ID')}: payload differs from its digest")
        yield head, block


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest and ``first``: the smallest page_id with an equal payload.

    ``first`` is null for payloads below ``min_bytes``. Only digests and ids are grouped.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    firsts = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # most payloads are alone; the few others are all that has to meet the pages
    repeated = firsts.where("n > 1").select("digest", "first")
    return rows.join(repeated, "digest", "left")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """One gzip archive per partition below ``folder``; lazily returns its path and record count.

    A repeated attempt writes a file of its own, so only paths that are returned count.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        name, n = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
        with fs.open_output_stream(name, compression=None) as out:
            for b in batches:
                firsts = b["first"].astype("object").where(b["first"].notna(), None)
                ids = b["page_id"].astype("object").where(b["page_id"].notna(), None)
                for page_id, url, html, first in zip(ids, b["url"], b["html"], firsts):
                    payload = html.encode()
                    page_id = None if page_id is None else int(page_id)
                    again = first is not None and (page_id is None or int(first) != page_id)
                    kind = "revisit" if again else "response"
                    out.write(gzip_member(record(kind, page_id, url, payload, payload_digest(payload), int(first) if again else None)))
                    n += 1
        yield pd.DataFrame({"path": [name], "n": [n]})

    return mark_revisits(pages, min_bytes).select("page_id", "url", "html", "first").mapInPandas(write, "path string, n long")


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def read_archives(paths: DataFrame, folder: str, with_html: bool = True) -> DataFrame:
    """The records of archives; ``html`` is null for revisits (or always, if not asked for)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = filesystem(folder)
        number = lambda x: int(x) if x else None
        for b in batches:
            for path in b["path"]:
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as raw:
                    for head, block in read_records(raw):
                        response = head["WARC-Type"] == "response"
                        rows.append((number(head["WARC-Page-ID"]), int(head["WARC-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], number(head.get("WARC-Refers-To-Page-ID")), block.decode() if with_html and response else None))
                        size += len(block) * with_html + 200
                        if size > 8 << 20:
                            yield frame(rows)
                            rows, size = [], 0
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])
        return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    return paths.mapInPandas(read, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0, with_html: bool = True) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into the shared folder and read them back.

    A null html is an empty payload, a null url an empty one; other columns are ignored. Of equal
    payloads of at least ``min_bytes`` the smallest page_id is the response (all its rows, if it
    repeats), others revisit it; a null page_id revisits too unless it is alone or all are null.
    An empty table gives no record. The list of archives is a written table, so archives are
    written once and a lost executor costs no more than its own.
    """
    folder = new_folder(pages.sparkSession, "warc")
    from hexmosaic.llm.common import stored

    paths = stored(write_archives(pages, folder, min_bytes), "warc-paths").where("n > 0").select("path")
    n = max(1, paths.count())
    return read_archives(paths.repartition(n), folder, with_html)


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits,
        min(page_id) OVER (PARTITION BY sha256(html)) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS INT) * (16 >> j))) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h
"""


def op7_warc(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages"), with_html=False).drop("html")
