"""Write web captures as WARC archives and read them back one record at a time.

Each record is a gzip member of its own. The reader never holds more than one record and one block of the file: it feeds
zlib block by block, takes the header up to the blank line, then exactly Content-Length bytes, and checks the digest.
Captures whose payload (of at least ``MIN_REVISIT`` bytes) is that of another are written as revisits without payload;
the reader resolves them against their response.

Archives lie in a folder that all executors share. A task writes under a fresh name and the list of archives is a
committed table, so a task that is run again leaves at most an unlisted file behind.

Edge cases, all defined: a NULL html is an empty payload; a NULL url gives a record without target; equal payloads with
equal page_id are both responses; a NULL page_id never becomes the response that others refer to, unless all are NULL; a
record that is cut off or whose digest differs comes back with digest_ok false; after a member that cannot be inflated the
reader goes on at the next one that can; an empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import as_text, settle_at
from stratamart.session import scratch_path

MIN_REVISIT = 100
BLOCK = 1 << 16
GZIP = b"\x1f\x8b\x08"
ROLL_BYTES = 256 << 20  # an archive is closed beyond this size
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ("page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary, "
               "digest_ok boolean, archive string, offset long")


def _open_store(path: str):
    """The file system of a URI or path, and the path in it; used by tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def record_bytes(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """One record as a gzip member. Line ends inside header values become blanks."""
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.splitlines())}" for k, v in [*headers, ("Content-Length", str(len(payload)))])]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + payload + b"\r\n\r\n") + pack.flush()


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and refers_to (the page that a revisit repeats, else NULL) of every page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    # only digests that occur again are joined back; AQE splits a digest that many pages share
    again = rows.filter(F.length("payload") >= MIN_REVISIT).select("page_id", "digest").groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("first_id").isNotNull()).drop("n")
    refers = F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))
    return rows.join(again, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages below folder; (archive, records, bytes) of what was written, as a settled table."""
    folder = folder.rstrip("/")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open_store(folder)
        out: BinaryIO | None = None
        name, n, size, listed = "", 0, 0, []
        now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        for batch in batches:
            for page, url, payload, digest, refers in zip(batch["page_id"], batch["url"], batch["payload"], batch["digest"], batch["refers_to"], strict=True):
                if out is None:
                    name, n, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                again = isinstance(refers, str)
                headers = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", f"<urn:page:{page if isinstance(page, str) else ''}>"), ("WARC-Date", now),
                           ("WARC-Payload-Digest", f"sha256:{digest}")]
                headers += [("WARC-Target-URI", url)] if isinstance(url, str) else []
                headers += [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", REVISIT_PROFILE)] if again else []
                size += out.write(record := record_bytes(headers, b"" if again else payload)) or len(record)
                n += 1
                if size >= ROLL_BYTES:
                    out.close()
                    listed.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            listed.append((name, n, size))
        yield pd.DataFrame(listed, columns=["archive", "records", "bytes"])

    # ids go through pandas as text, which holds 64 bits beside a NULL
    written = plan_records(pages).withColumns({c: as_text(c) for c in ("page_id", "refers_to")}).mapInPandas(write, "archive string, records long, bytes long")
    return settle_at(written, "archives")[0]


def _members(stream: BinaryIO) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, inflated bytes, complete) of each gzip member, read block by block; a broken one once, then the next that inflates.

    Of the member at hand the compressed bytes are kept too, so that the next header can be looked for inside them.
    """
    pending, at, eof, lost = b"", 0, False, False
    while True:
        unpack, start, parts, raw, broken = zlib.decompressobj(31), at, [], [], False
        while not unpack.eof:
            if not pending:
                pending = stream.read(BLOCK)
                eof = not pending
                if eof:
                    break
            raw.append(pending)
            try:
                parts.append(unpack.decompress(pending))
            except zlib.error:
                broken = True
                break
            at += len(pending) - len(unpack.unused_data)
            pending = unpack.unused_data
        if broken:
            if not lost:
                yield start, b"".join(parts), False
            lost, held = True, b"".join(raw)
            next_ = held.find(GZIP, 1)
            while next_ < 0:  # nothing that begins a member so far: on, keeping what may be the first bytes of a header
                more = stream.read(BLOCK)
                if not more:
                    return
                start, held = start + len(held) - len(GZIP) + 1, held[1 - len(GZIP):] + more
                next_ = held.find(GZIP)
            at, pending = start + next_, held[next_:]
            continue
        if eof:
            if parts and not lost:
                yield start, b"".join(parts), False
            return
        lost = False
        yield start, b"".join(parts), True


def _page(ref: str | None) -> str | None:
    text = (ref or "")[10:-1]
    return text if text.lstrip("-").isdigit() else None


def read_records(stream: BinaryIO) -> Iterator[dict]:
    """The records of one archive in order. A broken record is returned with digest_ok false."""
    for offset, data, complete in _members(stream):
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        length = int(fields.get("Content-Length", "-1"))
        payload = rest[:max(length, 0)]
        digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:")
        kind = fields.get("WARC-Type", "")
        framed = complete and lines[0].startswith("WARC/1.") and length >= 0 and len(payload) == length and rest[length:] == b"\r\n\r\n"
        yield {"page_id": _page(fields.get("WARC-Record-ID")), "url": fields.get("WARC-Target-URI"), "record_type": kind,
               "refers_to": _page(fields.get("WARC-Refers-To")), "payload_digest": digest, "payload_bytes": len(payload), "payload": payload,
               "digest_ok": framed and (kind == "revisit" or hashlib.sha256(payload).hexdigest() == digest), "offset": offset}


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives listed in ``archives``; a task reads whole archives, record by record."""
    folder = folder.rstrip("/")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open_store(folder)
        columns = [c.split()[0] for c in READ_SCHEMA.split(", ")]
        for batch in batches:
            for name in batch["archive"]:
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for record in read_records(stream):
                        held += len(record["payload"])
                        rows.append({**record, "archive": name, "payload": record["payload"] if payloads else None})
                        if held >= 16 << 20 or len(rows) >= 5_000:
                            yield _frame(rows, columns)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows, columns)

    # one task an archive, as the list itself is a small table
    spread = archives.select("archive").repartition("archive")
    return spread.mapInPandas(read, READ_SCHEMA).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    return out.astype({"payload_bytes": "int64", "offset": "int64"})


def resolve(records: DataFrame) -> DataFrame:
    """Give each revisit the length of the response it refers to; digest_ok is false where that one is missing or differs."""
    slim = records.drop("payload")
    responses = slim.filter("record_type = 'response'").groupBy(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest")).agg(
        F.max("payload_bytes").alias("r_bytes"), F.max("digest_ok").alias("r_ok"))
    revisit = F.col("record_type") == "revisit"
    joined = slim.join(responses, (F.col("refers_to") == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")), "left")
    return joined.select("page_id", "url", F.when(revisit, F.col("r_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), "payload_digest",
                         "record_type", "refers_to", (F.col("digest_ok") & (~revisit | F.coalesce("r_ok", F.lit(False)))).alias("digest_ok"), "archive", "offset")


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages, read the archives back, resolve revisits."""
    folder = folder or scratch_path(spark, "warc")
    return resolve(settle_at(read_archives(write_archives(pages, folder), folder, payloads=False), "records")[0])


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(encode(html), ''::BLOB) AS body FROM pages),
d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to, TRUE AS digest_ok
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes >= 100
"""
