"""WARC archives with an index, and reads of selected records by byte ranges.

Writing: each task writes archives of its own (one gzip member per record) and returns an index row per
record: file, offset, length, URL, digest. The index is an ordinary table; a record counts once its
index row is committed, so what a lost or repeated attempt has written is never read. Reading starts at
the index: selected rows are dealt by file and stretch of file, sorted, and neighbouring ranges become
one read.

Records of equal payload: that with the largest id is a ``response``, the others are ``revisit`` records
that refer to it and hold the HTTP head only, whose Content-Length is that of the full payload.

Edge cases: NULL html is an empty payload; rows of the largest id that repeat are all responses; a NULL
id is smaller than any other and stays a response if its group has no other; NULL URLs have no target
field; an empty table gives an empty index. Payloads are written whole.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.files import opened, qualified
from tickloom.llm.skew import lookup
from tickloom.session import run_folder, store

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31
INDEX = "file string, offset long, length long, page_id long, url string, digest string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

ARCHIVE_BYTES = 256 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
STRETCH_BYTES = 32 << 20
TASK_BYTES = 128 << 20
LEVEL = 3
EPOCH = "1970-01-01T00:00:00Z"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d*)>", name)
    return int(found[1]) if found and found[1] else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str]:
    """One WARC record, not compressed, and its payload digest."""
    digest = _digest(payload)
    body = b"" if refers_to is not None else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(body)}",
    ]
    if url is not None:
        target = url.replace("\r", "%0D").replace("\n", "%0A")
        head.insert(4, f"WARC-Target-URI: {target}")
    if refers_to is not None:
        head[-2:-2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """The fields of one record; ``payload`` is None for a revisit. A digest that does not fit raises."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(body) != size or _digest(body) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": body if kind == "response" else None,
    }


def _none(value):
    return None if pd.isna(value) else value


def _writer(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = opened(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(
                batch["page_id"], batch["url"], batch["html"], batch["refers_to"], strict=True
            ):
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                page, refers = _none(page_id), _none(refers_to)
                raw, digest = record(
                    None if page is None else int(page),
                    _none(url),
                    (_none(html) or "").encode("utf-8", "replace"),
                    None if refers is None else int(refers),
                    date,
                )
                member = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                packed = member.compress(raw) + member.flush()
                out.write(packed)
                rows.append((name, at, len(packed), page, _none(url), digest))
                at += len(packed)
            frame = pd.DataFrame(rows, columns=["file", "offset", "length", "page_id", "url", "digest"], dtype=object)
            yield frame.assign(page_id=pd.array(frame["page_id"], dtype="Int64"))
        if out is not None:
            out.close()

    return run


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: the id of the response that a record revisits, else NULL."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.sha1(F.coalesce("html", F.lit(""))).alias("sha"),
    )
    equal = (
        rows.filter(F.octet_length("html") >= min_bytes)
        .groupBy("sha")
        .agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
        .filter("n > 1 and top is not null")
    )
    # The groups steer two joins; the narrow table saves a second pass over the pages.
    met = lookup(rows, store(equal, "warc-groups"), "sha", "n", ["page_id", "url"])
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("top")), F.col("top"))
    return met.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, date: str = EPOCH, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write all pages to ``folder/archives`` and their index to ``folder/index``; returns the index."""
    spark = pages.sparkSession
    archives = qualified(spark, f"{folder}/archives")
    files, root = opened(archives)
    files.create_dir(root, recursive=True)
    # Ids travel as text: a column of numbers and NULLs would become one of doubles.
    rows = with_revisits(pages, min_bytes).withColumns(
        {name: F.col(name).cast("string") for name in ("page_id", "refers_to")}
    )
    index = rows.mapInPandas(_writer(archives, date, archive_bytes), INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _reader(folder: str, payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = opened(folder)
        source, name = None, None
        for batch in batches:
            spans = list(zip(batch["file"], batch["offset"], batch["length"], strict=True))
            at = 0
            while at < len(spans):
                file, start, length = spans[at]
                end, upto = start + length, at + 1
                while (
                    upto < len(spans)
                    and spans[upto][0] == file
                    and end <= spans[upto][1] <= end + GAP_BYTES
                    and spans[upto][1] + spans[upto][2] - start <= READ_BYTES
                ):
                    end = spans[upto][1] + spans[upto][2]
                    upto += 1
                if file != name:
                    if source is not None:
                        source.close()
                    source, name = files.open_input_file(f"{root}/{file}"), file
                source.seek(start)
                block = source.read(end - start)
                rows = [parse(zlib.decompress(block[o - start : o - start + n], GZIP)) for _, o, n in spans[at:upto]]
                frame = pd.DataFrame(rows, dtype=object)
                frame = frame.assign(**{n: pd.array(frame[n], dtype="Int64") for n in ("page_id", "refers_to")})
                yield frame if payload else frame.drop(columns="payload")
                at = upto
        if source is not None:
            source.close()

    return run


def read_records(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that the given index rows name, read by byte ranges from ``folder/archives``."""
    archives = qualified(index.sparkSession, f"{folder}/archives")
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    spans = index.select("file", "offset", "length")
    # Index rows are small, what they name is not: a number of partitions that is given is not merged.
    size = spans.agg(F.sum("length")).first()[0] or 0
    width = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TASK_BYTES))
    sorted_rows = spans.repartition(width, "file", stretch).sortWithinPartitions("file", "offset")
    schema = RECORD + (", payload binary" if payload else "")
    return sorted_rows.mapInPandas(_reader(archives, payload), schema)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to a fresh shared folder and describe the records that are read back."""
    folder = run_folder(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, payload=False)
