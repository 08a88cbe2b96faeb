"""WARC archives: a writer, and a reader that salvages what it can."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import materialize

END = b"\r\n\r\n"
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
CUT = "gzip member does not end"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "file string, offset bigint, size bigint, gap_reason string, record_id string,"
    " record_type string, target_uri string, refers_to string, payload_digest string,"
    " payload_bytes bigint, payload binary"
)


def base32_sha1(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def record_bytes(
    kind: str, name: str, uri: str, payload: bytes, date: str, refers_to: str | None = None
) -> bytes:
    """One record. A revisit has the HTTP header of the page it stands for, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
    block = http.encode() + END + (b"" if kind == "revisit" else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to:
        lines[4:4] = [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + END + block + END


def _file_system(uri: str):
    """The file system of a folder, and the folder's path on it."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme == "s3a" else scheme) + colon + rest)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: one without is on the file system that Spark takes for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(at).toString()


def write_warc(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = 32 * 1024**2,
) -> None:
    """Writes a record for each row of ``pages`` (page_id, url, html) into archives below ``path``.

    Of equal payloads of ``least_bytes`` or more, the one with the smallest page_id is a response,
    the others revisit it without a payload; shorter payloads are all responses. Each record is a
    gzip member of its own, with payload and block digests; a file ends after ``file_bytes``.
    Tasks write files under names of their own; only those that Spark has committed get a final
    name, so a repeated or lost task leaves no record twice. ``path`` must be a folder that all
    machines share.

    A null html is an empty payload, a null url an empty URI, a null page_id comes after all
    others and is written as ``null``. Repeated rows are records of their own; of equal payloads
    with equal ids one is the response. An empty table writes no record. Other columns play no part.
    """
    path = qualified(pages.sparkSession, path)
    rows = pages.select(
        F.col("page_id").alias("_page"),
        F.coalesce("url", F.lit("")).alias("_url"),
        F.coalesce("html", F.lit("")).alias("_html"),
        F.monotonically_increasing_id().alias("_copy"),
    )
    rows = rows.withColumn("_sha256", F.sha2("_html", 256))
    # min over a struct combines before the shuffle; a null id sorts behind the others.
    place = F.struct(F.col("_page").isNull().alias("no_page"), "_page", "_copy")
    first = (
        rows.where(F.octet_length("_html") >= least_bytes)
        .groupBy("_sha256")
        .agg(F.min(place).alias("_first"))
        .withColumnRenamed("_sha256", "_equal")
    )
    joined = rows.join(first, F.col("_sha256") == F.col("_equal"), "left")
    revisit = F.coalesce(F.col("_first._copy") != F.col("_copy"), F.lit(False))

    def name(page: str, copy: str) -> Column:
        number = F.coalesce(F.col(page).cast("string"), F.lit("null"))
        return F.concat(F.lit("<urn:page:"), number, F.lit(":"), F.col(copy).cast("string"), F.lit(">"))

    records = joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        name("_page", "_copy").alias("name"),
        F.regexp_replace("_url", r"[\r\n]", "").alias("uri"),
        F.col("_html").alias("html"),
        F.when(revisit, name("_first._page", "_first._copy")).alias("refers_to"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _file_system(path)
        system.create_dir(f"{folder}/_written")
        task, names, sink, held = uuid.uuid4().hex, [], None, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if sink is None:
                    names.append(f"{task}-{len(names):05d}.warc.gz")
                    sink, held = system.open_output_stream(f"{folder}/_written/{names[-1]}", compression=None), 0
                payload = row.html.encode("utf-8", "replace")
                record = record_bytes(row.kind, row.name, row.uri, payload, date, row.refers_to)
                member = gzip.compress(record, 6, mtime=0)
                sink.write(member)
                held += len(member)
                if held >= file_bytes:
                    sink.close()
                    sink = None
        if sink is not None:
            sink.close()
        yield pd.DataFrame({"file": names}, dtype="object")

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _file_system(path)
        for batch in batches:
            for file in batch.file:
                # A repeated task finds the file in its place already.
                if system.get_file_info(f"{folder}/_written/{file}").is_file:
                    system.move(f"{folder}/_written/{file}", f"{folder}/{file}")
            yield batch

    system, folder = _file_system(path)
    system.create_dir(folder)
    committed = materialize(records.mapInPandas(write, "file string"), "archives")
    committed.mapInPandas(publish, "file string").write.format("noop").mode("overwrite").save()


class Damaged(ValueError):
    """What stands at a place of an archive is no valid record."""


def _digest_matches(stated: str | None, content: bytes) -> bool:
    if not stated or not stated.lower().startswith("sha1:"):
        return True  # nothing to hold it against
    return stated[5:].upper() == base32_sha1(content)


def parse_record(data: bytes, start: int) -> tuple[dict, int]:
    """The record at ``start`` and where it ends; raises Damaged if any check fails."""
    if data[start : start + len(VERSION)] != VERSION:
        raise Damaged("no version line")
    head_end = data.find(END, start)
    if head_end < 0:
        raise Damaged("header does not end")
    lines = data[start:head_end].decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    block_start = head_end + len(END)
    block_end = block_start + int(length)
    if data[block_end : block_end + len(END)] != END:
        raise Damaged("block does not end where its length says")
    block = data[block_start:block_end]
    if not _digest_matches(fields.get("warc-block-digest"), block):
        raise Damaged("block digest differs")
    kind = fields.get("warc-type")
    record = {
        "record_id": fields.get("warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload": block,
    }
    stated = fields.get("warc-payload-digest")
    if fields.get("content-type", "").startswith("application/http"):
        http, _, record["payload"] = block.partition(END)
        if kind == "revisit":
            sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            size = sizes[0].strip() if sizes else b""
            record |= {"payload": None, "payload_bytes": int(size) if size.isdigit() else None}
    if record["payload"] is not None:
        if not _digest_matches(stated, record["payload"]):
            raise Damaged("payload digest differs")
        record["payload_bytes"] = len(record["payload"])
        stated = "sha1:" + base32_sha1(record["payload"])
    record["payload_digest"] = stated.partition(":")[2].upper() if stated else None
    return record, block_end + len(END)


def _inflated(data: bytes, start: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``start`` holds as far as it inflates, where that ends, and any error."""
    inflate, parts, at, step = zlib.decompressobj(31), [], start, 65536
    try:
        while not inflate.eof and at < len(data):
            parts.append(inflate.decompress(data[at : at + step]))
            at += step
    except zlib.error as error:
        # The same up to the chunk with the error, whose good bytes come one by one.
        inflate = zlib.decompressobj(31)
        parts = [inflate.decompress(data[i : i + step]) for i in range(start, at, step)]
        try:
            while at < len(data):
                parts.append(inflate.decompress(data[at : at + 1]))
                at += 1
        except zlib.error:
            pass
        return b"".join(parts), at, f"gzip: {error}"
    end = min(at, len(data)) - len(inflate.unused_data)
    return b"".join(parts), end, "" if inflate.eof else CUT


def _inside(content: bytes, error: str) -> list[dict | str]:
    """The records in a member's content, and a reason for each gap in it.

    Where a member is cut, a record that ends with the last byte there is stays with the gap.
    """
    found, at, gap, reason = [], 0, None, ""
    while at < len(content):
        try:
            record, end = parse_record(content, at)
            if error == CUT and end == len(content):
                raise Damaged(error)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, str(damage)
            at = content.find(VERSION, at + 1)
            at = len(content) if at < 0 else at
            continue
        if gap is not None:
            found.append(f"inflated bytes {gap} to {at}: {reason}")
            gap = None
        found.append(record)
        at = end
    if gap is not None:
        found.append(f"inflated bytes {gap} to {at}: {reason}")
    return [*found, error] if error else found


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """What an archive holds: (offset, size, record), and (offset, size, reason) for lost bytes.

    Where the checks of a record fail, the search goes on byte by byte for the next gzip member or
    version line that starts a valid record. Bytes in between are one gap with its first reason.
    Of a damaged member the valid records in what inflates are kept; the gaps between them have
    the offset and size of the member, and their reason tells the inflated bytes.
    """
    at, gap, held, plain_from = 0, None, [], 0
    while at < len(data):
        try:
            if data[at : at + len(GZIP)] == GZIP:
                content, end, error = _inflated(data, at)
                found = _inside(content, error)
                if not error and not all(isinstance(x, dict) for x in found):
                    if not any(isinstance(x, dict) for x in found):
                        raise Damaged(found[0].partition(": ")[2])
                elif error:
                    if any(isinstance(x, dict) for x in found):
                        if gap is not None:
                            yield from ((gap, at - gap, x) for x in held)
                        gap, held = at, found
                        # What has been inflated is not read again as plain records.
                        plain_from = end
                    raise Damaged(error)
            else:
                record, end = parse_record(data, at)
                found = [record]
        except Damaged as damage:
            if gap is None:
                gap, held = at, [str(damage)]
            nexts = (data.find(VERSION, max(at + 1, plain_from)), data.find(GZIP, at + 1))
            at = min((x for x in nexts if x >= 0), default=len(data))
            continue
        if gap is not None:
            yield from ((gap, at - gap, x) for x in held)
            gap = None
        for x in found:
            yield at, end - at, x
        at = end
    if gap is not None:
        yield from ((gap, len(data) - gap, x) for x in held)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Reads archives, plain or with gzip members; one row per record and per quarantined gap.

    Rows with a ``gap_reason`` are gaps: ``offset`` and ``size`` say which bytes of the file were
    not readable, or of which member the inflated bytes in the reason were not. All other rows are
    records; those of one gzip member share offset and size. A
    revisit has no payload, its size is that of its HTTP header. A file is read as a whole by one
    task, so archives should be of moderate size, as ``write_warc`` makes them.

    Empty files give no rows; fields that a record lacks are null; equal records are rows each.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORDS.split(",")]
        for batch in batches:
            for file, content in zip(batch.path, batch.content, strict=True):
                rows, held = [], 0
                for offset, size, found in salvage(bytes(content)):
                    row = dict.fromkeys(names) | {"file": file, "offset": offset, "size": size}
                    rows.append(row | (found if isinstance(found, dict) else {"gap_reason": found}))
                    held += size
                    if held > 1 << 24:
                        yield _frame(rows, names)
                        rows, held = [], 0
                yield _frame(rows, names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(read, RECORDS)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})


def page_number(record_id: str) -> Column:
    """The page_id in a record id that ``write_warc`` has made; null for a page without one."""
    return F.expr(f"try_cast(split({record_id}, ':')[2] AS BIGINT)")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of archives made by ``write_warc``."""
    records = read_warc(spark, path).where("gap_reason IS NULL")
    return records.select(
        page_number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number("refers_to").alias("refers_to"),
    )


#: The round trip as SQL.
WARC_SQL = r"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS digest,
         min(page_id) OVER (PARTITION BY html) AS first_page
  FROM rows),
coded AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      (('0x' || substr(digest, 1 + 10 * (i // 8)::INTEGER, 10))::BIGINT
        >> (35 - 5 * (i % 8))::BIGINT) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest
  FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM coded
"""
