"""WARC archives: writing, and reading by boundary chains.

Writing. Payload digests decide which record of equal payloads is the response (the largest page_id)
and which ones revisit it. Pages are packed and joined with that decision by digest; within a piece only
one page per payload carries its text, so a payload shared by a third of all pages does not travel with
each of them. Records go through Spark's text writer, which ends every record with two line ends.

Reading. Files come from Spark's binary reader. A task looks for the magic in ranges of a file and emits,
for every candidate record (magic at the start of a file or behind two line ends), the offset of its
successor, computed from its own header of any length, and the first offset of its chain outside the range. Pointer jumping over these edges, from the start of each file,
finds the offsets where true chains enter a range; following them inside the range leaves the records
that are reachable. Magic inside a payload is never reached.

Defined cases: a null html is an empty payload; a null url gives a record without target; line ends in a
url are written as ``%0D`` and ``%0A``; a null page_id is written as an empty id, reads back as null and is
smaller than any other; equal rows of the response's page_id are all responses; other columns are not
read. A file must fit Spark's binary reader (2 GB). Own archives do: records are written in classes of
their size, and the files of a class hold as many records as ``FILE_BYTES`` of its largest.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.llm.batches import encoded, map_batches, pieces
from scopewise.session import materialize, scratch_path

MAGIC = b"WARC/1.1\r\n"
#: Bytes of a file that are followed within a task before chains are joined.
RANGE_BYTES = 2 << 20
#: Bytes of a record in the first size class, and how many times as large the next class may be.
CLASS_BYTES, CLASS_STEP = 64 << 10, 16
#: Bytes of an archive file, if all its records were the largest of their class.
FILE_BYTES = 320 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _pack(batches: Iterable[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Digest and size of every page; of equal payloads in a piece the page of largest id has the packed one.

    Payloads below ``min_bytes`` stay with every page. The shuffle of packed payloads is a third of their size.
    """
    packer = zstandard.ZstdCompressor(3)
    for piece in pieces(batches, "html", 16 << 20):
        ids, payloads = piece.column("page_id").to_pylist(), encoded(piece, "html")
        digests = [base32_sha1(payload) for payload in payloads]
        top: dict[str, tuple] = {}
        for row, (digest, page_id) in enumerate(zip(digests, ids, strict=True)):
            top[digest] = max(top.get(digest, (False, 0, row)), (page_id is not None, page_id or 0, row))
        carries = [
            len(payload) < min_bytes or top[digest][:2] == (page_id is not None, page_id or 0)
            for payload, digest, page_id in zip(payloads, digests, ids, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("page_id"),
                piece.column("url"),
                piece.column("sha1"),
                pa.array(digests),
                pa.array([len(payload) for payload in payloads], pa.int64()),
                pa.array([packer.compress(p) if c else None for p, c in zip(payloads, carries, strict=True)], pa.binary()),
            ],
            ["page_id", "url", "sha1", "payload_digest", "payload_bytes", "packed"],
        )


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of records that carry their payload."""
    unpacker = zstandard.ZstdDecompressor()
    for piece in pieces(batches, "packed", 1 << 20):
        html = [unpacker.decompress(p).decode() if p else None for p in piece.column("packed").to_pylist()]
        at = piece.schema.get_field_index("packed")
        yield piece.set_column(at, "packed", pa.array(html, pa.string()))


def _header(name: str, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def size_class(class_bytes: int = CLASS_BYTES) -> Column:
    """0 for pages of up to ``class_bytes``, and one more for every ``CLASS_STEP`` times as much."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.coalesce(F.octet_length("url"), F.lit(0))
    above = [(size > class_bytes * CLASS_STEP**k).cast("int") for k in range(8) if class_bytes * CLASS_STEP**k < 1 << 31]
    return sum(above, F.lit(0))


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, class_bytes: int = CLASS_BYTES, file_bytes: int = FILE_BYTES
) -> None:
    """Write one record per page below ``path``.

    Of equal payloads of at least ``min_bytes`` the largest page_id is a response, the others revisit it.
    """
    slim = pages.select(F.col("page_id").cast("long"), "url", "html")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    sha1 = F.unhex(F.sha1(payload)).alias("sha1")
    # Stored, so that its size is known: while few payloads repeat, the pages need no shuffle.
    shared = materialize(
        slim.where(F.octet_length(payload) >= min_bytes)
        .groupBy(sha1)
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "response_id", F.lit(True).alias("is_shared")),
        "shared-payloads",
    )
    # at most eight classes
    classes = sorted(r[0] for r in slim.select(size_class(class_bytes).alias("size")).distinct().collect())
    for number in classes:
        records = _records(slim.where(size_class(class_bytes) == number).select("*", sha1), shared, min_bytes)
        limit = max(1, file_bytes // (class_bytes * CLASS_STEP**number))
        records.write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", limit).text(path)
    if not classes:
        slim.select(F.col("html").alias("value")).write.text(path)


def _records(slim: DataFrame, shared: DataFrame, min_bytes: int) -> DataFrame:
    """(value): the record of every page, without its last two line ends."""
    packed = slim.transform(
        map_batches,
        lambda batches: _pack(batches, min_bytes),
        "page_id long, url string, sha1 binary, payload_digest string, payload_bytes long, packed binary",
    )
    decided = packed.join(shared, "sha1", "left").withColumn(
        "revisit", F.coalesce("is_shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    )
    full = decided.withColumn("packed", F.when(~F.col("revisit"), F.col("packed"))).select(
        "page_id", "url", "payload_digest", "payload_bytes", "packed", "revisit", "response_id"
    )
    records = full.transform(
        map_batches,
        _unpack,
        "page_id long, url string, payload_digest string, payload_bytes long, packed string, "
        "revisit boolean, response_id long",
    )
    size = F.col("payload_bytes").cast("string")
    block = F.when(
        ~F.col("revisit"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
            size,
            F.lit("\r\n\r\n"),
            F.col("packed"),
        ),
    ).otherwise("")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    identity = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    refers = F.when(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.col("response_id").cast("string"), F.lit(">")))
    line = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise("response")),
        _header("WARC-Record-ID", identity),
        _header("WARC-Target-URI", url),
        _header("WARC-Refers-To", refers),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _header("X-Payload-Length", size),
        _header("Content-Length", F.octet_length("block")),
        F.lit("\r\n"),
        F.col("block"),
    )
    return records.withColumn("block", block).select(line.alias("value"))


CANDIDATE = (
    "path string, offset long, successor long, file_bytes long, part long, leaves_to long, page_id long, "
    "record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
_KIND = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("successor", pa.int64()), ("file_bytes", pa.int64()),
     ("part", pa.int64()), ("leaves_to", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def _page(reference: str | None) -> int | None:
    number = (reference or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def parse_record(content: bytes, at: int, with_payload: bool) -> dict | None:
    """The record whose magic stands at ``at``, or None if its header or its end is impossible."""
    end = content.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    fields = {}
    for line in content[at + len(MAGIC) : end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16) or "warc-type" not in fields:
        return None
    begin, stop = end + 4, end + 4 + int(length)
    if content[stop : stop + 4] != b"\r\n\r\n":
        return None
    record = {
        "offset": at,
        "successor": stop + 4,
        "page_id": _page(fields.get("warc-record-id")),
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
    }
    if record["record_type"] == "response":
        body = content.find(b"\r\n\r\n", begin, stop)
        payload = content[body + 4 if body >= 0 else stop : stop]
        return record | {
            "payload_bytes": len(payload),
            "payload_digest": base32_sha1(payload),
            "payload": payload if with_payload else None,
        }
    size = fields.get("x-payload-length", "")
    return record | {
        "payload_bytes": int(size) if size.isascii() and size.isdigit() else None,
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload": None,
    }


def candidates(path: str, content: bytes, range_bytes: int, with_payload: bool) -> Iterator[list[dict]]:
    """All possible records of a file, range by range, with the offset where their chain leaves the range.

    A record begins the file or stands behind two line ends. The header of a candidate ends before the next
    one begins, so that headers are read once, however long they are.
    """
    for part in range(math.ceil(len(content) / range_bytes)):
        found, begin, stop = [], part * range_bytes, (part + 1) * range_bytes
        at = content.find(MAGIC, begin, stop + len(MAGIC) - 1)
        while at >= 0:
            begins = at == 0 or content[max(0, at - 4) : at] == b"\r\n\r\n"
            if begins and (record := parse_record(content, at, with_payload)):
                found.append(record | {"path": path, "file_bytes": len(content), "part": part})
            at = content.find(MAGIC, at + 1, stop + len(MAGIC) - 1)
        leaves: dict[int, int] = {}
        for record in reversed(found):
            leaves[record["offset"]] = record["leaves_to"] = leaves.get(record["successor"], record["successor"])
        if found:
            yield found


def _scan(batches: Iterable[pa.RecordBatch], range_bytes: int, with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            path, content = batch.column("path")[row].as_py(), batch.column("content")[row].as_py()
            for found in candidates(path, content, range_bytes, with_payload):
                yield pa.RecordBatch.from_pylist(found, _KIND)


def _reachable(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of one range that a true entry reaches."""
    after = dict(zip(group["offset"], group["successor"], strict=True))
    reached = set()
    for at in group.loc[group["entry"], "offset"]:
        while at in after and at not in reached:
            reached.add(at)
            at = after[at]
    return group.loc[group["offset"].isin(reached), ["file", "offset"]]


def true_records(found: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, offset) of the candidates that the start of their file reaches."""
    edges = found.select("file", "offset", "leaves_to")
    longest = found.agg(F.max("file_bytes")).first()[0] or 1
    entries = edges.where("offset = 0").select("file", F.col("offset").alias("entry"))
    jumps = edges.select("file", F.col("offset").alias("entry"), F.col("leaves_to").alias("goal"))
    for _ in range(math.ceil(math.log2(math.ceil(longest / range_bytes))) if longest > range_bytes else 0):
        ahead = jumps.join(entries, ["file", "entry"]).select("file", F.col("goal").alias("entry"))
        entries = materialize(
            entries.union(ahead.join(edges, [ahead["file"] == edges["file"], ahead["entry"] == edges["offset"]], "left_semi")).distinct(),
            "warc-entries",
        )
        second = jumps.select("file", F.col("entry").alias("goal"), F.col("goal").alias("further"))
        jumps = materialize(
            jumps.join(second, ["file", "goal"]).select("file", "entry", F.col("further").alias("goal")), "warc-jumps"
        )
    marked = found.select("file", "part", "offset", "successor").join(
        entries.select("file", F.col("entry").alias("offset"), F.lit(True).alias("entry")), ["file", "offset"], "left"
    )
    return (
        marked.withColumn("entry", F.coalesce("entry", F.lit(False)))
        .groupBy("file", "part")
        .applyInPandas(_reachable, "file long, offset long")
    )


def read_archives(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, with_payload: bool = False
) -> DataFrame:
    """All records of the archives below ``path``: file, offset, page, type, reference, size, digest, payload.

    The digest and size of a response are those of the bytes read.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.transform(map_batches, lambda batches: _scan(batches, range_bytes, with_payload), CANDIDATE)
    found = materialize(found, "warc-candidates")
    found = found.withColumn("file", F.xxhash64("path"))
    return found.join(true_records(found, range_bytes), ["file", "offset"], "left_semi").select(
        "path", "offset", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives that all executors see."""
    return scratch_path(spark, "warc")
