"""WARC archives written index first and read back by coalesced byte ranges.

1. Payloads (``html`` in UTF-8, null as empty) are hashed. Of records with equal payloads of
   ``LEAST_REVISIT`` bytes or more, the one with the smallest page_id is a response, the others revisit
   it and hold no payload.
2. Every task writes its records to archives of its own, one gzip member a record, and returns the
   index: archive, offset, length, url and digest per record. The index is a table, written when all
   archives are; an archive of a lost task is in no index.
3. A reader takes any selection of the index, sorts it by place, merges ranges that lie close
   together into one read and checks every payload against its digest.

Archives lie in the shared folder, through pyarrow's file systems (a mounted folder, HDFS, S3).

Defined results: a null page_id comes after all others, so a payload that only rows without id have
is a response each time; rows that repeat the smallest page_id of a payload are all responses. A null
url gives no target URI; other urls keep printable ASCII and have the rest percent-encoded in the
record, while the index has them as they are. Very long payloads are one record; an archive is closed
after ``ARCHIVE_BYTES``. An empty table gives an empty index. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize, shared_dir, slices

LEAST_REVISIT = 100
ARCHIVE_BYTES = 256_000_000
# Payloads with copies are broadcast up to so many (some 20 MB), counted first.
BROADCAST_PAYLOADS = 200_000
# Beyond that a payload with more than this share of all rows is hot; there are fewer than 256.
HOT_SHARE = 256
# Ranges with at most so many bytes between them are one read, up to the second number.
GAP, READ_BYTES = 65_536, 16_000_000
# Bytes of records that one reading task takes.
TASK_BYTES = 64_000_000

INDEX_SCHEMA = (
    "archive string, offset long, length long, page_id long, url string, "
    "payload_digest string, payload_bytes long, record_type string, refers_to long"
)
_URI_SAFE = string.punctuation


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or file and its path there."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(uri)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", str(len(block)))]]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member of its own
    whole = ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    return pack.compress(whole) + pack.flush()


def _page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    own = str(page_id) if page_id is not None else f"none:{uuid.uuid4()}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{own}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=_URI_SAFE)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(fields, http if refers_to is not None else http + payload)


def _write(root: str, date: str, archive_bytes: int):
    info = _record(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:warcinfo>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
        b"format: WARC File Format 1.1\r\n",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(root)
        fs.create_dir(folder, recursive=True)
        # A task that is tried again writes files of its own; only the one that ends is indexed.
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, number, offset, archive = None, 0, 0, ""
        try:
            for b in (p for batch in batches for p in slices(batch, "html")):
                places = []
                columns = (b.column(c).to_pylist() for c in ("page_id", "url", "html", "payload_digest", "refers_to"))
                for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
                    if out is None:
                        archive = f"{name}-{number:04d}.warc.gz"
                        out = fs.open_output_stream(f"{folder}/{archive}", compression=None)
                        out.write(info)
                        offset = len(info)
                    raw = _page_record(page_id, url, html, digest, refers_to, date)
                    out.write(raw)
                    places.append((archive, offset, len(raw)))
                    offset += len(raw)
                    if offset >= archive_bytes:
                        out.close()
                        out, number = None, number + 1
                kept = {c: b.column(c) for c in ("page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to")}
                if places:
                    archives, offsets, lengths = zip(*places, strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {"archive": pa.array(archives), "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64()), **kept}
                    )
        finally:
            if out is not None:
                out.close()

    return run


def mark_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_digest, payload_bytes, record_type, refers_to): payloads as bytes."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2("html", 256)).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    copies = rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    copies = materialize(copies.where("n > 1 AND first IS NOT NULL"), "warc-copies")
    size, total = copies.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    first = copies.select("payload_digest", "first")
    if size <= BROADCAST_PAYLOADS:
        rows = rows.join(F.broadcast(first), "payload_digest", "left")
    else:  # the few hot payloads are broadcast, rows of the others meet theirs by a shuffle
        hot = copies.where(F.col("n") * HOT_SHARE > total).select("payload_digest", F.col("first").alias("hot"))
        rows = rows.join(F.broadcast(hot), "payload_digest", "left")
        own = F.when(F.col("hot").isNull(), F.col("payload_digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
        others = first.withColumnRenamed("payload_digest", "at")
        rows = rows.withColumn("at", own).join(others, "at", "left").withColumn("first", F.coalesce("hot", "first"))
    again = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.withColumn("refers_to", again).select(
        "page_id", "url", "html", "payload_digest", "payload_bytes",
        F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to",
    )


def write_archives(pages: DataFrame, root: str | None = None, date: str = "1970-01-01T00:00:00Z") -> tuple[DataFrame, str]:
    """Write a record per row of ``pages`` (page_id, url, html); returns (index, folder)."""
    spark = pages.sparkSession
    root = root or shared_dir(spark, "warc")
    index = mark_revisits(pages).mapInArrow(_write(f"{root}/archives", date, ARCHIVE_BYTES), INDEX_SCHEMA)
    index.write.parquet(f"{root}/index")
    return read_index(spark, root), root


def read_index(spark, root: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/index")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, block) of one record, unpacked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no record starts here")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:size]


def _page(urn: str | None) -> int | None:
    last = (urn or "").strip("<>").removeprefix("urn:page:")
    return int(last) if last and not last.startswith("none:") else None


def _parse_page(raw: bytes, digest: str) -> tuple[int | None, int, str, str, int | None, bytes | None]:
    """(page_id, payload_bytes, payload_digest, type, refers_to, payload): the payload is checked."""
    fields, block = parse_record(zlib.decompress(raw, 31))
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    own = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if own != digest or (not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != own)):
        raise ValueError(f"record {fields['warc-record-id']} does not hold the payload it names")
    return _page(fields["warc-record-id"]), size, own, fields["warc-type"], _page(fields.get("warc-refers-to")), None if revisit else payload


def coalesce_ranges(places: Iterator[tuple[str, int, int]], gap: int = GAP, most: int = READ_BYTES) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (archive, offset, length) to reads (archive, start, end, [(offset, length)]): neighbours
    at most ``gap`` bytes apart share a read of at most ``most`` bytes, or of one record."""
    archive, start, end, own = "", 0, 0, []
    for a, offset, length in places:
        if own and (a != archive or offset - end > gap or offset + length - start > most):
            yield archive, start, end, own
            own = []
        if not own:
            archive, start, end = a, offset, offset
        own.append((offset, length))
        end = max(end, offset + length)
    if own:
        yield archive, start, end, own


RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(root: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(root)
        current, source = "", None
        for b in batches:
            digests, urls = b.column("payload_digest").to_pylist(), b.column("url").to_pylist()
            places = zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)
            done = 0
            for archive, start, end, own in coalesce_ranges(places):
                if archive != current:
                    if source is not None:
                        source.close()
                    current, source = archive, fs.open_input_file(f"{folder}/{archive}")
                raw = source.read_at(end - start, start)
                rows = [_parse_page(raw[o - start : o - start + n], d) for (o, n), d in zip(own, digests[done : done + len(own)], strict=True)]
                page_id, size, digest, kind, refers_to, payload = zip(*rows, strict=True)
                columns = {
                    "page_id": pa.array(page_id, pa.int64()),
                    "url": pa.array(urls[done : done + len(own)], pa.string()),
                    "payload_bytes": pa.array(size, pa.int64()),
                    "payload_digest": pa.array(digest),
                    "record_type": pa.array(kind),
                    "refers_to": pa.array(refers_to, pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns | ({"payload": pa.array(payload, pa.binary())} if with_payload else {}))
                done += len(own)
        if source is not None:
            source.close()

    return run


def read_records(selected: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """The records of the selected index rows, read from the archives: ``RECORD_SCHEMA`` and, if asked
    for, payload (null for a revisit)."""
    size = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // TASK_BYTES), min(selected.sparkSession.sparkContext.defaultParallelism, int(size) // GAP))
    places = selected.select("archive", "offset", "length", "payload_digest", "url")
    sorted_places = places.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    return sorted_places.mapInArrow(_read(f"{root}/archives", with_payload), RECORD_SCHEMA + (", payload binary" if with_payload else ""))


def read_payloads(index: DataFrame, selected: DataFrame, root: str) -> DataFrame:
    """As :func:`read_records`, with the payload of the response that a revisit refers to. Needed
    responses are read once, whether selected or not."""
    wanted = selected.where("record_type = 'revisit'").select(F.col("refers_to").alias("page_id")).distinct()
    responses = index.where("record_type = 'response' AND page_id IS NOT NULL").join(wanted, "page_id", "left_semi")
    whole = read_records(responses, root).groupBy("page_id", "payload_digest").agg(F.first("payload").alias("whole"))
    own = read_records(selected, root)
    whole = whole.select(F.col("page_id").alias("refers_to"), "payload_digest", "whole")
    return own.join(whole, ["refers_to", "payload_digest"], "left").withColumn("payload", F.coalesce("payload", "whole")).select(*own.columns)
