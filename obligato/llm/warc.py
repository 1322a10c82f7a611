"""WARC archives of Zstandard frames with a shared dictionary.

An archive starts with a skippable frame that holds the (compressed) dictionary; one frame per
record follows. Records with a payload that an earlier page has are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .binary_files import read_files, write_files
from .common import bound_batches

#: Payload bytes that go into one archive, on average.
ARCHIVE_BYTES = 8 << 20
#: The dictionary is trained on so many pages at most, and so many characters of each; it changes sizes, not results.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 8192, 32 << 10
# Fixed values of the Zstandard and WARC formats.
FRAME, SKIPPABLE, DICTIONARY_FRAME = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
VERSION, IDENTICAL = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Between the frames: an empty skippable frame, so that the text sink's separator is valid Zstandard.
SEPARATOR = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
DATE = "2000-01-01T00:00:00Z"


def train_dictionary(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> bytes:
    """A dictionary trained on a bounded sample of the pages; empty if they are too few to train on."""
    keyed = pages.where(F.col(html_col) != "").select(F.xxhash64(id_col, html_col).alias("k"), F.substring(html_col, 1, SAMPLE_CHARS).alias("html"))
    last = keyed.select("k").orderBy("k").limit(SAMPLE_PAGES).agg(F.max("k")).first()[0]
    rows = keyed.where(F.col("k") <= last).distinct().collect() if last is not None else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r.html.encode() for r in rows]).as_bytes() if rows else b""
    except zstandard.ZstdError:
        return b""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, which tells the payload's length, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _uri(page_id), "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe="%/:?#[]@!$&'()*+,;=~-._"), "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    } | ({"WARC-Refers-To": _uri(refers_to), "WARC-Profile": IDENTICAL} if revisit else {})
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items())
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    page_id: int | None
    url: str
    type: str
    refers_to: int | None
    payload: bytes | None  #: None in a revisit
    payload_bytes: int
    payload_digest: str


def _fields(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n") if x)}


def _page(uri: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", uri)
    if not m:
        raise ValueError(f"not a record id of this archive: {uri!r}")
    return int(m[1]) if m[1] else None


def parse(data: bytes) -> Record:
    """Parse one record; raises ValueError where header, lengths or digest do not fit."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not found:
        raise ValueError(f"not a {VERSION.decode()} record: {data[:20]!r}")
    fields = _fields(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - fields.keys()
    if missing:
        raise ValueError(f"record lacks {sorted(missing)}")
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content of {len(rest) - 4} bytes, {n} in the header")
    http, found, payload = rest[:n].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    size = int(_fields(lines).get("content-length", -1))
    kind, sha = fields["warc-type"], fields["warc-payload-digest"]
    if not found or not status.startswith(b"HTTP/") or size < 0 or not sha.startswith("sha1:"):
        raise ValueError("no HTTP response or digest in the record")
    if kind == "response" and (len(payload) != size or f"sha1:{digest(payload)}" != sha):
        raise ValueError("payload does not have the length or digest that its headers tell")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields) or kind not in ("response", "revisit"):
        raise ValueError(f"bad record of type {kind}")
    refers = _page(fields["warc-refers-to"]) if kind == "revisit" else None
    return Record(_page(fields["warc-record-id"]), fields.get("warc-target-uri", ""), kind, refers,
                  payload if kind == "response" else None, size, sha[5:])


def _frame_end(data: bytes, at: int) -> int:
    """End of the Zstandard frame that starts at ``at``, by its header and block sizes."""
    descriptor = data[at + 4]
    single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
    sizes = (1 if single else 0, 2, 4, 8)[descriptor >> 6]
    at += 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + sizes
    last = 0
    while not last:
        if at + 3 > len(data):
            raise ValueError("archive ends within a frame")
        block = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + 4 * checksum


def frames(data: bytes) -> Iterator[bytes]:
    """The contents of the record frames of an archive, decoded with its leading dictionary if there is one."""
    decoder, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError("archive ends within a frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic == DICTIONARY_FRAME and at == 0:
            content = data[8:8 + size]
            if content[:4] == struct.pack("<I", FRAME):
                content = decoder.decompress(content)
            decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + size
        elif magic & 0xFFFFFFF0 == SKIPPABLE:
            at += 8 + size
        elif magic == FRAME:
            end = _frame_end(data, at)
            yield decoder.decompress(data[at:end])
            at = end
        else:
            raise ValueError(f"no frame at byte {at}")


def with_first(pages: DataFrame, partitions: int, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, first) dealt to ``partitions`` by page and payload.

    ``first`` is the smallest page_id with an equal payload where that is another page, else null; payloads under
    ``least_bytes`` have none. Payloads are equal if their SHA-256 and lengths are. Who repeats whom is found without the
    payloads, so that these are shuffled once.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"id": F.coalesce("page_id", F.lit(-1 << 63)), "sha": F.sha2("payload", 256)})
    narrow = rows.withColumn("n", F.octet_length("payload")).where(F.col("n") >= least_bytes).select("page_id", "id", "sha")
    groups = (narrow.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1")
              .select("sha", "first"))
    revisits = narrow.join(groups, "sha").where("NOT page_id <=> first AND first IS NOT NULL").select("id", "sha", "first").distinct()
    return (rows.repartition(partitions, "id", "sha").join(revisits.repartition(partitions, "id", "sha"), ["id", "sha"], "left")
            .select("page_id", "url", "payload", "first"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``.

    Null html is an empty payload, a null url an empty one. Rows that repeat the smallest page_id of their
    payload are responses all; a null page_id is never the one referred to. Further columns are ignored; an
    empty table writes no records.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(train_dictionary(pages))
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        using = {"dict_data": zstandard.ZstdCompressionDict(known)} if known else {}
        encoder, begun = zstandard.ZstdCompressor(level=3, write_checksum=True, **using), not known
        for batch in batches:
            out = []
            if not begun and batch.num_rows:
                packed, begun = zstandard.ZstdCompressor(level=3).compress(known), True
                out.append(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append(encoder.compress(record(page_id, url, payload, first, first is not None)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows = with_first(pages, -(-total // ARCHIVE_BYTES) or 1, least_bytes).sortWithinPartitions("page_id")
    write_files(rows.mapInArrow(run, "frame binary"), "frame", path, SEPARATOR)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload) of every record under ``path``."""
    bound_batches(spark)
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * payloads)
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [[r.page_id, r.url, r.payload_bytes, r.payload_digest, r.type, r.refers_to] + [r.payload] * payloads
                        for r in map(parse, frames(content.as_py()))]
                columns = zip(*rows, strict=True) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, types[x.split()[1]]) for c, x in zip(columns, schema.split(", "), strict=True)], names)

    return read_files(spark, path).mapInArrow(run, schema)
