"""Operator 8: WARC archives in seekable Zstandard bundles.

Every task packs its records into bundles: records fill independent frames of
about FRAME_BYTES and frames fill bundles of about BUNDLE_BYTES.  Two skippable
frames end each bundle: the index, which maps the record identifiers to frame
and offset inside the frame, and the seek table with the sizes of the frames.
``read`` goes by both; ``write`` also keeps the indexes of all bundles as one
table, with which ``lookup`` fetches records by identifier, decompressing the
frames that hold them and no others.

Equal payloads of at least LEAST_REVISIT bytes are stored once: the record with
the smallest page id is the response, the others are revisits that refer to it.

The bundles are real files of one folder, written by Spark's own committed
writer to any file system it knows: each is one row of raw bytes in the text
format, one row a file, whose line end is set to the seek table's four closing
bytes.

A record's identifier has its page id and the start of its payload's digest;
rows without page id also have their task and place in it.  Rows that repeat
page id and payload both share an identifier, and each of them answers for it.

Edge cases: a null html is an empty payload; a null url is an empty target, and
line ends (CR, LF) are taken out of a url, no other character;
rows without page id are always responses; rows that repeat the smallest page
id of a payload are all responses; payloads and records of any length are kept
whole (a large record has a frame, or bundle, of its own); only the three named
columns are read; an empty table gives no records.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, ship, text_of
from gateflow.session import scratch_path

ship(__name__)

LEAST_REVISIT = 100
FRAME_BYTES = 256_000
BUNDLE_BYTES = 8_000_000
#: A payload held by at least one row in HOT_SHARE is hot; there are at most HOT_SHARE of those.
HOT_SHARE = 1000
# The seekable format's frame magic, descriptor and closing magic; the WARC revisit profile.
SKIPPABLE, CLOSING = 0x184D2A5E, 0x8F92EAB1
#: Another of the sixteen magics of skippable frames, for the index.
INDEX = 0x184D2A5D
_LINE_ENDS = {13: None, 10: None}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def with_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is the response's
    page id for revisits, else null."""
    p = pages.select(F.col(page_id).alias("page_id"), F.coalesce(url, F.lit("")).alias("url"),
                     text_of(html).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256))
    large = F.octet_length("html") >= LEAST_REVISIT
    total = p.count()
    firsts = p.where(large).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    hot = firsts.where(F.col("n") * HOT_SHARE >= total).select("digest", F.col("first").alias("hot_first"))
    # At most HOT_SHARE payloads can be hot, whatever the table's size.
    p = p.join(F.broadcast(hot), "digest", "left")
    # The rest meet their first page by a shuffle; rows that are settled or too small go anywhere.
    apart = F.col("hot_first").isNotNull() | ~large
    key = F.when(apart, F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))).otherwise(
        F.col("digest"))
    cold = firsts.where(F.col("n") * HOT_SHARE < total).select(F.col("digest").alias("k"), "first")
    p = p.withColumn("k", key).join(cold, "k", "left")
    first = F.coalesce("hot_first", "first")
    return p.select("page_id", "url", "html", "digest", F.when(first < F.col("page_id"), first).alias("refers_to"))


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, place: str = "") -> bytes:
    """One WARC record; a revisit holds the head of the response only."""
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, digest, place)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {url.translate(_LINE_ENDS)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def record_id(page_id: int | None, digest: str, place: str = "") -> str:
    return f"<urn:page:{place if page_id is None else page_id}:{digest[:16]}>"


def page_of(identifier: str) -> int | None:
    number = identifier.removeprefix("<urn:page:").split(":", 1)[0]
    return None if "." in number or not number else int(number)


def pack(records: Iterator[tuple[str, bytes]]) -> Iterator[bytes]:
    """Bundles of the records (identifier, bytes), without the seek table's
    four closing bytes."""
    press = zstandard.ZstdCompressor(level=3, write_content_size=True)
    frames: list[tuple[bytes, int]] = []
    entries: list[tuple[str, int, int, int]] = []
    frame: list[bytes] = []
    filled = whole = 0

    def close_frame() -> None:
        nonlocal filled, whole
        if frame:
            frames.append((press.compress(b"".join(frame)), filled))
            whole += filled
            frame.clear()
            filled = 0

    def close() -> bytes:
        nonlocal whole
        table = b"".join(struct.pack("<II", len(f), n) for f, n in frames)
        # The index counts as a frame without content, so that any reader of the format finds its way.
        names = "\n".join(e[0] for e in entries).encode()
        places = b"".join(struct.pack("<III", *e[1:]) for e in entries)
        index = press.compress(struct.pack("<I", len(entries)) + places + names)
        index = struct.pack("<II", INDEX, len(index)) + index
        table += struct.pack("<II", len(index), 0)
        foot = struct.pack("<IB", len(frames) + 1, 0)
        out = b"".join(f for f, _ in frames) + index + struct.pack("<II", SKIPPABLE, len(table) + 9) + table + foot
        frames.clear()
        entries.clear()
        whole = 0
        return out

    for name, r in records:
        if filled and filled + len(r) > FRAME_BYTES:
            close_frame()
            if whole + len(r) > BUNDLE_BYTES:
                yield close()
        entries.append((name, len(frames), filled, len(r)))
        frame.append(r)
        filled += len(r)
    close_frame()
    if frames:
        yield close()


def frames(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the seek table; the
    last one is the index."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != CLOSING:
        raise ValueError("not a seekable bundle")
    out, at = [], 0
    table = bundle[len(bundle) - 9 - 8 * count:len(bundle) - 9]
    for packed, size in struct.iter_unpack("<II", table):
        out.append((at, packed, size))
        at += packed
    return out


def entries(bundle: bytes) -> list[tuple[str, int, int, int]]:
    """(record identifier, frame, offset, length) of each record, from the index."""
    at, packed, _ = frames(bundle)[-1]
    data = zstandard.ZstdDecompressor().decompress(bundle[at + 8:at + packed])
    (count,) = struct.unpack_from("<I", data)
    names = data[4 + 12 * count:].decode().split("\n")
    return [(n, *p) for n, p in zip(names, struct.iter_unpack("<III", data[4:4 + 12 * count]))]


class Bundle:
    """Fetches records of a bundle; the frame used last is kept."""

    def __init__(self, data: bytes):
        self.data, self.frames, self.last = data, frames(data), (-1, b"")
        self.open = zstandard.ZstdDecompressor()

    def fetch(self, frame: int, offset: int, length: int) -> bytes:
        if self.last[0] != frame:
            at, packed, size = self.frames[frame]
            self.last = frame, self.open.decompress(self.data[at:at + packed], size)
        return self.last[1][offset:offset + length]


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """WARC headers and block of a record."""
    end = data.index(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in data[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return head, data[end + 4:end + 4 + int(head["Content-Length"])]


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write the archives of ``pages``: the bundles below ``path``/bundles, one
    file each, and the table of their indexes below ``path``/index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple[str, bytes]]:
            n = 0
            for b in blocks(batches, 2):
                for page, link, text, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                    place = f"{task}.{n}"
                    yield record_id(page, digest, place), record(
                        page, link, text.encode("utf-8", "surrogatepass"), digest, refers, place)
                    n += 1

        for bundle in pack(rows()):
            yield pa.RecordBatch.from_arrays([pa.array([bundle], pa.binary())], ["value"])

    packed = with_roles(pages, page_id, url, html).mapInArrow(run, "value binary")
    closing = struct.pack("<I", CLOSING).decode("latin-1")
    packed.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "encoding", "ISO-8859-1").option("lineSep", closing).text(f"{path}/bundles")
    _indexes(pages.sparkSession, path).write.parquet(f"{path}/index")


INDEX_SCHEMA = "record_id string, bundle string, frame int, offset long, length long"


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/bundles").where("length > 0")


def _indexes(spark: SparkSession, path: str) -> DataFrame:
    """The entries of all bundles' indexes; no record is decompressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                names, frame, offset, length = zip(*entries(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array([name] * len(names)), pa.array(frame, pa.int32()),
                     pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                    ["record_id", "bundle", "frame", "offset", "length"])

    return _bundles(spark, path).select(_name(), "content").mapInArrow(run, INDEX_SCHEMA)


def _name():
    return F.element_at(F.split("path", "/"), -1).alias("bundle")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, bundle, frame, offset, length) of every record."""
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, fetched by the entries of
    its bundle's index: (page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, record_id, bundle, frame, offset, length).  A
    response's payload is checked against its digest."""
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, record_id string, bundle string, frame int, offset long, length long")
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                bundle = Bundle(content.as_py())
                rows = []
                for ident, frame, offset, length in entries(bundle.data):
                    head, block = parsed(bundle.fetch(frame, offset, length))
                    if head["WARC-Record-ID"] != ident:
                        raise ValueError(f"{ident} is not where the index has it")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = head["WARC-Type"]
                    if kind == "response" and sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {ident} differs from its digest")
                    refers = head.get("WARC-Refers-To")
                    rows.append((page_of(ident), head["WARC-Target-URI"], int(http.rpartition(b": ")[2]), digest, kind,
                                 None if refers is None else page_of(refers), ident, name, frame, offset, length))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return _bundles(spark, path).select(_name(), "content").mapInArrow(run, schema)


def lookup(spark: SparkSession, path: str, wanted: DataFrame, record_col: str = "record_id") -> DataFrame:
    """(record_id, record binary) of the wanted identifiers: the index table
    gives bundle, frame and offset, and of each bundle that is named only the
    frames with wanted records are decompressed."""
    places = index(spark, path).join(wanted.select(F.col(record_col).alias("record_id")).distinct(), "record_id", "left_semi")
    entry = F.struct("frame", "offset", "length", "record_id")
    asked = places.groupBy("bundle").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    files = _bundles(spark, path).select(_name(), "content").join(asked, "bundle").select("content", "entries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(batch.column(0), batch.column(1).to_pylist()):
                bundle = Bundle(content.as_py())
                for e in asked:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([e["record_id"]]),
                         pa.array([bundle.fetch(e["frame"], e["offset"], e["length"])], pa.binary())], ["record_id", "record"])

    return files.mapInArrow(run, "record_id string, record binary")


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new archives in the shared folder and read them."""
    path = scratch_path(spark, "llm", "warc")
    write(pages, path)
    return read(spark, path)
