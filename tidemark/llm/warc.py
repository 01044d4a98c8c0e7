"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Spark's text writer makes the files: it puts bytes down as they are, and the line separator is itself an empty
skippable frame, which every Zstandard reader passes over. So files commit like any Spark output.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import hash_sample, kept, ship, small_batches

# Fixed values of the Zstandard and WARC formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2000-01-01T00:00:00Z"
# Bytes of payload in one archive, before compression.
ARCHIVE_BYTES = 32 << 20
# The dictionary is trained on at most so many pages, each up to so many characters (a sample, stated here).
DICTIONARY_PAGES, DICTIONARY_CHARS, DICTIONARY_BYTES = 400, 8192, 16 << 10

RECORDS = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
           "refers_to bigint, payload binary")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def urn_page(text: str) -> int | None:
    if not (text.startswith("<urn:x-page:") and text.endswith(">")):
        raise ValueError(f"no page id: {text[:80]}")
    return int(text[12:-1]) if text[12:-1] else None


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, with the length, and no payload."""
    target = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace"))
                     for c in url or "") or "urn:x-page:unknown"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", page_urn(page_id)),
              ("WARC-Target-URI", target), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", "sha1:" + digest_of(payload))]
    if revisit:
        fields += [("WARC-Refers-To", page_urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record, validated: version, needed headers, lengths, end marks and digest."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0][:80]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"malformed header line: {line[:80]!r}")
        fields[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - fields.keys()
    if missing:
        raise ValueError(f"missing headers: {sorted(missing)}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content length {n} does not fit {len(rest)} bytes with end marks")
    http, mark, payload = rest[:n].partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no end of the HTTP head")
    said = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}
    length = int(said["content-length"])
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not fit its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError(f"revisit {fields['warc-record-id']} with a payload or without its target")
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown record type {kind}")
    return {"page_id": urn_page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": length, "payload_digest": digest, "payload": payload if kind == "response" else None,
            "refers_to": urn_page(fields["warc-refers-to"]) if kind == "revisit" else None}


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends, from its block headers."""
    import zstandard

    params = zstandard.get_frame_parameters(data[at:at + 18])
    pos = at + zstandard.frame_header_size(data[at:at + 18])
    last = False
    while not last:
        word = int.from_bytes(data[pos:pos + 3], "little")
        last, kind, size = bool(word & 1), word >> 1 & 3, word >> 3
        pos += 3 + (1 if kind == 1 else size)
    return pos + 4 * params.has_checksum


def read_archive(content: bytes):
    """Raw records of one archive, one from each frame."""
    import zstandard

    data = memoryview(content)
    if not len(data):
        return
    magic, size = struct.unpack_from("<II", data, 0)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    known = bytes(data[8:8 + size])
    if known[:4] == struct.pack("<I", FRAME_MAGIC):
        known = zstandard.ZstdDecompressor().decompress(known)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known) if known else None)
    at = 8 + size
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0]
        if magic in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield reader.decompress(data[at:end])
            at = end
        else:
            raise ValueError(f"unknown frame at {at}")


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages; empty where they are too few to train on."""
    import zstandard

    some = pages.where("html is not null and length(html) > 0")
    sample = (hash_sample(some, F.col("html"), DICTIONARY_PAGES)
              .select(F.substring("html", 1, DICTIONARY_CHARS).alias("t")).orderBy("t").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r.t.encode("utf-8", "replace") for r in sample]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, revisit_bytes: int = 0) -> None:
    """Write one record for each row of ``pages`` (page_id, url, html).

    Of equal payloads of ``revisit_bytes`` or more, the one with the largest page_id is the response and the others
    revisit it. Null html is an empty payload. Repeated rows of the largest page_id are all responses; a null page_id
    is smaller than any other, and where a group has no other, all are responses. An empty table gives archives
    without records.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = pages.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("n", F.octet_length("html"))
    # Groups of copies only: aggregated on the map side, so that a hot payload is one row a task.
    heads = kept(keyed.where(F.col("n") >= revisit_bytes).groupBy("sha", "n")
                 .agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("head"))
                 .where("copies > 1").select("sha", "n", "head"), "warc-heads")
    total = pages.agg(F.sum(F.octet_length("html")).alias("b")).first().b or 0
    known = spark.sparkContext.broadcast(train_dictionary(pages))  # bounded: DICTIONARY_BYTES

    def pack(batches):
        import zstandard

        raw = known.value
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True,
                                          dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        yield pa.RecordBatch.from_pydict(
            {"value": pa.array([struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw], pa.binary())})
        for batch in batches:
            frames = []
            for page_id, url, html, head in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                revisit = head is not None and page_id != head
                frames.append(packer.compress(
                    make_record(page_id, url, html.encode("utf-8", "surrogatepass"), head, revisit)))
            yield pa.RecordBatch.from_pydict({"value": pa.array(frames, pa.binary())})

    dealt = (keyed.join(heads, ["sha", "n"], "left").select("page_id", "url", "html", "head")
             .repartition(max(1, -(-int(total) // archive_bytes))))  # in turn, so rows that repeat spread as well
    (dealt.mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR).text(path))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives below ``path``, each checked; ``payloads=False`` leaves the bytes out."""
    small_batches(spark)

    def unpack(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                held = 0
                for raw in read_archive(content.as_buffer()):
                    record = parse_record(raw)
                    if not payloads:
                        record["payload"] = None
                    rows.append(record)
                    held += len(raw) if payloads else 0
                    if len(rows) == 2000 or held > 16 << 20:
                        yield to_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield to_batch(rows)

    def to_batch(rows):
        kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
                 "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], t) for k, t in kinds.items()})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(unpack, RECORDS)


ship(__name__)
