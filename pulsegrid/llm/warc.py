"""WARC archives in Zstandard with a dictionary: one frame per record, the dictionary in a leading skippable frame.

``write_archives`` turns pages into archive images of about ``SEGMENT`` bytes, rows of a table (name, content) that
Spark writes to any of its stores; each content is a complete ``.warc.zst`` file. ``read_records`` reads any such rows,
also those of ``spark.read.format("binaryFile")`` over real files, and validates every record: frame, version line,
named fields, Content-Length, record end, payload length and SHA-1 digest.

Equal payloads of at least ``min_bytes`` bytes are stored once: the row with the largest page_id is the response, the
others are revisit records that name it. The largest id per digest is a grouped maximum (partial first); only digests
that occur more than once are joined back, so pages are shuffled only if such digests are many, and adaptive
execution splits a hot one.

The dictionary is trained on a bounded sample (about ``SAMPLE_PAGES`` pages by a hash of page_id, ``SAMPLE_CHARS`` of each); it
changes sizes only. With too few samples the archives have none.

Defined results: null html is an empty payload; a null page_id is always a response; rows that share page_id and
payload with a response are responses too; control characters in a url are percent-encoded, a null url is left out.
Damaged input gives a row with ``error`` set (what follows in that archive after a broken frame is not read). Extra
columns are ignored; no pages give no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise, prepare, slices

SEGMENT = 4 << 20
LEVEL = 3
DICTIONARY_BYTES = 32 << 10
SAMPLE_PAGES, SAMPLE_CHARS = 400, 8000
DATE = "2026-01-01T00:00:00Z"

# fixed values: the Zstandard and WARC formats
_SKIPPABLE = 0x184D2A5D
_FRAME = 0xFD2FB528
_VERSIONS = (b"WARC/1.0", b"WARC/1.1")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_ID = "<urn:page:{}>"


# ---- frames --------------------------------------------------------------------------------------------------


def skippable_frame(content: bytes) -> bytes:
    return struct.pack("<II", _SKIPPABLE, len(content)) + content


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends; ValueError if the data ends first."""
    try:
        descriptor = data[at + 4]
        single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
        size_field = (single, 2, 4, 8)[descriptor >> 6]
        at += 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + size_field
        last = False
        while not last:
            header = data[at] | data[at + 1] << 8 | data[at + 2] << 16
            last = bool(header & 1)
            at += 3 + (1 if header >> 1 & 3 == 1 else header >> 3)
    except IndexError:
        raise ValueError("frame is cut off") from None
    at += 4 * checksum
    if at > len(data):
        raise ValueError("frame is cut off")
    return at


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, with the dictionary of its leading skippable frame."""
    data, at, first = memoryview(content), 0, True
    decoder = zstandard.ZstdDecompressor()
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("frame is cut off")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(data):
                raise ValueError("skippable frame is cut off")
            if magic == _SKIPPABLE and first:
                dictionary = bytes(data[at + 8:at + 8 + size])
                if dictionary[:4] == struct.pack("<I", _FRAME):  # the dictionary may itself be compressed
                    dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
            at += 8 + size
        elif magic == _FRAME:
            end = frame_end(data, at)
            try:
                yield decoder.decompressobj().decompress(data[at:end])
            except zstandard.ZstdError as e:
                raise ValueError(f"frame: {e}") from None
            at = end
        else:
            raise ValueError("no frame where one must begin")
        first = False


# ---- records -------------------------------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit of that page's response (its HTTP header only)."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", _ID.format("none" if page_id is None else page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _ID.format(refers_to)), ("WARC-Profile", _PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError("field without a name")
        out[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(raw: bytes) -> dict:
    """The record's fields, block and payload, validated; ValueError names what is wrong."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or lines[0] not in _VERSIONS:
        raise ValueError("no WARC version line")
    fields = _fields(lines[1:])
    if missing := [f for f in _REQUIRED if f not in fields]:
        raise ValueError(f"field {missing[0]} is missing")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not match the record")
    out = {"type": fields["warc-type"], "fields": fields, "payload": None, "payload_bytes": None}
    if fields["warc-type"] in ("response", "revisit") and fields.get("content-type", "").startswith("application/http"):
        http, blank, payload = rest[:n].partition(b"\r\n\r\n")
        if not blank or not http.startswith(b"HTTP/"):
            raise ValueError("no HTTP header")
        length = _fields(http.split(b"\r\n")[1:]).get("content-length", "")
        if not length.isdigit():
            raise ValueError("HTTP header without a length")
        out["payload_bytes"] = int(length)
        if fields["warc-type"] == "response":
            digest = fields.get("warc-payload-digest", "")
            if len(payload) != int(length):
                raise ValueError("payload length does not match")
            if digest.startswith("sha1:") and digest[5:] != payload_digest(payload):
                raise ValueError("payload digest does not match")
            out["payload"] = payload
        elif "warc-refers-to" not in fields:
            raise ValueError("revisit without a record it refers to")
    return out


# ---- Spark ---------------------------------------------------------------------------------------------------


def train_dictionary(pages: DataFrame) -> bytes:
    """A Zstandard dictionary from a bounded hash sample of ``pages(page_id, html)``; empty if samples are too few."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "html").where("html is not null and page_id is not null")
    n = pages.count()
    spread = F.pmod(F.xxhash64(F.lit("warc"), "page_id"), F.lit(1 << 30))
    some = pages.where(spread < int(min(1.0, SAMPLE_PAGES / max(n, 1)) * (1 << 30))).select("page_id", F.substring("html", 1, SAMPLE_CHARS))
    texts = [text.encode() for _, text in sorted(map(tuple, some.collect())) if text]
    if len(texts) < 50 or sum(map(len, texts)) < 4 * DICTIONARY_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archives of ``pages(page_id, url, html)`` as a written table ``(archive, content)``."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    dictionary = train_dictionary(pages)
    hashed = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    repeated = (hashed.where(F.octet_length("html") >= min_bytes).groupBy("digest")
                .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "response"))
    rows = hashed.join(materialise(repeated, "repeated"), "digest", "left")
    rows = rows.select("page_id", "url", "html", F.when(F.col("response") != F.col("page_id"), F.col("response")).alias("refers_to"))

    def run(batches):
        lead = skippable_frame(zstandard.ZstdCompressor(level=19).compress(dictionary)) if dictionary else b""
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        encoder = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True, **options)
        part, n, held, size = TaskContext.get().partitionId(), 0, [lead], len(lead)

        def archive():
            return pa.RecordBatch.from_pydict({"archive": [f"part-{part:05d}-{n:05d}.warc.zst"], "content": pa.array([b"".join(held)], pa.binary())})

        for batch in batches:
            for some in slices(batch, "html"):
                ids, urls, refers = (some.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
                for i, html in enumerate(some.column("html")):
                    frame = encoder.compress(record(ids[i], urls[i], html.as_buffer().to_pybytes(), refers[i]))
                    held.append(frame)
                    size += len(frame)
                    if size >= SEGMENT:
                        yield archive()
                        n, held, size = n + 1, [lead], len(lead)
        if len(held) > 1:
            yield archive()

    return materialise(rows.mapInArrow(run, "archive string, content binary"), "archives")


_RECORDS = pa.schema([("archive", pa.string()), ("ordinal", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                      ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("refers_to", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of ``archives(archive, content)``, validated; ``error`` tells what is wrong with it."""
    prepare(archives.sparkSession)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                rows, size, ordinal = [], 0, 0
                source = frames(content.as_buffer().to_pybytes() if content.is_valid else b"")
                while True:
                    row = dict.fromkeys(_RECORDS.names)
                    row |= {"archive": name, "ordinal": ordinal}
                    try:
                        raw = next(source, None)
                        if raw is None:
                            break
                        parsed = parse_record(raw)
                        fields = parsed["fields"]
                        digest = fields.get("warc-payload-digest", "")
                        row |= {"record_id": fields["warc-record-id"], "record_type": parsed["type"], "url": fields.get("warc-target-uri"),
                                "payload_bytes": parsed["payload_bytes"], "payload_digest": digest.removeprefix("sha1:") or None,
                                "refers_to": fields.get("warc-refers-to"), "payload": parsed["payload"] if with_payload else None}
                    except ValueError as e:
                        row["error"] = str(e)
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    ordinal += 1
                    if size > SEGMENT:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    ddl = ("archive string, ordinal long, record_id string, record_type string, url string, payload_bytes long, "
           "payload_digest string, refers_to string, payload binary, error string")
    return archives.select("archive", "content").mapInArrow(run, ddl)


def _page(id_: str):
    return F.regexp_extract(id_, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write archives of ``pages``, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    records = read_records(write_archives(pages, min_bytes), with_payload=False)
    broken = F.raise_error(F.concat_ws(" ", "archive", "ordinal", "error")).cast("long")
    page = F.when(F.col("error").isNull(), _page("record_id")).otherwise(broken)
    return records.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", _page("refers_to").alias("refers_to"))
