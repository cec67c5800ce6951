"""WARC archives in Zstandard (2): a dictionary in the leading skippable frame, then one frame per record."""

from __future__ import annotations

import base64
import binascii
import hashlib
import math
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt_join, packed, scratch, table

#: Skippable frame that holds the dictionary, a zstd frame, and a zstd dictionary (fixed values of the formats).
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
#: Payloads from this many bytes on are stored once.
LEAST_REVISIT = 1000
#: Bytes after which a new archive begins, and of payload for each task that writes; records and bytes of the sample that an archive's dictionary is trained on; its size.
ARCHIVE_BYTES, SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 32_000_000, 400, 2_000_000, 16_384
CHUNK = 1 << 16
_URN = re.compile(r"<urn:page:(-?\d+|null)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


class WarcError(ValueError):
    """An archive or record that isn't as the format asks."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: tuple[int | None] | None) -> bytes:
    """A response record, or with refers_to a revisit record, whose block has the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    head = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", name(refers_to[0]))]
    head += [("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        try:
            k, colon, v = line.decode().partition(":")
        except UnicodeDecodeError as e:
            raise WarcError(f"header not in UTF-8: {line[:80]!r}") from e
        if not colon or not k.strip() or k.lower() in out:
            raise WarcError(f"bad or repeated header {line[:80]!r}")
        out[k.lower()] = v.strip()
    return out


def parse(data: bytes) -> dict:
    """A record's fields; raises WarcError where the version, a header, a length or a digest is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"no WARC version and headers: {data[:40]!r}")
    h = _headers(lines)
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if k not in h:
            raise WarcError(f"no {k}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"content-length {h['content-length']} with {len(rest)} bytes")
    block = rest[:-4]
    if h.get("warc-block-digest", d := _sha1(block)) != d:
        raise WarcError("the block's digest differs")
    out = {"type": h["warc-type"], "id": h["warc-record-id"], "url": h.get("warc-target-uri"), "digest": h.get("warc-payload-digest"), "refers_to": h.get("warc-refers-to"), "payload": None, "length": None}
    if h["warc-type"] not in ("response", "revisit"):
        return out | {"payload": block, "length": len(block)}
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    fields = _headers(lines)
    if not gap or not status.startswith(b"HTTP/") or not fields.get("content-length", "").isdigit():
        raise WarcError("no HTTP status, headers or length")
    out["length"] = int(fields["content-length"])
    if h["warc-type"] == "revisit":
        if payload or not out["refers_to"] or not out["digest"] or h.get("warc-profile") != REVISIT:
            raise WarcError("a revisit with a payload, or without what it refers to")
        return out
    if len(payload) != out["length"] or out["digest"] not in (None, _sha1(payload)):
        raise WarcError("the payload's length or digest differs")
    return out | {"payload": payload}


def dictionary(samples: list[bytes]):
    """A dictionary trained on the samples, or of the first one's bytes where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(samples[0][:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archives(records: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The bytes of one archive after another, each an iterator that must be used up before the next."""
    import zstandard

    held = next(records, None)
    while held is not None:
        sample, n = [held], len(held)
        while len(sample) < SAMPLE and n < SAMPLE_BYTES and (more := next(records, None)) is not None:
            sample.append(more)
            n += len(more)

        def one(sample=sample):
            nonlocal held
            own = dictionary(sample)
            raw = own.as_bytes()
            yield struct.pack("<II", SKIPPABLE, len(raw)) + raw
            press = zstandard.ZstdCompressor(level=3, dict_data=own, write_content_size=True, write_checksum=True)
            made = 0
            for r in sample:
                made += len(out := press.compress(r))
                yield out
            while (held := next(records, None)) is not None and made < ARCHIVE_BYTES:
                made += len(out := press.compress(held))
                yield out

        held = None
        yield one()


def frames(read) -> Iterator[bytes]:
    """The decoded frames of an archive; read(n) gives its next bytes. Memory is bounded by a chunk and one record."""
    import zstandard

    buffer = read(8)
    if len(buffer) < 8 or struct.unpack("<I", buffer[:4])[0] != SKIPPABLE:
        raise WarcError("no dictionary in a leading skippable frame")
    size = struct.unpack("<I", buffer[4:])[0]
    raw = b""
    while len(raw) < size and (more := read(size - len(raw))):
        raw += more
    if len(raw) < size:
        raise WarcError("the dictionary ends early")
    if raw[:4] == struct.pack("<I", FRAME):  # the dictionary itself may be compressed
        try:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        except zstandard.ZstdError as e:
            raise WarcError(f"the dictionary can't be decoded: {e}") from e
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == struct.pack("<I", DICTIONARY) else zstandard.DICT_TYPE_RAWCONTENT
    try:
        unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
        unpress.decompressobj()
    except zstandard.ZstdError as e:
        raise WarcError(f"no dictionary: {e}") from e
    rest = b""
    while True:
        while len(rest) < 18 and (more := read(CHUNK)):
            rest += more
        if not rest:
            return
        if len(rest) < 4 or struct.unpack("<I", rest[:4])[0] != FRAME:
            raise WarcError(f"no frame where a record should begin: {rest[:8]!r}")
        one, parts = unpress.decompressobj(), []
        try:
            wanted = zstandard.get_frame_parameters(rest).content_size
            parts.append(one.decompress(rest))
            while not one.eof:
                if not (more := read(CHUNK)):
                    raise WarcError("the last frame ends early")
                parts.append(one.decompress(more))
        except zstandard.ZstdError as e:
            raise WarcError(str(e)) from e
        rest = one.unused_data
        data = b"".join(parts)
        if wanted not in (zstandard.CONTENTSIZE_UNKNOWN, len(data)):
            raise WarcError(f"a frame of {len(data)} bytes says {wanted}")
        yield data


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if re.match(r"\w+:", uri) else (fs.LocalFileSystem(), uri)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", sent: int | None = None) -> DataFrame:
    """Writes a record per row of pages into archives below folder, a URI that all workers reach; returns (uri, records).

    Of equal payloads of at least LEAST_REVISIT bytes the row with the largest page_id is a response and the others
    revisit it; rows repeated with that id are responses too, and a null page_id is smaller than any. A null html is an
    empty payload; a null url has no target. The archives that are returned are those of finished tasks; what a lost
    task left behind isn't listed. An empty table gives no archive. Other columns aren't read.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("html"), F.unhex(F.sha1(body)).alias("sha"))
    groups = rows.filter(F.octet_length("html") >= LEAST_REVISIT).groupBy("sha").agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = dealt_join(rows, table(groups, "repeated"), ["sha"], "n", "left", sent)
    size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    rows = rows.select("page_id", "url", "html", (F.col("n").isNotNull() & ~F.col("kept_id").eqNullSafe(F.col("page_id"))).alias("again"), "kept_id")
    schema = pa.schema([("uri", pa.string()), ("records", pa.int64())])

    def run(batches):
        def records():
            for batch in batches:
                for a in range(0, len(batch), 64):  # so that few pages stand twice in memory
                    for i, u, h, again, kept in zip(*(c.slice(a, 64).to_pylist() for c in batch.columns), strict=True):
                        yield record(i, u, h.encode(), (kept,) if again else None)

        for archive in archives(records()):
            n, uri = -1, f"{folder}/{uuid.uuid4().hex}.warc.zst"  # the first part is the dictionary
            store, path = _at(uri)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(path, compression=None) as to:
                for part in archive:
                    to.write(part)
                    n += 1
            yield packed([(uri, n)], schema)

    return table(rows.repartition(max(1, math.ceil(size / ARCHIVE_BYTES))).mapInArrow(run, "uri string, records long"), "archives")


def read_archives(listed: DataFrame, strict: bool = True) -> DataFrame:
    """The records of the archives in column uri: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, error.

    Archives are streamed: a worker holds one record at a time. A record that fails a check raises WarcError; with
    strict=False it ends its archive with a row that has only error. payload_bytes and payload_digest are of the full
    payload, also for revisits, whose payload is null.
    """
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
    schema = pa.schema(kinds)

    def page(urn: str | None) -> int | None:
        if urn is None:
            return None
        if not (m := _URN.fullmatch(urn)):
            raise WarcError(f"not a page's record: {urn}")
        return None if m[1] == "null" else int(m[1])

    def records(uri: str):
        store, path = _at(uri)
        try:
            with store.open_input_stream(path, compression=None) as f:
                for data in frames(f.read):
                    r = parse(data)
                    algorithm, _, digest = (r["digest"] or _sha1(r["payload"])).partition(":")
                    if algorithm != "sha1":
                        raise WarcError(f"digest {algorithm}")
                    try:
                        digest = base64.b32decode(digest).hex()
                    except (binascii.Error, ValueError) as e:
                        raise WarcError(f"digest {digest[:80]!r}: {e}") from e
                    yield (page(r["id"]), r["url"], r["type"], r["length"], digest, page(r["refers_to"]), r["payload"], None)
        except WarcError as e:
            if strict:
                raise
            yield (None,) * 7 + (f"{uri}: {e}",)

    def run(batches):
        rows, n = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for r in records(uri):
                    rows.append(r)
                    n += len(r[6] or b"")
                    if len(rows) >= 5000 or n > 8_000_000:
                        yield packed(rows, schema)
                        rows, n = [], 0
        if rows:
            yield packed(rows, schema)

    tasks = max(1, listed.count())
    ddl = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, error string"
    return listed.select("uri").repartition(tasks).mapInArrow(run, ddl)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    listed = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch(spark, "warc"))
    return read_archives(listed).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS last_id FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT p.page_id AS page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
    CASE WHEN g.last_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN g.last_id <> p.page_id THEN g.last_id END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
"""
