"""Archives: round trip, revisits, and what a reader must refuse."""

import hashlib
import io
import struct

import pytest
import zstandard

from folio.llm import warc


def written(tmp_path, spark, rows, name="a"):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, error string")
    return warc.write_archives(df.repartition(3), f"file://{tmp_path}/{name}")


BIG = "<p>é" + "x" * 1200
ROWS = [(1, "http://a/ b", BIG, "c"), (7, None, BIG, None), (5, "http://c", "small", None), (6, "http://d", "small", None), (8, "u", None, None), (9, "u", "", None), (7, "again", BIG, None), (None, "n", BIG, None), (10, "u\r\nX: y", BIG + "z", None)]


def test_round_trip(spark, tmp_path):
    listed = written(tmp_path, spark, ROWS)
    got = sorted((r.asDict() for r in warc.read_archives(listed).collect()), key=lambda r: (r["page_id"] or 0, r["url"] or ""))
    want = []
    for i, u, h, _ in ROWS:
        raw = (h or "").encode()
        again = h == BIG and i != 7
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 7 if again else None, None if again else raw))
    key = lambda x: (x[0] or 0, x[1], x[3])
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    assert {r["url"] for r in got if r["page_id"] in (1, 10)} == {"http://a/%20b", "u%0D%0AX:%20y"}


def test_empty_table(spark, tmp_path):
    listed = written(tmp_path, spark, [])
    assert listed.count() == 0 and warc.read_archives(listed).count() == 0


def archive(records):
    return b"".join(b"".join(a) for a in warc.archives(iter(records)))


def test_archives_roll_over_and_samples_differ(monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    monkeypatch.setattr(warc, "SAMPLE", 20)
    records = [warc.record(i, f"http://x/{i}", hashlib.sha256(str(i).encode()).hexdigest().encode() * (i % 9), None) for i in range(300)]
    found, n = [], 0
    for a in warc.archives(iter(records)):
        raw = b"".join(a)
        n += 1
        assert struct.unpack("<I", raw[:4])[0] == warc.SKIPPABLE
        found += list(warc.frames(io.BytesIO(raw).read))
    assert n > 3 and found == records


def test_a_compressed_dictionary_is_loaded():
    raw = archive([warc.record(1, "u", b"abc" * 50, None)] * 3)
    size = struct.unpack("<I", raw[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(raw[8 : 8 + size])
    again = struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed + raw[8 + size :]
    assert len(list(warc.frames(io.BytesIO(again).read))) == 3


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.1"),
        lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9", 1),
        lambda r: r[:-1],
        lambda r: r.replace(b"WARC-Date", b"WARC-Data"),
        lambda r: r.replace(b"body", b"bodi"),
        lambda r: r.replace(b"WARC-Type: response\r\n", b"WARC-Type: response\r\nWARC-Type: response\r\n"),
        lambda r: r.replace(b"HTTP/1.1", b"PTTH/1.1"),
    ],
)
def test_bad_records(change):
    good = warc.record(1, "u", b"body", None)
    assert warc.parse(good)["payload"] == b"body"
    with pytest.raises(warc.WarcError):
        warc.parse(change(good))


@pytest.mark.parametrize("change", [lambda a: a[8:], lambda a: a[:-3], lambda a: a + b"junk", lambda a: a[:-12] + bytes(4) + a[-8:]])
def test_bad_archives(change):
    raw = archive([warc.record(i, "u", b"body" * 30, None) for i in range(4)])
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(change(raw)).read))


def test_errors_as_rows(spark, tmp_path):
    (tmp_path / "bad.warc.zst").write_bytes(b"no archive")
    listed = spark.createDataFrame([(f"file://{tmp_path}/bad.warc.zst", 1)], "uri string, records long")
    assert "skippable" in warc.read_archives(listed, strict=False).first().error


def test_the_files_are_archives_themselves(spark, tmp_path):
    for r in written(tmp_path, spark, ROWS, "own").collect():
        raw = open(r.uri.removeprefix("file://"), "rb").read()
        assert struct.unpack("<I", raw[:4])[0] == warc.SKIPPABLE
        assert len(list(warc.frames(io.BytesIO(raw).read))) == r.records


@pytest.mark.parametrize("broken", ["header", "digest", "dictionary"])
def test_what_cannot_be_decoded_is_a_warc_error(spark, tmp_path, broken):
    one = warc.record(1, "http://u", b"abc" * 600, None)
    if broken == "header":
        one = one.replace(b"http://u", b"http://\xff")
    if broken == "digest":
        at = one.index(b"WARC-Payload-Digest: sha1:") + 26
        one = one[:at] + b"!!!" + one[at + 3 :]
        head, _, rest = one.partition(b"\r\n\r\n")
        one = head.replace(b"WARC-Type: response", b"WARC-Type: revisit") + b"\r\n\r\n" + rest
    raw = archive([one] * 3)
    if broken == "dictionary":
        raw = struct.pack("<II", warc.SKIPPABLE, 12) + struct.pack("<I", warc.FRAME) + b"\xff" * 8 + raw[8 + struct.unpack("<I", raw[4:8])[0] :]
    path = tmp_path / "broken.warc.zst"
    path.write_bytes(raw)
    listed = spark.createDataFrame([(f"file://{path}",)], "uri string")
    got = warc.read_archives(listed, strict=False).collect()
    assert len(got) == 1 and got[0].error and got[0].page_id is None
    with pytest.raises(Exception, match="WarcError"):
        warc.read_archives(listed).collect()


def test_one_payload_of_most_pages(spark, tmp_path):
    """The same records when groups are too many to be sent."""
    rows = [(i, "u", BIG + str(i % 5 if i % 3 else 0), None) for i in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, error string").repartition(4)
    got = [sorted(tuple(r)[:6:2] + (r.refers_to,) for r in warc.read_archives(warc.write_archives(df, f"file://{tmp_path}/{n}", sent=n)).collect()) for n in (1, 500_000)]
    assert got[0] == got[1] and len(got[0]) == 90
