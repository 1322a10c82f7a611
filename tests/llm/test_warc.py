import base64
import hashlib
import struct

import pytest
import zstandard

from obligato.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages():
    rows = [(i, f"http://a.example/{i}", f"<html><body>page {i % 40} " + "text " * (i % 23) + "</body></html>") for i in range(200)]
    return rows + [(300, None, None), (301, "u", ""), (302, "http://ü/ \r\nX: y", "é" * 100), (None, "n", rows[0][2]), (None, "m", "alone"),
                   (303, "v", "x"), (303, "v", "x"), (-5, "w", "x"), (304, "long", "word " * 200_000)]


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        f = first.get(html or "") if len(data) >= least else i
        revisit = f is not None and f != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 60])
def test_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame(pages(), SCHEMA).selectExpr("*", "1 AS first", "'x' AS sha").repartition(3)
    warc.write_archives(df, str(tmp_path / "w"), least)
    got = warc.read_archives(spark, str(tmp_path / "w"), payloads=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(pages(), least)
    texts = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert texts[302] == ("é" * 100).encode() and texts[300] == b""
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)


def test_archives_are_standard_frames_behind_a_dictionary(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(pages(), SCHEMA), str(tmp_path / "w"))
    for f in (tmp_path / "w").glob("part-*"):
        data = f.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_FRAME
        known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
        reader = zstandard.ZstdDecompressor(dict_data=known).stream_reader(data[8 + size:], read_across_frames=True)
        assert reader.read() == b"".join(warc.frames(data))


def test_broken_archives_are_refused():
    good = warc.record(1, "http://a", b"payload", None, False)
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(good)
    assert warc.parse(next(warc.frames(frame))).payload == b"payload"
    for bad in (frame[:-3], frame + b"rest", frame[:10], b"\x00" * 20, frame[:20] + bytes([frame[20] ^ 1]) + frame[21:]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(map(warc.parse, warc.frames(bad)))
    for old, new in ((b"WARC/1.1", b"WARC/0.9"), (b"payload\r\n\r\n", b"payloa\r\n\r\n"), (b"payload\r\n\r\n", b"Payload\r\n\r\n"),
                     (b"WARC-Date: ", b"X-Date: "), (b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"), (b"urn:page:1", b"urn:other"),
                     (b"WARC-Type: response", b"WARC-Type: resource")):
        assert old in good
        with pytest.raises(ValueError, match=r".+"):
            warc.parse(good.replace(old, new))


def test_frame_ends_of_every_block_kind():
    for data in (b"", b"x", b"a" * 300_000, bytes(range(256)) * 2000, hashlib.sha512(b"1").digest() * 3):
        for size in (True, False):
            frame = zstandard.ZstdCompressor(write_content_size=True, write_checksum=size).compress(data)
            assert warc._frame_end(frame + b"more", 0) == len(frame)


def test_empty_and_single_page_tables(spark, tmp_path):
    df = spark.createDataFrame(pages(), SCHEMA)
    warc.write_archives(df.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    one = [(7, "u", "few")]  # too few to train a dictionary on
    warc.write_archives(spark.createDataFrame(one, SCHEMA), str(tmp_path / "one"))
    assert [(r.page_id, r.payload_bytes) for r in warc.read_archives(spark, str(tmp_path / "one")).collect()] == [(7, 3)]
