import io
import random
import struct

import pytest
import zstandard

from tidemark.llm import warc


def _pages(spark):
    rnd = random.Random(1)
    rows = [(k, f"http://h{k}.org/ü a\r\nb", f"<p>{rnd.randrange(40)}</p>") for k in range(200)] + [(300, None, None), (301, "u", ""), (302, "", "x" * 300_000), (199, "again", "<p>twice</p>"), (199, "again", "<p>twice</p>"), (None, "n", "<p>twice</p>"), (None, "n", "alone")]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, head string, refers_to long"), rows


def test_round_trip_against_brute_force(spark):
    pages, rows = _pages(spark)
    got = warc.read_archives(warc.write_archives(pages), with_payload=True).collect()
    heads = {}
    for page, _, html in rows:
        key = (html or "").encode()
        heads[key] = max((x for x in (heads.get(key), page) if x is not None), default=None)
    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        head = heads[raw]
        revisit = head is not None and (page is None or page < head)
        expected.append((page, len(raw), warc.payload_digest(raw), "revisit" if revisit else "response", head if revisit else None, None if revisit else raw))
    key = lambda r: (str(r[0]), r[2])
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(expected, key=key)


def test_small_payloads_can_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.read_archives(warc.write_archives(pages, least_bytes=3)).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_no_pages(spark):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))).collect() == []


def _archive(records, dictionary=b"some dictionary text", compressed=False):
    held = zstandard.ZstdCompressor().compress(dictionary) if compressed else dictionary
    compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return struct.pack("<II", warc.SKIPPABLE, len(held)) + held + b"".join(map(compressor.compress, records))


def test_archives_and_records_are_validated():
    good = [warc.record(k, "http://a/", b"payload" * k, warc.payload_digest(b"payload" * k), None) for k in range(1, 4)]
    for compressed in (False, True):
        raw = _archive(good, compressed=compressed)
        assert [warc.parse(x)["payload_bytes"] for x in warc.frames(io.BytesIO(raw))] == [7, 14, 21]
    for broken in (raw[:-3], b"\x00" * 8 + raw, raw[:6]):
        with pytest.raises(warc.BadRecord):
            list(warc.frames(io.BytesIO(broken)))
    for change in ((b"WARC/1.1", b"WARC/0.1"), (b"payload\r\n", b"paylobd\r\n"), (b"\r\n\r\n", b"\r\n"), (b"WARC-Date", b"WARC-Dote"), (b"urn:x-page:1", b"urn:other:1"), (b"WARC-Type: response", b"WARC-Type: revisit")):
        assert change[0] in good[0]
        with pytest.raises(warc.BadRecord):
            warc.parse(good[0].replace(*change))
