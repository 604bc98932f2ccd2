"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

The dictionary is trained on a bounded sample of payloads.  Records of equal payloads are found by
a grouped aggregate on the payload's SHA-1: the one with the largest id is written as a response,
the others as revisits that refer to it, without the payload.  Tasks write archives of bounded size
into the shared folder and list them in a manifest; readers take one archive each, read the
dictionary from the first frame, decode frame by frame and check headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import files
from tidemark.llm.scratch import folder, stage

SKIPPABLE = 0x184D2A5D  # magic number of the frame that holds the dictionary
LEVEL = 3
DICTIONARY = 65_536
SAMPLE_PAGES, SAMPLE_BYTES = 2000, 8192  # pages that the dictionary is trained on, and bytes from the middle of each
ARCHIVE_BYTES = 64 << 20                 # records of so many bytes make an archive; a longer record is an archive of its own
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit (refers_to given) holds the HTTP header of its payload alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "%:/?#[]@!$&'()*+,;=-._~"
_PAGE = re.compile(r"<urn:x-page:(-?\d*)>")


class BadRecord(ValueError):
    pass


def parse(raw: bytes) -> dict:
    """A record's fields; raises BadRecord unless headers, lengths and digest agree."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1" or not mark:
        raise BadRecord("no WARC/1.1 header")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise BadRecord(f"bad header line {line!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise BadRecord(f"no {name}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadRecord("the block is not as long as it says")
    http, mark, payload = rest[:length].partition(b"\r\n\r\n")
    inner = re.search(rb"(?i)\r\nContent-Length: *(\d+)", http)
    page, refers = _PAGE.fullmatch(fields["warc-record-id"]), _PAGE.fullmatch(fields.get("warc-refers-to", ""))
    if not mark or not http.startswith(b"HTTP/1.") or inner is None or page is None:
        raise BadRecord("bad HTTP block or record id")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(inner[1]) or payload_digest(payload) != digest or refers:
            raise BadRecord("the payload is not the one described")
    elif kind != "revisit" or payload or not refers:
        raise BadRecord(f"bad {kind} record")
    return {"page_id": int(page[1]) if page[1] else None, "payload_bytes": int(inner[1]), "payload_digest": digest, "record_type": kind, "refers_to": int(refers[1]) if refers else None, "url": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None}


def frames(source) -> Iterator[bytes]:
    """The records of an open archive, a frame each, decoded with the dictionary of its first frame."""
    head = source.read(8)
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != SKIPPABLE:
        raise BadRecord("no dictionary frame")
    held = source.read(size)
    if len(held) != size:
        raise BadRecord("the dictionary frame is cut short")
    if held[:4] == b"\x28\xb5\x2f\xfd":  # a dictionary may itself be compressed
        held = zstandard.ZstdDecompressor().decompress(held)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    left = b""
    while True:
        left = left or source.read(1 << 16)
        if not left:
            return
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(left))
            if frame.eof:
                break
            left = source.read(1 << 16)
            if not left:
                raise BadRecord("the last frame is cut short")
        left = frame.unused_data
        yield b"".join(parts)


def _train(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    pieces = [x for x in (bytes(p) for p in rows.sort_values("piece").piece) if x]
    try:
        built = zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        built = b"".join(pieces)[-DICTIONARY:] or b"WARC/1.1\r\n"
    return pd.DataFrame({"dictionary": [built]})


def _writer(where: str, dictionary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(dictionary.value)
        held.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        part, number = TaskContext.get().partitionId(), 0
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))))
        row = next(rows, None)
        while row is not None:
            name, size, n = f"part-{part:06d}-{number:04d}.warc.zst", 0, 0
            with files.writing(where, name) as out:
                out.write(struct.pack("<II", SKIPPABLE, len(dictionary.value)) + dictionary.value)
                while row is not None and (not n or size < ARCHIVE_BYTES):
                    page_id, url, html, refers_to = row
                    payload = (html or "").encode()
                    raw = record(page_id, url, payload, payload_digest(payload), refers_to)
                    out.write(compressor.compress(raw))
                    size, n, row = size + len(raw), n + 1, next(rows, None)
            yield pa.record_batch({"file": [f"{where}/{name}"], "n_records": pa.array([n], pa.int64())})
            number += 1

    return run


def write_archives(pages: DataFrame, where: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of (page_id, url, html) and return the manifest: file, n_records.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest
    page_id is a response and the others revisit it; rows that repeat that id are responses too.
    A null html is an empty payload; a null url is left out; a null page_id never is the one
    referred to while another row has an id.  An empty table writes no archive.  Other columns are
    ignored.
    """
    spark = pages.sparkSession
    where = where or folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_key", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    middle = F.greatest(F.lit(1), (F.length("html") / 2).cast("int") - SAMPLE_BYTES // 8)
    ranked = rows.withColumn("rank", F.xxhash64("page_id", "payload_key"))
    n = pages.count()
    if n > 2 * SAMPLE_PAGES:  # about twice as many as wanted pass, so what tasks hand to the one that sorts doesn't grow
        ranked = ranked.filter(F.col("rank") < -(1 << 63) + (1 << 64) * 2 * SAMPLE_PAGES // n)
    sample = ranked.select("rank", F.encode(F.substr("html", middle, F.lit(SAMPLE_BYTES // 4)), "UTF-8").alias("piece")).orderBy("rank").limit(SAMPLE_PAGES)
    trained = sample.groupBy(F.lit(0).alias("one")).applyInPandas(_train, "dictionary binary").collect()
    dictionary = spark.sparkContext.broadcast(bytes(trained[0].dictionary) if trained else b"WARC/1.1\r\n")
    # written first: the join then sees its size, and can split a payload that very many pages share
    heads = stage(rows.filter(F.octet_length("html") >= least_bytes).groupBy("payload_key").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1 and head is not null").select("payload_key", "head"), "heads")
    typed = rows.join(heads, "payload_key", "left").withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("head")), F.col("head")))
    return stage(typed.select("page_id", "url", "html", "refers_to").mapInArrow(_writer(where, dictionary), "file string, n_records long"), "manifest")


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
        schema = pa.schema(kinds if with_payload else kinds[:-1])
        for batch in batches:
            for row in batch.to_pylist():
                n, held, size = 0, [], 0
                with files.opened(row["file"]) as source:
                    for raw in frames(source):
                        held.append(parse(raw))
                        n, size = n + 1, size + len(raw)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist([{k: x[k] for k in schema.names} for x in held], schema=schema)
                            held, size = [], 0
                if n != row["n_records"]:
                    raise BadRecord(f"{row['file']} holds {n} of {row['n_records']} records")
                yield pa.RecordBatch.from_pylist([{k: x[k] for k in schema.names} for x in held], schema=schema)

    return run


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of a manifest's archives, checked: page_id, payload_bytes, payload_digest, record_type, refers_to, url and, if asked for, payload (null in revisits)."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload
    return manifest.repartition(max(1, manifest.count())).mapInArrow(_reader(with_payload), schema)
