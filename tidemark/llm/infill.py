"""Fill-in-the-middle documents from a seekable store of compressed frames.

A text is stored as independent Zstandard frames of about ``FRAME`` bytes that end between units (a
word with the white space before it, or white space at the text's end).  Beside each frame stand
the units, code points and bytes up to its end.  A cut after a number of units is found in these
sums; only the frame that it falls into is decompressed.  The rearranged document is a list of
frames as well: frames between the cuts are taken over as they are, only the ends and the markers
are compressed anew.  Digests, and the way back to the text, read such a list frame by frame, so a
task holds one frame besides the compressed row.

Where a text is cut and which form it takes follow from its id and a seed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import stage
from tidemark.llm.words import Scanner, chunks

FRAME = 1 << 16
LEVEL = 3
SEED = 42
#: The markers, and the shares in per cent of rearranged documents and, of these, of suffix-first ones.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
REARRANGED, SUFFIX_FIRST = 50, 80
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True
_LISTS = "units array<long>, chars array<long>, bytes array<long>, frames array<binary>"


def code_points(raw: np.ndarray) -> int:
    return len(raw) - int(np.count_nonzero(_CONTINUES[raw]))


def unit_ends(scan: Scanner, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte after each unit of texts laid end to end, and the first unit of each text (and their number)."""
    _, ends = scan.bounds(data, bounds)
    stops = bounds[1:][np.diff(bounds) > 0]
    blank = stops[~scan.inside[data[stops - 1]]] if len(stops) else stops
    ends = np.sort(np.concatenate([ends, blank]))  # a text that ends in white space has a unit more
    return ends, np.searchsorted(ends, bounds, "right")


def cut_frames(ends: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(units, bytes) up to the end of each frame of a text whose units end there."""
    out, at = [], 0
    while at < size:
        k = min(int(np.searchsorted(ends, at + FRAME)), len(ends) - 1)
        at = int(ends[k])
        out.append((k + 1, at))
    return out


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan, press = Scanner("spaced", lower=False), zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for row, end, data, bounds in chunks(batch.column("text")):
            ends, first = unit_ends(scan, data, bounds)
            raw = data.tobytes()
            marked, units, chars, sizes, frames = [], [], [], [], []
            for k in range(end - row):
                a, b = int(bounds[k]), int(bounds[k + 1])
                cuts = cut_frames(ends[first[k]:first[k + 1]] - a, b - a)
                begins = [0, *(at for _, at in cuts[:-1])]
                units.append([n for n, _ in cuts])
                sizes.append([at for _, at in cuts])
                chars.append(np.cumsum([code_points(data[a + x:a + y]) for x, (_, y) in zip(begins, cuts)], dtype=np.int64))
                frames.append([press.compress(raw[a + x:a + y]) for x, (_, y) in zip(begins, cuts)])
                marked.append(any(0 <= raw.find(m, a, b) for m in (PREFIX, SUFFIX, MIDDLE)))
            longs = pa.list_(pa.int64())
            yield pa.record_batch([batch.column("doc_id").slice(row, end - row), pa.array(marked, pa.bool_()), pa.array(units, longs), pa.array(chars, longs), pa.array(sizes, longs), pa.array(frames, pa.list_(pa.binary()))],
                                  names=["doc_id", "marked", "units", "chars", "bytes", "frames"])


def frame_store(docs: DataFrame) -> DataFrame:
    """The texts as frames: doc_id, marked (it holds a marker), and for each frame the units, code points and bytes up to its end.

    ``docs`` has doc_id and text; other columns are ignored.  A null or empty text has no frames.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(texts.mapInArrow(_store, f"doc_id long, marked boolean, {_LISTS}"), "frames", large_rows=True)


class Frames:
    """Frames of one text, read by units or bytes; the last one decompressed is kept."""

    def __init__(self, frames: list[bytes], sizes: list[int], units: list[int] | None = None, chars: list[int] | None = None) -> None:
        self.frames, self.sizes, self.units, self.chars = frames, np.array(sizes, np.int64), units, chars
        self.held: tuple[int, bytes] = (-1, b"")
        self.expand = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            self.held = k, self.expand.decompress(self.frames[k])
        return self.held[1]

    def start(self, k: int) -> int:
        return int(self.sizes[k - 1]) if k else 0

    def after(self, n: int, scan: Scanner) -> tuple[int, int]:
        """(bytes, code points) of the first ``n`` units."""
        k = int(np.searchsorted(self.units, n))
        if n == 0:
            return 0, 0
        if self.units[k] == n:
            return int(self.sizes[k]), self.chars[k]
        raw = np.frombuffer(self.frame(k), np.uint8)
        ends, _ = unit_ends(scan, raw, np.array([0, len(raw)]))
        at = int(ends[n - (self.units[k - 1] if k else 0) - 1])
        return self.start(k) + at, (self.chars[k - 1] if k else 0) + code_points(raw[:at])

    def pieces(self, a: int, b: int) -> Iterator[tuple[int, bytes | None]]:
        """Bytes a to b: (frame, None) for a whole frame, else (frame, the bytes of it)."""
        k = int(np.searchsorted(self.sizes, a, "right"))
        while a < b:
            begin, end = self.start(k), int(self.sizes[k])
            stop = min(end, b)
            yield (k, None) if (a, stop) == (begin, end) else (k, self.frame(k)[a - begin:stop - begin])
            a, k = stop, k + 1

    def read(self, a: int, b: int) -> Iterator[bytes]:
        for k, part in self.pieces(a, b):
            yield self.frame(k) if part is None else part


class Writer:
    """A list of frames made of new bytes and of frames taken over."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.size, self.new = 0, b""
        self.press = zstandard.ZstdCompressor(level=LEVEL)

    def _put(self, frame: bytes, size: int) -> None:
        self.size += size
        self.frames.append(frame)
        self.sizes.append(self.size)

    def close(self) -> None:
        if self.new:
            raw, self.new = self.new, b""
            self._put(self.press.compress(raw), len(raw))

    def add(self, raw: bytes) -> None:
        self.new += raw
        if len(self.new) >= FRAME:
            self.close()

    def copy(self, source: Frames, a: int, b: int) -> None:
        for k, part in source.pieces(a, b):
            size = int(source.sizes[k]) - source.start(k)
            if part is not None or size < FRAME // 4:  # small ones are joined
                self.add(source.frame(k) if part is None else part)
            else:
                self.close()
                self._put(source.frames[k], size)


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers that depend on the seed and the id alone; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at:at + 8], 16) for at in (0, 8, 16, 24)]


def rearranged(source: Frames, marked: bool, h: list[int], scan: Scanner) -> tuple[int, str, int | None, int | None, list[bytes], list[int]]:
    """(units, form, code points of the prefix and of the middle, frames, bytes up to each) of a document."""
    n = source.units[-1] if source.units else 0
    if n == 0 or marked or h[2] % 100 >= REARRANGED:
        return n, "plain", None, None, source.frames, source.sizes.tolist()
    form = "spm" if h[3] % 100 < SUFFIX_FIRST else "psm"
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, a_chars), (b, b_chars) = source.after(low, scan), source.after(high, scan)
    parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, int(source.sizes[-1]))}
    out = Writer()
    for marker in ORDERS[form]:
        out.add(marker)
        out.copy(source, *parts[marker])
    out.close()
    return n, form, a_chars, b_chars - a_chars, out.frames, out.sizes


def _rearrange(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner("spaced", lower=False)
        for batch in batches:
            for k in range(batch.num_rows):
                doc, marked, units, chars, sizes, frames = (batch.column(c)[k].as_py() for c in ("doc_id", "marked", "units", "chars", "bytes", "frames"))
                row = rearranged(Frames(frames, sizes, units, chars), marked, draws(doc, seed), scan)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                yield pa.record_batch([pa.array([x], kind) for x, kind in zip((doc, *row), kinds)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames", "bytes"])

    return run


def infill(store: DataFrame, seed: int = SEED) -> DataFrame:
    """Fill-in-the-middle documents of a frame store: doc_id, n, form, prefix_chars, middle_chars, frames, bytes (up to each frame's end).

    Half of the documents take a form: prefix, middle and suffix end after numbers of units drawn
    from the seed and the id; ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle, each
    behind its marker.  All others, empty texts and those that hold a marker themselves are
    ``plain`` (null lengths).  Rows that repeat an id are cut alike by units, each in its own text.
    """
    return store.mapInArrow(_rearrange(seed), "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames array<binary>, bytes array<long>")


def original(document: Frames, form: str) -> Iterator[bytes]:
    """The text, piece by piece, from a document's frames and form alone."""
    size = int(document.sizes[-1]) if len(document.sizes) else 0
    if form == "plain":
        yield from document.read(0, size)
        return
    places, at, order, tail = {}, 0, list(ORDERS[form]), b""
    for piece in document.read(0, size):  # a marker may lie across two frames
        seen = tail + piece
        begin = at - len(tail)
        while order and (found := seen.find(order[0])) >= 0:
            places[order.pop(0)] = begin + found
            seen, begin = seen[found + len(PREFIX):], begin + found + len(PREFIX)
        tail, at = seen[-(len(PREFIX) - 1):], at + len(piece)
    stops = {marker: end for marker, end in zip(ORDERS[form], [*(places[m] for m in ORDERS[form][1:]), size])}
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from document.read(places[marker] + len(marker), stops[marker])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests: tuple[list[str], list[str]] = [], []
        for k in range(batch.num_rows):
            document = Frames(batch.column("frames")[k].as_py(), batch.column("bytes")[k].as_py())
            whole = document.read(0, int(document.sizes[-1]) if len(document.sizes) else 0)
            for into, stream in zip(digests, (whole, original(document, batch.column("form")[k].as_py()))):
                digest = hashlib.sha256()
                for piece in stream:
                    digest.update(piece)
                into.append(digest.hexdigest())
        yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")), *map(pa.array, digests)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])


def digests(documents: DataFrame) -> DataFrame:
    """Of documents as ``infill`` gives them the digest of each and that of the text rebuilt from it, read frame by frame."""
    return documents.mapInArrow(_digest, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            frames = batch.column("frames")[k].as_py()
            text = b"".join(zstandard.ZstdDecompressor().decompress(x) for x in frames).decode()
            yield pa.record_batch([batch.column("doc_id").slice(k, 1), batch.column("form").slice(k, 1), pa.array([text])], names=["doc_id", "form", "text"])


def texts(documents: DataFrame) -> DataFrame:
    """The documents' texts: doc_id, form, text."""
    return documents.mapInArrow(_join, "doc_id long, form string, text string")
