"""Token ids in binary files: Simple-8b words in blocks, with a table of blocks and one of documents.

A 64-bit word holds a selector in its top 4 bits and, below, as many ids of that selector's width
as fit, the first lowest.  The selector ``ESCAPE`` marks a value too wide for any: the next word is
the value itself.  Ids are coded in blocks of ``BLOCK_IDS``; a block starts with a new word, so any
block can be decoded alone, and all words of one selector are unpacked at once.

File: magic; the blocks' words (little-endian); the block table (first word of each block and the
end, 64-bit); the document table (doc_id, a flag for null, ids of the file before it, its ids);
a footer with the sizes of both tables, the number of ids and the magic again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import files
from tidemark.llm.scratch import folder, stage
from tidemark.llm.tokens import encoder

MAGIC = b"TMIDS8B1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25  # a task starts a new file after so many
END = 1             # the id that ends a document
#: Width in bits and number of ids of each selector; the last is the escape.
SELECTORS = ((1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1))
ESCAPE = len(SELECTORS)
_COUNTS = np.array([n for _, n in SELECTORS] + [1])
U64 = np.uint64


def _choices(ids: np.ndarray) -> np.ndarray:
    """For each place the selector that holds most ids from there on."""
    n = len(ids)
    best = np.full(n, ESCAPE, np.int8)
    for selector in range(len(SELECTORS) - 1, -1, -1):
        width, count = SELECTORS[selector]
        if count > n:
            continue
        wide = np.flatnonzero(ids >> U64(width))
        if len(wide) == n:
            continue
        runs = np.diff(np.concatenate([[-1], wide, [n]])) - 1
        if runs.max() < count:
            continue
        if not len(wide):
            best[:n - count + 1] = selector
            continue
        starts = np.concatenate([[0], wide + 1])[runs >= count]
        spans = runs[runs >= count] - count + 1
        best[np.repeat(starts - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())] = selector
    return best


def encode(ids: np.ndarray) -> np.ndarray:
    """The words of one block."""
    ids = np.asarray(ids, U64)
    if not len(ids):
        return np.zeros(0, U64)
    best = _choices(ids)
    step = (np.arange(len(ids)) + _COUNTS[best]).tolist()
    starts, at, n = [], 0, len(ids)
    while at < n:
        starts.append(at)
        at = step[at]
    starts = np.array(starts)
    chosen = best[starts]
    place = np.arange(len(starts)) + np.cumsum(chosen == ESCAPE) - (chosen == ESCAPE)
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), U64)
    for selector, (width, count) in enumerate(SELECTORS):
        own = np.flatnonzero(chosen == selector)
        if len(own):
            packed = np.full(len(own), U64(selector << 60))
            for k in range(count):
                packed |= ids[starts[own] + k] << U64(width * k)
            words[place[own]] = packed
    own = np.flatnonzero(chosen == ESCAPE)
    words[place[own]] = U64(ESCAPE << 60)
    words[place[own] + 1] = ids[starts[own]]
    return words


def decode(words: np.ndarray) -> np.ndarray:
    """The ids of one block's words."""
    if not len(words):
        return np.zeros(0, U64)
    selector = (words >> U64(60)).astype(np.int64)
    if (selector == ESCAPE).any():  # the word after an escape is a value, whatever it looks like
        literal, after = np.zeros(len(words), bool), -1
        for at in np.flatnonzero(selector == ESCAPE).tolist():
            if at != after:
                after = at + 1
                literal[after] = True
        values = words[np.flatnonzero(literal)]
        words, selector = words[~literal], selector[~literal]
    if selector.max() > ESCAPE:
        raise ValueError("unknown selector")
    counts = _COUNTS[selector]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), U64)
    for s, (width, count) in enumerate(SELECTORS):
        own = np.flatnonzero(selector == s)
        if len(own):
            mask = U64((1 << width) - 1)
            for k in range(count):
                out[at[own] + k] = (words[own] >> U64(width * k)) & mask
    own = np.flatnonzero(selector == ESCAPE)
    if len(own):
        out[at[own]] = values
    return out


_DOC = np.dtype([("doc_id", "<i8"), ("null", "<i8"), ("start", "<i8"), ("n", "<i8")])
_FOOTER = struct.Struct("<qqq8s")


class Writer:
    """Writes documents to a stream; ids wait for a whole block."""

    def __init__(self, out) -> None:
        self.out, self.waiting, self.held = out, [], 0
        self.n_ids, self.n_words, self.blocks, self.docs = 0, 0, [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % BLOCK_IDS
        for at in range(0, whole, BLOCK_IDS):
            words = encode(ids[at:min(at + BLOCK_IDS, whole)])
            self.blocks.append(self.n_words)
            self.n_words += len(words)
            self.out.write(words.astype("<u8").tobytes())
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array([*self.blocks, self.n_words], "<i8").tobytes())
        self.out.write(np.array(self.docs, _DOC).tobytes())
        self.out.write(_FOOTER.pack(len(self.blocks), len(self.docs), self.n_ids, MAGIC))


class Reader:
    """Reads a file's tables, and ids of any range by decoding only the blocks that it touches."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        blocks, docs, self.n_ids, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file, or a part of one")
        tables = size - _FOOTER.size - docs * _DOC.itemsize
        self.docs = np.frombuffer(self._at(tables, docs * _DOC.itemsize), _DOC)
        self.blocks = np.frombuffer(self._at(tables - 8 * (blocks + 1), 8 * (blocks + 1)), "<i8")
        self._kept: tuple[int, np.ndarray] = (-1, np.zeros(0, U64))

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        got = self.source.read(size)
        if len(got) != size:
            raise ValueError("the file ends too early")
        return got

    def block(self, k: int) -> np.ndarray:
        if self._kept[0] != k:
            first, end = int(self.blocks[k]), int(self.blocks[k + 1])
            self._kept = k, decode(np.frombuffer(self._at(len(MAGIC) + 8 * first, 8 * (end - first)), "<u8"))
        return self._kept[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        parts = [np.zeros(0, U64)]
        while n > 0:
            k, skip = divmod(start, BLOCK_IDS)
            parts.append(self.block(k)[skip:skip + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return np.concatenate(parts)


_MANIFEST = "file string, part long, number long, n_docs long, n_ids long"


def _write_files(where: str, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer)
        part, number = TaskContext.get().partitionId(), 0

        def documents():
            for batch in batches:
                names = batch.column("doc_id").to_pylist()
                for row, end, ids, bounds in encode_texts(batch.column("text")):
                    for k in range(end - row):
                        yield names[row + k], np.append(ids[bounds[k]:bounds[k + 1]], np.uint32(END))

        source = documents()
        held = next(source, None)
        while held is not None:
            name = f"part-{part:06d}-{number:04d}.ids"
            with files.writing(where, name) as out:
                writer = Writer(out)
                while held is not None and (writer.n_ids < FILE_IDS):
                    writer.add(*held)
                    held = next(source, None)
                writer.close()
            yield pa.record_batch({"file": [f"{where}/{name}"], "part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()), "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})
            number += 1
        encode_texts.forget()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, where: str | None = None) -> DataFrame:
    """Write the ids of all documents, in ascending doc_id order, and return the manifest.

    ``docs`` has doc_id and text (null: empty; other columns are ignored).  Rows are put in order
    by a range shuffle on doc_id (null ids first, ties by text); each task writes one file or more
    and the manifest lists them in order: file, part, number, n_docs, n_ids and the global start.
    Each document ends with ``END``, so an empty one has one id.  An empty table writes no file.
    """
    where = where or folder(docs.sparkSession, "token-files")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stage(ordered.mapInArrow(_write_files(where, tokenizer), _MANIFEST), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with files.opened(row["file"]) as source:
                reader = Reader(source)
                if len(reader.docs) != row["n_docs"] or reader.n_ids != row["n_ids"]:
                    raise ValueError(f"{row['file']} is not the file that was written")
                for at in range(0, len(reader.docs), 4096):
                    docs = reader.docs[at:at + 4096]
                    crc = [zlib.crc32(reader.ids(int(d["start"]), int(d["n"])).astype("<u4").tobytes()) for d in docs]
                    yield pa.record_batch([pa.array(docs["doc_id"], mask=docs["null"] != 0), pa.array(docs["start"] + row["start"]), pa.array(docs["n"].copy()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Read the files of a manifest back, a task for each: doc_id, start, n_tokens and ids_crc32 of every document."""
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(_read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")
