"""Packing documents into training sequences by non-negative least squares.

Documents are taken in runs of about ``RUN_IDS`` ids of one task.  What fills whole windows is cut off; of the
rest, lengths fall into ``CLASSES`` classes and make a histogram.  The shallow combinations of
classes that fill a window exactly (at most ``DEPTH`` of them together) are enumerated once; how
often to use each is the non-negative least-squares solution against the histogram, rounded down.
What is left over fills the gaps of those sequences (small documents whole, others cut) and then
sequences of its own, so that only the last sequence of a run has more than a few ids of padding.
Runs are packed independently: nothing is shuffled, and no task sees more than its own run.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.simple8b import END
from tidemark.llm.tokens import encoder

WINDOW = 2048
CLASSES = 32
DEPTH = 4
RUN_IDS = 1 << 21
ENCODED = 1 << 20  # bytes of text that are encoded together
LEAST = 16  # a gap of fewer ids is padded rather than filled by a cut

Piece = tuple[int, int, int]  # document, first id, ids


@functools.cache
def combinations(total: int = CLASSES, depth: int = DEPTH) -> tuple[tuple[int, ...], ...]:
    """Descending tuples of at most ``depth`` classes that add up to ``total``."""
    def extend(left: int, most: int, room: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif room:
            for part in range(min(left, most), 0, -1):
                for rest in extend(left - part, part, room - 1):
                    yield (part, *rest)

    return tuple(extend(total, total, depth))


@functools.cache
def _uses() -> np.ndarray:
    """How often each combination (column) uses each class (row)."""
    out = np.zeros((CLASSES, len(combinations())))
    for k, parts in enumerate(combinations()):
        for part in parts:
            out[part - 1, k] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active-set search: columns enter by steepest descent and leave at zero."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        enter = int(slope.argmax())
        if slope[enter] <= tolerance * max(1.0, np.abs(b).max()):
            return x
        free[enter] = True
        while True:
            trial = np.zeros_like(x)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (trial <= 0)
            if not low.any():
                x = trial
                break
            part = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + part * (trial - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


def plan(lengths: np.ndarray, window: int = WINDOW) -> list[list[Piece]]:
    """Sequences of pieces that hold every id of documents of these lengths once."""
    out: list[list[Piece]] = [[(d, k * window, window)] for d, n in enumerate(lengths.tolist()) for k in range(n // window)]
    rest = lengths % window
    items = np.flatnonzero(rest)
    if not len(items):
        return out
    width = window / CLASSES
    order = items[np.argsort(rest[items], kind="stable")]
    classes = np.ceil(rest[order] / width).astype(int)
    stock = [order[classes == c].tolist() for c in range(CLASSES + 1)]
    histogram = np.array([len(s) for s in stock[1:]], float)
    times = nnls(_uses(), histogram)
    size = rest.tolist()
    start = (lengths - rest).tolist()
    packed: list[list[int]] = []
    for k in np.argsort(-times, kind="stable").tolist():
        parts = combinations()[k]
        if times[k] < 1:
            break
        n = min(int(times[k] + 1e-6), *(len(stock[c]) // parts.count(c) for c in set(parts)))
        packed += [[stock[c].pop() for c in parts] for _ in range(n)]
    left = sorted((d for s in stock for d in s), key=lambda d: (size[d], d))
    gaps = [window - sum(size[d] for d in own) for own in packed]
    need, have = sum(g for g in gaps if g >= LEAST), sum(size[d] for d in left)
    while packed and have + window < need:  # too little left to fill the gaps: undo some
        own, gap = packed.pop(), gaps.pop()
        need -= gap if gap >= LEAST else 0
        have += sum(size[d] for d in own)
        left += own
    left.sort(key=lambda d: (size[d], d))
    sequences = [[(d, start[d], size[d]) for d in own] for own in packed]
    sizes = [size[d] for d in left]
    for k in sorted(range(len(sequences)), key=lambda k: -gaps[k]):  # whole documents into gaps, best fit
        while sizes and gaps[k] >= sizes[0]:
            at = bisect.bisect_right(sizes, gaps[k]) - 1
            d = left.pop(at)
            gaps[k] -= sizes.pop(at)
            sequences[k].append((d, start[d], size[d]))
    stream = [(d, start[d], size[d]) for d in left]  # the longest is last, and is cut first

    def cut(room: int) -> list[Piece]:
        got = []
        while room and stream:
            d, at, n = stream.pop()
            got.append((d, at, min(n, room)))
            if n > room:
                stream.append((d, at + room, n - room))
            room -= got[-1][2]
        return got

    for k in sorted(range(len(sequences)), key=lambda k: -gaps[k]):
        if gaps[k] >= LEAST:
            sequences[k] += cut(gaps[k])
    while stream:
        sequences.append(cut(window))
    return out + sequences


def _packer(tokenizer: str, window: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        names, docs, held = [], [], 0

        def planned() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for pieces in plan(np.array([len(d) for d in docs]), window):
                offset = 0
                for d, start, n in pieces:
                    rows.append((names[d], start, n, zlib.crc32(docs[d][start:start + n].astype("<u4").tobytes()), len(docs[d]), sequence, offset, docs[d][start:start + n] if with_ids else None))
                    offset += n
                sequence += 1
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES[:len(kinds)])

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for row, end, ids, bounds in encode_texts(batch.column("text"), ENCODED):
                names += ids_of[row:end]
                docs += [np.append(ids[a:b], np.uint32(END)) for a, b in zip(bounds[:-1], bounds[1:])]
                held += len(ids) + end - row
                if held >= RUN_IDS:
                    yield planned()
                    names, docs, held = [], [], 0
        if docs:
            yield planned()
        encode_texts.forget()

    return run


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text), a row each; ``with_ids`` adds the ids themselves.

    Columns: doc_id, start (ids of the document before it), length, ids_crc32, doc_tokens (with
    the end id), sequence_id (unique, not dense), offset (in the sequence, gapless from 0).  A
    sequence holds at most ``window`` ids.  Null and empty texts are one end id; rows repeating an
    id, or with a null one, are documents of their own; an empty table gives no rows; other columns
    are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"{n} long" for n in _NAMES[:-1]) + (", ids array<int>" if with_ids else "")
    return texts.mapInArrow(_packer(tokenizer, window, with_ids), schema)
