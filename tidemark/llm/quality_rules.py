"""Quality rules: counts over whole texts and a hashed n-gram logistic regression.

The regression sees words, word pairs and character 3- and 4-grams, each hashed into ``BUCKETS``
buckets.  A feature is the share of a text's n-grams of that kind that fall into a bucket, so a
score is a mean of weights over the text's n-grams and is read off in one pass over the Arrow
buffers.  It is trained on labelled quality rows, calibrated on labelled rows held back from that,
and compared with a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.labelled import logistic, sample, sigmoid, verdicts
from tidemark.llm.scratch import stage
from tidemark.llm.words import U64, Scanner, chunks, mix, ngrams

BITS = 15
BUCKETS = 1 << BITS      # for each kind of n-gram
KINDS = 4                # words, word pairs, character 3-grams, character 4-grams
PER_CLASS = 3000         # labelled rows of each class that are learnt from at most: two thirds for weights, the rest for calibration
KEEP_AT = 0.3            # calibrated probability of good quality from which a document is kept
MIN_WORDS = 50
MOST_REPEATED = 50       # per cent of the words
SCALE = 30.0             # of the features, so that one step size fits all
STEPS, RATE, RIDGE = 150, 0.3, 2e-4

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SHIFT32 = np.uint32(32 - BITS)


def characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character of UTF-8 texts laid end to end (its lead byte followed by 6 bits of each other byte), and the texts' bounds in characters."""
    if not (data >= 0x80).any():
        return data, bounds
    at = np.flatnonzero((data & 0xC0) != 0x80)
    out = data[at].astype(np.uint32)
    for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        longer = np.flatnonzero(data[at] >= least)
        out[longer] = (out[longer] << np.uint32(6)) | (data[at[longer] + k] & 0x3F)
    return out, np.searchsorted(at, bounds)


def _character_grams(values: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n characters from each place on; as many as there are places."""
    if len(values) < n:
        return np.zeros(0, np.uint32)
    out = np.zeros(len(values) - n + 1, np.uint32)
    for k in range(n):
        out = (out + values[k:len(values) - n + 1 + k]) * np.uint32(0x9E3779B1)
    return out >> _SHIFT32


def _kinds(data: np.ndarray, bounds: np.ndarray, words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of n-gram: buckets, and the first and end n-gram of each document."""
    shift = U64(64 - BITS)
    for n in (1, 2):
        grams = words.hashes if n == 1 else ngrams(words.hashes, 2)
        first, end = words.first[:-1], words.first[1:] - n + 1
        yield (grams >> shift).astype(np.int64), first, np.maximum(first, end)
    values, bounds = characters(data, bounds)
    for n in (3, 4):
        first, end = bounds[:-1], bounds[1:] - n + 1
        yield _character_grams(values, n), first, np.maximum(first, end)


def _means(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    top = len(total) - 1
    return (total[np.minimum(end, top)] - total[np.minimum(first, top)]) / np.maximum(1, end - first)


def margins(data: np.ndarray, bounds: np.ndarray, words, weights: np.ndarray) -> np.ndarray:
    """The regression's value for each document of a chunk, without its intercept."""
    return SCALE * sum(_means(weights[k * BUCKETS:(k + 1) * BUCKETS][grams], first, end) for k, (grams, first, end) in enumerate(_kinds(data, bounds, words)))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = Scanner("spaced", lower=True)
    for batch in batches:
        for row, stop, data, bounds in chunks(batch.column("text")):
            kinds = list(_kinds(data, bounds, scan(data, bounds)))
            at, share = [], []
            for d in range(stop - row):
                parts = [np.unique(grams[first[d]:end[d]].astype(np.int64) + k * BUCKETS, return_counts=True) for k, (grams, first, end) in enumerate(kinds)]
                at.append(np.concatenate([b for b, _ in parts]).astype(np.int32))
                share.append(np.concatenate([SCALE * n / max(1, n.sum()) for _, n in parts]).astype(np.float32))
            out = batch.slice(row, stop - row)
            yield pa.record_batch([out.column("doc_id"), out.column("y"), out.column("rank"), pa.array(at, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))], names=["doc_id", "y", "rank", "at", "share"])


def _fit(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Weights, intercept and calibration from the bounded sample: full-batch Adam, then a logistic fit of the margins of the rest."""
    rows = rows.sort_values(["rank", "doc_id"], ignore_index=True)
    learn = (rows["rank"] % 3 != 0).to_numpy()
    y = rows.y.to_numpy(float)
    if len(set(y[learn])) < 2 or len(set(y[~learn])) < 2:
        return pd.DataFrame({"weights": [None], "scale": [0.0], "shift": [0.0]})

    def matrix(part: pd.DataFrame):
        at, share = np.concatenate(part["at"].to_list()), np.concatenate(part.share.to_list())
        return at, share, np.repeat(np.arange(len(part)), part["at"].str.len())

    def product(m, w):
        return np.bincount(m[2], m[1] * w[m[0]], int(m[2].max()) + 1 if len(m[2]) else 0)

    m, target = matrix(rows[learn]), y[learn]
    n, weigh = int(learn.sum()), np.where(target == 1, 0.5 / target.sum(), 0.5 / (1 - target).sum())
    w, bias = np.zeros(KINDS * BUCKETS), 0.0
    mean, square, bias_mean, bias_square = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = np.zeros(n)
        part = product(m, w)
        z[:len(part)] = part
        miss = (sigmoid(z + bias) - target) * weigh
        slope = np.bincount(m[0], m[1] * miss[m[2]], len(w)) + RIDGE * w
        rate = RATE * (1 - t / (STEPS + 1))
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        w -= rate * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-4)
        bias_mean, bias_square = 0.9 * bias_mean + 0.1 * miss.sum(), 0.99 * bias_square + 0.01 * miss.sum() ** 2
        bias -= rate * (bias_mean / (1 - 0.9 ** t)) / (np.sqrt(bias_square / (1 - 0.99 ** t)) + 1e-4)
    held = matrix(rows[~learn])
    z = np.zeros(int((~learn).sum()))
    part = product(held, w)
    z[:len(part)] = part
    scale, shift = logistic(z[:, None], y[~learn], ridge=1e-2)
    return pd.DataFrame({"weights": [w.astype(np.float32).tobytes()], "scale": [scale], "shift": [shift]})


def train(docs: DataFrame, labels: DataFrame):
    """(weights, scale, shift) of the calibrated regression, or None without labelled rows of both classes."""
    chosen = sample(verdicts(labels, "quality"), PER_CLASS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "rank", "text")
    rows = stage(rows.mapInArrow(_sparse, "doc_id long, y int, rank long, at array<int>, share array<float>"), "labelled")
    fits = rows.groupBy(F.lit(0).alias("one")).applyInPandas(_fit, "weights binary, scale double, shift double").collect()
    if not fits or fits[0].weights is None:
        return None
    return np.frombuffer(bytes(fits[0].weights), np.float32), fits[0].scale, fits[0].shift


def _duplicate_lines(data: np.ndarray, bounds: np.ndarray, lines: Scanner, inside: np.ndarray) -> np.ndarray:
    """Per document the lines that have a word and equal an earlier line."""
    found = lines(data, bounds)  # an empty line is no run, and has no word either
    words = np.concatenate([[0], np.cumsum(inside)])
    has_word = words[found.ends] > words[found.starts]
    doc = np.repeat(np.arange(len(bounds) - 1), found.per_doc())[has_word]
    keys = mix(found.hashes[has_word] + mix(doc.astype(U64) + U64(1)))
    _, lead = np.unique(keys, return_index=True)
    n = len(bounds) - 1
    return np.bincount(doc, minlength=n) - np.bincount(doc[lead], minlength=n)


def _repeated_words(words, n: int = 3) -> np.ndarray:
    """Per document the words in ``n``-word windows that occur twice or more in it."""
    docs = len(words.first) - 1
    runs = ngrams(words.hashes, n)
    doc = np.repeat(np.arange(docs), words.per_doc())
    if not len(runs):
        return np.zeros(docs, np.int64)
    at = np.flatnonzero(doc[:len(runs)] == doc[n - 1:])
    keys = mix(runs[at] + mix(doc[at].astype(U64) + U64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(doc), bool)
    for k in range(n):
        covered[at[again] + k] = True
    return np.bincount(doc[covered], minlength=docs)


def _rules(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, lines = Scanner("spaced", lower=True), Scanner("spaced", lower=False)
        lines.inside = np.ones(256, bool)
        lines.inside[0x0A] = False
        exact = Scanner("spaced", lower=False)
        fitted = model.value
        for batch in batches:
            for row, stop, data, bounds in chunks(batch.column("text")):
                n = stop - row
                words, folded = exact(data, bounds), scan(data, bounds)
                inside = exact.inside[data]
                per_doc = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])
                counts = [words.per_doc(), per_doc(inside & ((data & 0xC0) != 0x80)), per_doc(_SYMBOL[data]), _duplicate_lines(data, bounds, lines, inside), _repeated_words(words)]
                n_words, repeated = counts[0], counts[4]
                failed = (n_words < MIN_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
                if fitted is None:
                    probability = np.full(n, np.nan)
                else:
                    probability = sigmoid(fitted[1] * margins(data, bounds, folded, fitted[0]) + fitted[2])
                kept = ~failed & ~(probability < KEEP_AT)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(row, n), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(failed), pa.array(kept), pa.array(probability, mask=np.isnan(probability))],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"])

    return run


_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the five counts, base_failed, kept and the calibrated probability of good quality.

    Words are split at white space and compared as they are.  base_failed: fewer than 50 words, or
    over half of them in repeated 3-word windows; such a document is not kept.  Any other is kept
    unless its probability is under 0.3.  Null and empty texts have no words and fail.  Without
    labelled rows of both classes the probability is null and the base rules alone decide.  Rows
    repeating an id, or with a null one, each get a row; contradicting labels are not learnt from;
    an empty table gives no rows; other columns are ignored.
    """
    model = train(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_rules(docs.sparkSession.sparkContext.broadcast(model)), _SCHEMA)
