"""Quality by compression: two Zstandard dictionaries, one of good and one of bad labelled text.

A text that the bad dictionary compresses better than the good one looks like bad text.  The size
differences, normalised by the text's length and by the compressed sizes, the compression ratio
and, as short texts say less, the length go through a logistic calibration fitted on labelled rows that neither dictionary has
seen.  Labels are used from the training fold only; nothing but the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.labelled import fold, logistic, sample, sigmoid, verdicts
from tidemark.llm.scratch import stage, tidy

PER_CLASS = 4000        # labelled rows of each class that are learnt from at most: half for the dictionaries, half for calibration
PIECE, PIECES = 4096, 4  # pieces of a sampled text that a dictionary is built from: so many of so many bytes, evenly spread
DICTIONARY = 112_640
LEVEL = 3
GOOD_AT = 0.3


def _pieces(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    cuts = [raw[at:at + PIECE] for at in range(0, len(raw), PIECE)]
    keep = cuts if len(cuts) <= PIECES else [cuts[i * (len(cuts) - 1) // (PIECES - 1)] for i in range(PIECES)]
    return [p for p in keep if p]


def _dictionary(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    pieces = [p for text in rows.sort_values(["rank", "doc_id"]).text for p in _pieces(text)]
    try:
        built = zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its end serves as a plain prefix
        built = b"".join(pieces)[-DICTIONARY:]
    return pd.DataFrame({"y": [key[0]], "dictionary": [built]})


class Sizes:
    """Features of a text: what the two dictionaries make of it."""

    def __init__(self, bad: bytes, good: bytes) -> None:
        self.both = [self._compressor(x) for x in (bad, good)]

    @staticmethod
    def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(raw)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, column: pa.Array) -> np.ndarray:
        sizes = np.ones((len(column), 3))
        for k, text in enumerate(column.cast(pa.binary())):
            raw = text.as_buffer() if text.is_valid else b""
            sizes[k] = *(len(c.compress(raw)) for c in self.both), max(1, len(raw))
        bad, good, n = sizes.T
        per_byte, relative, ratio = 20 * (bad - good) / n, 5 * (bad - good) / (bad + good), np.minimum(2.0, (bad + good) / (2 * n))
        short = np.exp(-n / 300)  # of a short text the differences say less
        return np.column_stack([
            per_byte, relative, 4 * ratio, per_byte * ratio, 4 * ratio ** 2, per_byte ** 2, relative ** 2,
            short, short * per_byte, short * relative, 4 * short * ratio, np.log(n) / 5,
        ])


def _features(dictionaries):
    @tidy
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(*dictionaries.value)
        for batch in batches:
            yield pa.record_batch([batch.column("y"), pa.array(list(sizes(batch.column("text"))), pa.list_(pa.float64()))], names=["y", "x"])

    return measure


def _score(model, text: str, name: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good, weights = model.value
        sizes = Sizes(bad, good) if weights is not None else None
        for batch in batches:
            if weights is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                score = sigmoid(sizes(batch.column(text)) @ weights[:-1] + weights[-1])
            yield pa.record_batch([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return run


def train(docs: DataFrame, labels: DataFrame, training=None):
    """(bad dictionary, good dictionary, calibration weights); weights are None unless both classes have rows.

    ``training`` is a condition on doc_id that labelled rows must meet to be learnt from.
    """
    known = verdicts(labels, "quality")
    chosen = sample(known if training is None else known.filter(training), PER_CLASS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
    half = F.pmod(F.col("rank"), F.lit(2))
    built = {r.y: bytes(r.dictionary) for r in rows.filter(half == 0).groupBy("y").applyInPandas(_dictionary, "y int, dictionary binary").collect()}
    if any(not built.get(y) for y in (0, 1)):
        return b"", b"", None
    shared = docs.sparkSession.sparkContext.broadcast((built[0], built[1]))
    fit = rows.filter(half == 1).select("y", "text").mapInArrow(_features(shared), "y int, x array<double>").toPandas()
    if fit.y.nunique() < 2:
        return b"", b"", None
    return built[0], built[1], logistic(np.stack(fit.x), fit.y.to_numpy(float))


def scored(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and then the score, which replaces a column of its name; the text column comes out as a string."""
    kept = docs.drop(name).withColumn(text, F.col(text).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept.mapInArrow(_score(shared, text, name), T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts compress to next to nothing and get the score that the calibration gives
    that; without labelled rows of both classes every score is 0.5.  Rows repeating an id and rows
    with a null one (held_out null) are each scored; labels that contradict each other are not
    learnt from; an empty table gives no rows.  Other columns are ignored, whatever their names.
    """
    model = train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted"))
