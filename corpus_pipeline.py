"""A training corpus from ``documents`` in five stages, each a table written in the shared folder and read again.

Every stage works on all that the one before kept; all but the last return the columns of
documents as they came, so extra columns, whatever their names, pass through.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import compress_quality, decontam, langid, minhash, packing
from tidemark.llm.labelled import fold
from tidemark.llm.scratch import drop_paths, recorded, ship, small, stage

#: The stages learn models and follow links, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None

#: Paths of the tables that the last stage staged on its way.
_LEFT: list[str] = []


def _stage(apply):
    """A stage that first deletes what the one before staged on its way, now that its result is written.

    Tables that ``docs`` itself reads stay, so a result that is handed on unwritten is whole too.
    """
    @functools.wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        drop_paths(spark, _LEFT, docs)
        with recorded(_LEFT):
            return apply(spark, docs, sf_dir)

    return run


def _free(name: str, docs: DataFrame) -> str:
    """The name, or a longer one that no column of ``docs`` has in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents whose doc_id is not among the rejected.

    A null doc_id matches nothing and stays; rows that share an id are one document and go
    together.  The rejected ids are written first and counted: up to a million are broadcast, more
    are joined by a shuffle.
    """
    gone = _free("__rejected", docs)
    ids = stage(rejected.select(F.col("doc_id").alias(gone)).filter(F.col(gone).isNotNull()).distinct(), "rejected")
    return docs.join(small(ids), F.col("doc_id").cast("long") == F.col(gone), "left_anti")


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: a document goes if no known language has a posterior of 0.6 or more, or it has no letters."""
    found = langid.identify(langid.of_documents(docs))
    return _without(docs, found.filter("not accepted").select(F.col("id").alias("doc_id")))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: a document goes if its score, trained on the labels of its fold, is under 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = compress_quality.train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    name = _free("__quality_score", docs)
    scored = compress_quality.scored(docs, model, name=name)
    return scored.filter(F.col(name) >= compress_quality.GOOD_AT).drop(name)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each component the smallest doc_id stays."""
    return _without(docs, minhash.near_duplicates(docs).filter("not kept"))


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: a document with a window of a benchmark item goes."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontam.contamination(docs, benchmark).filter("contaminated"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents in sequences of at most 2048 ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language), ("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontaminate), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
