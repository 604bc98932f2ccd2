"""Benchmark decontamination over a positional inverted index stored as Parquet.

The index is cut by documents: a row holds the postings of about ``BLOCK_BYTES`` of text, that is
its sorted terms (64-bit hashes of lower-cased words), how often each occurs and, term after term,
the word positions in the block.  It does not depend on a benchmark and can be asked again.

A phrase is looked up block by block.  Its terms are ordered by the length of their posting lists
in that block; the rarest term's positions, less its offset in the phrase, are the candidate
starts, and each further list, offset-adjusted, is intersected with what is left.  With ``slop``
a term may lie up to that many words from its place (proximity matches).  No posting is shuffled,
so a word that makes up a third of all text costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import stage, tidy
from tidemark.llm.words import U64, Scanner, chunks

WINDOW = 10
BLOCK_BYTES = 2 << 20
QUERY_WORDS = 500_000  # words of items that are broadcast at once; more items are asked in several blocks

_INDEX = "first_slot long, doc_ids array<long>, doc_words array<long>, terms binary, counts binary, positions binary"
_HITS = "slot long, items array<long>, spans array<struct<start:long,end:long>>"


@tidy
def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = Scanner("alnum", lower=True)
    slot = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for row, end, data, bounds in chunks(batch.column("text"), BLOCK_BYTES):
            words = scan(data, bounds)
            order = np.argsort(words.hashes, kind="stable").astype(np.int32)
            terms, counts = np.unique(words.hashes[order], return_counts=True)
            yield pa.record_batch({
                "first_slot": pa.array([slot + row], pa.int64()),
                "doc_ids": pa.array([ids[row:end]], pa.list_(pa.int64())),
                "doc_words": pa.array([words.per_doc()], pa.list_(pa.int64())),
                "terms": pa.array([terms.tobytes()], pa.binary()),
                "counts": pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
                "positions": pa.array([order.tobytes()], pa.binary()),
            })
        slot += len(ids)


def build_index(docs: DataFrame) -> DataFrame:
    """Store the postings of all words of ``docs`` (doc_id, text); null texts have none, null ids stay null."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(texts.mapInArrow(_postings, _INDEX), "postings", large_rows=True)


class Phrases:
    """The distinct windows of a block of items, as indices into the block's distinct terms."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int) -> None:
        owner, grams = [], []
        for item, hashes in items:
            size = min(window, len(hashes))
            for at in range(len(hashes) - size + 1):
                owner.append(item)
                grams.append(hashes[at:at + size])
        self.terms = np.unique(np.concatenate(grams)) if grams else np.zeros(0, U64)
        table = np.full((len(grams), window), -1, np.int32)
        for k, gram in enumerate(grams):
            table[k, :len(gram)] = np.searchsorted(self.terms, gram)
        self.table, which = np.unique(table, axis=0, return_inverse=True) if grams else (table, np.zeros(0, np.int64))
        self.sizes = (self.table >= 0).sum(axis=1)
        pairs = np.unique(np.stack([which.ravel(), np.array(owner, np.int64)]), axis=1) if grams else np.zeros((2, 0), np.int64)
        self.items = pairs[1]
        self.first_item = np.searchsorted(pairs[0], np.arange(len(self.table) + 1))

    def find(self, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of the matches in one block's postings, document bounds apart."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.terms) or not len(terms):
            return none
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        length = np.where(terms[at] == self.terms, counts[at], 0).astype(np.int64)
        phrase = np.flatnonzero((np.where(self.table >= 0, length[self.table], 1) > 0).all(axis=1))
        if not len(phrase):
            return none
        lists = np.concatenate([[0], np.cumsum(counts)])
        there = np.unique(self.table[phrase])
        there = there[there >= 0]
        held = np.full(len(positions) + 2 * slop, -1, np.int32)  # which asked term is at a position
        for term in there.tolist():
            held[positions[lists[at[term]]:lists[at[term] + 1]] + slop] = term
        rank = np.argsort(np.where(self.table[phrase] >= 0, length[self.table[phrase]], np.iinfo(np.int64).max), axis=1, kind="stable")
        rarest = self.table[phrase, rank[:, 0]]
        many = length[rarest]
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = positions[np.repeat(lists[at[rarest]], many) + offset].astype(np.int64) - np.repeat(rank[:, 0], many)
        row = np.repeat(np.arange(len(phrase)), many)
        inside = (start >= 0) & (start + self.sizes[phrase[row]] <= len(positions))
        row, start = row[inside], start[inside]
        for k in range(1, self.table.shape[1]):
            place = rank[row, k]
            term = self.table[phrase[row], place]
            near = term < 0
            for shift in range(2 * slop + 1):
                near |= held[np.minimum(start + place + shift, len(held) - 1)] == term
            row, start = row[near], start[near]
        return phrase[row], start


def _matcher(shared, slop: int):
    @tidy
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = shared.value
        for batch in batches:
            for block in batch.to_pylist():
                terms, counts, positions = (np.frombuffer(block[k], kind) for k, kind in (("terms", U64), ("counts", np.int32), ("positions", np.int32)))
                which, start = phrases.find(terms, counts, positions, slop)
                first = np.concatenate([[0], np.cumsum(block["doc_words"])])
                doc = np.searchsorted(first, start, "right") - 1
                stop = start + phrases.sizes[which]
                whole = stop <= first[doc + 1] if len(doc) else np.zeros(0, bool)
                which, start, stop, doc = which[whole], start[whole], stop[whole], doc[whole]
                if not len(doc):
                    continue
                slots, items, spans = [], [], []
                order = np.lexsort((start, doc))
                for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
                    d = doc[part[0]]
                    slots.append(block["first_slot"] + int(d))
                    items.append(np.unique(np.concatenate([phrases.items[phrases.first_item[w]:phrases.first_item[w + 1]] for w in np.unique(which[part])])))
                    reach = np.maximum.accumulate(stop[part])
                    cut = np.flatnonzero(start[part][1:] > reach[:-1])
                    begins, ends = start[part][np.concatenate([[0], cut + 1])], reach[np.concatenate([cut, [len(part) - 1]])]
                    spans.append([{"start": int(b - first[d]), "end": int(e - first[d])} for b, e in zip(begins, ends)])
                yield pa.record_batch([pa.array(slots, pa.int64()), pa.array(items, pa.list_(pa.int64())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["slot", "items", "spans"])

    return match


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = Scanner("alnum", lower=True)
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        for row, end, data, bounds in chunks(batch.column("text")):
            words = scan(data, bounds)
            yield pa.record_batch([pa.array(ids[row:end], pa.int64()), pa.array([words.hashes[a:b].view(np.int64) for a, b in zip(words.first[:-1], words.first[1:])], pa.list_(pa.int64()))], names=["item_id", "words"])


def _query_blocks(benchmark: DataFrame, window: int) -> Iterator[Phrases]:
    """Items streamed to the driver and handed on ``QUERY_WORDS`` at a time; a longer item is cut with overlap."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null and text is not null")
    held, size = [], 0
    for row in items.mapInArrow(_item_words, "item_id long, words array<long>").toLocalIterator():
        words = np.array(row.words, np.int64).view(U64)
        for at in range(0, max(len(words) - window, 0) + 1, QUERY_WORDS):
            piece = words[at:at + QUERY_WORDS + window - 1]
            if size and size + len(piece) > QUERY_WORDS:
                yield Phrases(held, window)
                held, size = [], 0
            if len(piece):
                held.append((row.item_id, piece))
                size += len(piece)
    if held:
        yield Phrases(held, window)


def matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Documents of an index with matches: (slot, items, spans), spans merged and in words of the document."""
    spark = index.sparkSession
    found = None
    for phrases in _query_blocks(benchmark, window):
        part = index.mapInArrow(_matcher(spark.sparkContext.broadcast(phrases), slop), _HITS)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], _HITS)
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))), F.array().cast("array<struct<start:long,end:long>>"),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(done, F.array(x))),
    )
    return found.groupBy("slot").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), merged.alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    A word is hit if it lies in an occurrence of a window of ``window`` consecutive words of an
    item; a shorter item is one window; an item without words, with a null text or a null id is
    none.  Null, empty and word-less documents have no words and no hits.  Rows repeating a
    doc_id, and rows with a null one, each get a row.  Items that share an id count once.  An empty
    benchmark gives no hits, an empty table no rows.  Other columns are ignored.
    """
    index = build_index(docs)
    rows = index.select("first_slot", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("at", "doc"))
    rows = rows.select((F.col("first_slot") + F.col("at")).alias("slot"), F.col("doc.doc_ids").alias("doc_id"), F.col("doc.doc_words").alias("n_words"))
    hits = matches(index, benchmark, window, slop)
    none = F.array().cast("array<long>")
    out = rows.join(hits, "slot", "left").withColumn("items", F.coalesce("items", none))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]), F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "items", "spans")
