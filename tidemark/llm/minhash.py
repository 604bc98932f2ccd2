"""Near-duplicate documents: one-permutation hashing, banded buckets and star-shaped candidate edges.

1. One pass over the texts makes each document's set of shingle hashes and, from it, a sketch:
   the hash space is cut into ``BINS`` bins, each keeps its smallest hash, and an empty bin
   borrows from the first non-empty bin of its own fixed random order (optimal densification).
2. Documents with the same set form a class; only one row of it goes on.
3. Bands of ``ROWS`` bins are bucket keys.  A sketch says little about a small set, so one of at
   most ``SMALL`` shingles has further keys: its smallest hashes, so many that two similar sets of
   that size must share one.  Per bucket only the star (smallest member, other) is proposed, so a
   bucket of n documents gives n - 1 pairs.  Stars whose sketches agree enough are confirmed on the
   full shingle sets, and confirmed links give first components.
4. A star can miss a link between two members that are both unlike its centre.  So buckets whose
   other members still lie in different components are looked at again: those outside the bucket's
   largest component, in blocks of at most ``BLOCK``, against all members.  Pairs from different
   components whose sketches agree enough are tested on the full sets inside the task; only links
   leave it, never a bucket's pairs.

With 32 bands of 4 bins a pair at similarity 0.75 shares no bucket with probability 5e-6; pairs
whose smaller set has at most ``SMALL`` * 0.75 shingles always share one.  The sketch test asks for an
agreement of 0.57, 4.7 standard deviations below 0.75, and is left out where the smaller set has
fewer than ``TESTED`` shingles.  A sketch holds 8 bits a bin, which only ever adds agreement.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import drop, small, stage, tidy, tidy_group
from tidemark.llm.words import U64, Scanner, chunks, mix, ngrams

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
BLOCK = 256
AGREE = 0.57
TESTED = 64  # shingles from which on a sketch may rule a pair out
SMALL = 32
SHINGLE = 5
SIMILAR = 75  # per cent of the union

#: The order in which an empty bin looks at the others.
_ORDER = np.stack([np.random.default_rng(1000 + i).permutation(BINS) for i in range(BINS)])


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; fewer than ``n`` words make one shingle, none make none."""
    scan = Scanner("spaced", lower=True)
    for _, _, data, bounds in chunks(column):
        words = scan(data, bounds)
        runs = ngrams(words.hashes, n)
        for at, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if end - at >= n:
                yield np.unique(runs[at:end - n + 1])
            elif end > at:
                yield ngrams(words.hashes[at:end], end - at)
            else:
                yield np.zeros(0, U64)


def sketch(values: np.ndarray) -> np.ndarray:
    """``BINS`` 32-bit values of a non-empty sorted set of 64-bit hashes."""
    shift = U64(64 - BINS.bit_length() + 1)
    bins = (values >> shift).astype(np.int64)
    lead = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = np.zeros(BINS, bool)
    filled[bins[lead]] = True
    out = np.zeros(BINS, np.uint32)
    out[bins[lead]] = (values[lead] >> (shift - U64(32))).astype(np.uint32)
    if len(lead) < BINS:
        empty = np.flatnonzero(~filled)
        order = _ORDER[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.astype(U64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=U64)
    for k in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.view(np.int64)


def small_keys(values: np.ndarray) -> np.ndarray:
    """Of a small sorted set the smallest hashes: two sets of at least ``SIMILAR`` per cent share one of them."""
    n = len(values)
    if n > SMALL:
        return np.zeros(0, np.int64)
    return mix(values[:n - -(-SIMILAR * n // 100) + 1] * U64(0x9E3779B97F4A7C15)).view(np.int64)


def set_id(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


_SKETCH = "doc_id long, n_shingles long, set_id binary, bands array<long>, sketch binary, marks binary"
_SETS = "set_id binary, shingles array<long>"


@tidy
def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bands`` are the bucket keys, ``sketch`` 8 bits of each bin and ``marks`` 32 bits of each band's key."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()), ("marks", pa.binary())])
    for batch in batches:
        rows = []
        for values in shingle_sets(batch.column("text")):
            if len(values):
                signature = sketch(values)
                keys = band_keys(signature)
                rows.append((len(values), set_id(values), np.concatenate([keys, small_keys(values)]), signature.astype(np.uint8).tobytes(), keys.astype(np.uint32).tobytes()))
            else:
                rows.append((0, None, None, None, None))
        columns = zip(*rows) if rows else ([] for _ in range(5))
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(list(c), kind) for c, kind in zip(columns, schema.types[1:]))], schema=schema)


@tidy
def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("set_id", pa.binary()), ("shingles", pa.list_(pa.int64()))])
    for batch in batches:
        ids, held, size = [], [], 0
        for values in shingle_sets(batch.column("text")):
            if len(values):
                ids.append(set_id(values))
                held.append(values.view(np.int64))
            size += len(values)
            if size > 1 << 20:
                yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(held, pa.list_(pa.int64()))], schema=schema)
                ids, held, size = [], [], 0
        if ids:
            yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(held, pa.list_(pa.int64()))], schema=schema)


@tidy
def _own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full sets of texts whose rep is known."""
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    for batch in batches:
        held, done, size = [], 0, 0
        for values in shingle_sets(batch.column("text")):
            held.append(values.view(np.int64))
            size += len(values)
            if size > 1 << 20:
                yield pa.record_batch([batch.column("rep").slice(done, len(held)), pa.array(held, pa.list_(pa.int64()))], schema=schema)
                held, done, size = [], done + len(held), 0
        if held:
            yield pa.record_batch([batch.column("rep").slice(done), pa.array(held, pa.list_(pa.int64()))], schema=schema)


@tidy
def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sketches agree in a share of at least ``AGREE`` of their bins, and those of small sets; not those whose sizes alone rule them out."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("of_a", "of_b"))
        sizes = np.stack([batch.column(c).to_numpy() for c in ("n_a", "n_b")])
        least, most = sizes.min(axis=0), sizes.max(axis=0)
        near = (((left == right).mean(axis=1) >= AGREE) | (least < TESTED)) & (100 * least >= SIMILAR * most)
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _unlinked(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Pairs (places in ``rows``) of a left and a right member that need a test: other components, sketches that agree enough.

    A pair that shares several bands is taken up only in the first of them; one that shares keys of
    small sets only, in each of these.  Of two members that both stand left too, the one with the smaller number leads.
    """
    sketches, marks = (np.frombuffer(b"".join(rows[c]), kind).reshape(len(rows), -1) for c, kind in (("sketch", np.uint8), ("marks", np.uint32)))
    label, rep, size, main, band = rows.label.to_numpy(), rows.rep.to_numpy(), rows.n_shingles.to_numpy(), rows.main.to_numpy(), int(rows.band.iloc[0])
    right = np.flatnonzero(~rows.left.to_numpy())
    for k in np.flatnonzero(rows.left.to_numpy()).tolist():
        other = right[(label[right] != label[k]) & ((label[right] == main[right]) | (rep[right] > rep[k]))]
        least, most = np.minimum(size[other], size[k]), np.maximum(size[other], size[k])
        near = (((sketches[other] == sketches[k]).mean(axis=1) >= AGREE) | (least < TESTED)) & (100 * least >= SIMILAR * most)
        other = other[near]
        same = marks[other] == marks[k]
        first = np.where(same.any(axis=1), same.argmax(axis=1), BANDS)
        for other_k in other[first == min(band, BANDS)].tolist():
            yield k, other_k


def _once(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.drop_duplicates(["rep", "left"]).sort_values(["rep", "left"], ignore_index=True)


@tidy_group
def _to_test(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The members of a pair of blocks that have a pair to test."""
    rows = _once(rows)
    found = np.unique(np.array(list(_unlinked(rows)), np.int64))
    return rows.iloc[found]


@tidy_group
def _tested(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a pair of blocks, confirmed on the full sets; none between members that others of them connect."""
    rows = _once(rows)
    sets = rows.shingles.to_list()
    joined = {x: x for x in rows.label}

    def root(x: int) -> int:
        while joined[x] != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    links = []
    for k, other in _unlinked(rows):
        a, b = root(rows.label[k]), root(rows.label[other])
        if a == b:
            continue
        left, right = sets[k], sets[other]
        shared = len(np.intersect1d(left, right, assume_unique=True))
        if 100 * shared >= SIMILAR * (len(left) + len(right) - shared):
            links.append((rows.rep[k], rows.rep[other]))
            joined[max(a, b)] = min(a, b)
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _only(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``table`` whose rep is in ``rows``: while these are few, no others are shuffled by a later join."""
    return table.join(small(stage(rows.select("rep").distinct(), "reps")), "rep", "left_semi")


def _sets(texts: DataFrame, sketches: DataFrame, wanted: DataFrame) -> DataFrame:
    """The full sets of ``wanted`` (rep, set_id, doc_id), each once: (rep, shingles).

    A text whose id is its own gets its rep by the id, before its set is made, so that sets are not
    shuffled.  Texts of an id that several rows have are told apart by their sets.
    """
    ids = small(wanted.select("doc_id").distinct())
    again = stage(sketches.select("doc_id").join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "again")
    repeated = small(again)
    own = stage(wanted.join(repeated, "doc_id", "left_anti").select("doc_id", "rep"), "own")
    sets = texts.join(small(own), "doc_id").select("rep", "text").mapInArrow(_own_sets, "rep long, shingles array<long>")
    if again.isEmpty():
        return sets
    others = texts.join(repeated, "doc_id", "left_semi").mapInArrow(_full_sets, _SETS)
    others = others.join(wanted.join(repeated, "doc_id", "left_semi").select("set_id", "rep"), "set_id")
    return sets.union(others.dropDuplicates(["rep"]).select("rep", "shingles"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets have at least ``SIMILAR`` per cent of their union in common."""
    # the side of b first: a is the centre of many pairs, and only its own set joins them all
    with_b = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = with_b.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    return both.select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("sizes")).filter(100 * F.col("shared") >= SIMILAR * (F.col("sizes") - F.col("shared"))).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component and verdict of every document: (doc_id, n_shingles, component_id, kept).

    ``docs`` has doc_id and text; other columns are ignored, whatever their names.  Documents are
    linked when their distinct 5-word shingles (A-Z lower-cased, words split at white space) have
    a Jaccard similarity of at least 0.75; component_id is the smallest doc_id reachable and kept
    is true for that document alone.  Fewer than five words are one shingle; null, empty and blank
    texts have none, are linked with nothing and kept.  A null doc_id gives a row with a null
    component, kept.  Rows that repeat a doc_id are documents of their own, each linked by its own
    text, so one id can lie in several components; an empty table gives no rows.  Any number of exact copies is one class, so ties cost one row each.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = stage(texts.mapInArrow(_sketches, _SKETCH).withColumn("row", F.monotonically_increasing_id()), "sketch")
    usable = sketches.filter("doc_id is not null and n_shingles > 0")
    copies = usable.groupBy("set_id").agg(F.min("row").alias("first"), F.min("doc_id").alias("least"), F.count("*").alias("n"))
    copies = stage(copies.filter("n > 1").select("set_id", "first", "least"), "copies")
    member = sketches.join(copies, "set_id", "left").withColumn("rep", F.coalesce("first", "row")).withColumn("least", F.coalesce("least", "doc_id"))
    # sketches are the bulk of a row: they are not shuffled to leave out repeats, or, if those are too many to broadcast, once
    repeats = stage(usable.join(copies, "set_id").filter("row != first").select("row"), "repeats")
    left_out = small(repeats)
    reps = usable.join(left_out, "row", "left_anti").withColumnRenamed("row", "rep")
    reps = stage(reps, "reps") if left_out is repeats else reps

    keyed = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = stage(keyed.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).filter("n > 1"), "buckets")
    shared = stage(keyed.join(buckets, "key").filter("rep != centre"), "shared")  # centres left out: their pairs are the stars

    stars = shared.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    marks = reps.select("rep", "sketch", "n_shingles")
    stars = stars.join(marks.toDF("b", "of_b", "n_b"), "b").join(marks.toDF("a", "of_a", "n_a"), "a")
    stars = stage(stars.select("a", "b", "of_a", "of_b", "n_a", "n_b").mapInArrow(_agreeing, "a long, b long"), "stars")
    wanted = stars.select(F.col("a").alias("rep")).union(stars.select("b")).union(shared.filter("n > 2").select("rep")).distinct()
    wanted = stage(reps.join(wanted, "rep", "left_semi").select("rep", "set_id", "doc_id"), "wanted")
    sets = stage(_sets(texts, sketches, wanted), "sets", large_rows=True)
    links = stage(_confirmed(stars, sets), "links")
    found = components(links)

    # second look: what stars cannot show
    labelled = shared.filter("n > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    labelled = stage(labelled.select("key", "band", "rep", "label"), "labelled")
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"), F.count("*").alias("labels"))
    mixed = stage(mixed.filter("labels > 1").select("key", "main", F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("lefts"), F.ceil(F.col("n") / BLOCK).cast("int").alias("rights")), "mixed")
    within = stage(labelled.join(mixed, "key"), "within")
    within = within.join(_only(reps.select("rep", "sketch", "marks", "n_shingles"), within), "rep")
    spread = F.xxhash64("rep")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    kept = ["key", "low", "high", "left", "band", "rep", "label", "main", "sketch", "marks", "n_shingles"]
    strays = within.filter("label != main").withColumn("left", F.lit(True)).withColumn("low", F.pmod(spread, F.col("lefts")).cast("int")).withColumn("high", each(F.col("rights")))
    others = within.withColumn("left", F.lit(False)).withColumn("high", F.pmod(spread, F.col("rights")).cast("int")).withColumn("low", each(F.col("lefts")))
    rest = strays.select(kept).union(others.select(kept))
    asked = stage(rest.groupBy("key", "low", "high").applyInPandas(_to_test, rest.schema), "asked")
    more = stage(asked.join(_only(sets, asked), "rep").groupBy("key", "low", "high").applyInPandas(_tested, "a long, b long").distinct(), "links")
    labels = components(links.union(more))
    least = member.filter("rep = row and n_shingles > 0 and doc_id is not null").select(F.col("rep").alias("node"), "least").join(labels, "node").groupBy("label").agg(F.min("least").alias("component"))
    final = stage(labels.join(least, "label").select(F.col("node").alias("rep"), "component"), "components")
    drop(sets, labelled, mixed, shared, buckets, *([reps] if left_out is repeats else []))
    out = member.select("doc_id", "n_shingles", "rep", "least").join(final, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "least"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
