"""Language-model scores by context-tree weighting over the bits of bytes.

A text is its lower-cased words, each closed by a space, and a line feed for its end.  Every byte
is a few binary decisions, the branches of a Huffman code of all bytes, each with its own context
tree: the context at depth d is the last d bytes, filled up with spaces before the text's start.  A node keeps how often its decision was 0
and 1; its Krichevsky-Trofimov probability depends on these counts alone, so the weighted mixture
over all depths follows from counts that Spark has summed over the corpus:
    P_w = 1/2 P_kt + 1/2 (product of the children's P_w).
Scoring mixes the depths by the posterior weights that this gives, and ends at the deepest context
that was seen.

One pass counts words and (context, byte) codes of all documents; both are summed by one shuffle.
The tree holds every context that was seen.  It is summed and weighted depth by depth, from the
deepest to the root, by group-bys of (context, decision), then mixed from the root to the deepest
by joins to the parents; a parent has at most 256 children in either.  The codes of documents that
are not learnt from are in it with counts of 0, which change no weight, and so every code that
occurs gets its probability there.  In the pass that scores the documents the most frequent words
and codes, up to ``MOST_WORDS`` and ``MOST_GRAMS``, are looked up in the task, and all others are
joined to their tables; these two constants change the way, not the scores.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.labelled import fold
from tidemark.llm.scratch import drop, stage, tidy
from tidemark.llm.words import U64, Scanner, chunks

DEPTH = 5
MOST_GRAMS = 1 << 19
MOST_WORDS = 1 << 18
SPACE, STOP = 0x20, 0x0A
_LEARNT = U64(1 << (8 * DEPTH + 8))  # above the bytes of a code
_RUN = 6 << 20  # bytes of text that are counted together: each of their distinct codes is shuffled once
_SCORED = 2 << 20  # bytes of text that are scored together


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Γ(x) for x > 0, by Stirling's series at x + 8."""
    y = x + 8.0
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    shift = np.zeros_like(y)
    for k in range(8):
        shift += np.log(x + k)
    return series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def text_codes(letters: np.ndarray, lengths: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Codes of texts laid end to end, from the bytes of their words: a byte, closing bytes included, and its ``DEPTH`` context bytes.

    The byte is the lowest of a code, its nearest predecessor the next.  A text of k words and n
    letters has n + k + 1 codes.
    """
    docs = len(n_words)
    own = np.bincount(np.repeat(np.arange(docs), n_words), lengths + 1, docs).astype(np.int64)
    start = np.cumsum(own + DEPTH + 1) - own - 1  # of each text's first byte
    place = np.cumsum(lengths + 1) - (lengths + 1)  # of each word, closing spaces counted
    base = np.concatenate([[0], np.cumsum(own)])[:docs]
    at = place + np.repeat(start - base, n_words)
    stream = np.full(int((own + DEPTH + 1).sum()), SPACE, np.uint8)
    stream[np.repeat(at - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(letters))] = letters
    stream[start + own] = STOP
    codes = np.zeros(max(0, len(stream) - DEPTH), U64)
    for k in range(DEPTH + 1):
        codes |= stream[DEPTH - k:len(stream) - k].astype(U64) << U64(8 * k)
    pads = np.zeros(len(codes), bool)
    for k in range(1, DEPTH + 1):
        pads[(start - DEPTH - k)[start - DEPTH - k >= 0]] = True
    return codes[~pads]


class Decisions:
    """The binary decisions that make up each byte: the branches of a Huffman code of the bytes' counts."""

    def __init__(self, counts: np.ndarray) -> None:
        heap = [(float(n), k, (k,)) for k, n in enumerate(counts)]
        heapq.heapify(heap)
        paths: dict[int, list[tuple[int, int]]] = {k: [] for k in range(256)}
        for node in range(255):
            low, high = heapq.heappop(heap), heapq.heappop(heap)
            for bit, (_, _, leaves) in enumerate((low, high)):
                for byte in leaves:
                    paths[byte].append((node, bit))
            heapq.heappush(heap, (low[0] + high[0], 256 + node, low[2] + high[2]))
        self.sizes = np.array([len(paths[k]) for k in range(256)])
        self.first = np.cumsum(self.sizes) - self.sizes
        flat = np.array([x for k in range(256) for x in paths[k]])
        self.nodes, self.bits = flat[:, 0], flat[:, 1]

    def of(self, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each decision of each byte: which byte it belongs to, its node and its outcome."""
        sizes = self.sizes[byte]
        row = np.repeat(np.arange(len(byte)), sizes)
        at = np.repeat(self.first[byte] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return row, self.nodes[at], self.bits[at]


@dataclass
class Model:
    """A tree in memory, of any contexts; ``score`` keeps its tree in tables."""

    counts: np.ndarray           # of each byte, from which the decisions follow
    decisions: Decisions
    contexts: list[np.ndarray]   # by depth: sorted contexts
    nodes: list[np.ndarray]      # by depth: sorted (rank of the context) * 256 + decision
    ones: list[np.ndarray]       # by depth: probability of outcome 1 where this is the deepest node seen

    def log2(self, codes: np.ndarray) -> np.ndarray:
        """log2 of the probability of each code's byte in its context."""
        distinct, which = np.unique(codes, return_inverse=True)
        row, node, bit = self.decisions.of((distinct & U64(255)).astype(np.int64))
        p = np.full(len(row), 0.5)
        todo = np.arange(len(row))
        for d in range(DEPTH, -1, -1):
            held, keys = self.contexts[d], self.nodes[d]
            if not len(held):
                continue
            rows = np.unique(row[todo])
            context = (distinct[rows] >> U64(8)) & U64((1 << (8 * d)) - 1)
            rank = np.minimum(np.searchsorted(held, context), len(held) - 1)
            place = np.full(len(distinct), -1)
            place[rows] = np.where(held[rank] == context, rank, -1)
            want = place[row[todo]] * 256 + node[todo]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            known = keys[at] == want
            p[todo[known]] = self.ones[d][at[known]]
            todo = todo[~known]
            if not len(todo):
                break
        return np.bincount(row, np.log2(np.where(bit == 1, p, 1 - p)), len(distinct))[which]


def fit(depth: np.ndarray, context: np.ndarray, byte: np.ndarray, n: np.ndarray) -> Model:
    """The weighted tree from (depth, context, byte, count); with a context all its parents must be there."""
    root = depth == 0
    totals = np.bincount(byte[root], n[root], 256)
    decisions = Decisions(totals)
    contexts, nodes, zeros, ones, parent = [], [], [], [], []
    for d in range(DEPTH + 1):
        own = depth == d
        held, rank = np.unique(context[own], return_inverse=True)
        row, node, bit = decisions.of(byte[own].astype(np.int64))
        keys, at = np.unique(rank[row] * 256 + node, return_inverse=True)
        counts = n[own].astype(float)[row]
        contexts.append(held)
        nodes.append(keys)
        zeros.append(np.bincount(at, counts * (bit == 0), len(keys)))
        ones.append(np.bincount(at, counts * (bit == 1), len(keys)))
        if d:
            up = np.searchsorted(contexts[d - 1], held & U64((1 << (8 * (d - 1))) - 1))
            parent.append(np.searchsorted(nodes[d - 1], up[keys // 256] * 256 + keys % 256) if len(keys) else keys)
    weight = []
    below = np.zeros(0)
    for d in range(DEPTH, -1, -1):
        own = log_kt(zeros[d], ones[d])
        if d == DEPTH or not len(nodes[d + 1]):
            log_w, stop = own, np.ones(len(own))
        else:
            up, size = parent[d], len(own)
            child = np.bincount(up, below, size)
            pooled = log_kt(np.maximum(0, zeros[d] - np.bincount(up, zeros[d + 1], size)), np.maximum(0, ones[d] - np.bincount(up, ones[d + 1], size)))
            inner = np.bincount(up, minlength=size) > 0
            log_w = np.where(inner, np.logaddexp(own, child + pooled) - np.log(2), own)
            stop = np.where(inner, np.exp(own - np.log(2) - log_w), 1.0)
        weight.insert(0, stop)
        below = log_w
    mixed, acc, rest = [], np.zeros(len(nodes[0])), np.ones(len(nodes[0]))
    for d in range(DEPTH + 1):
        kt = (ones[d] + 0.5) / (zeros[d] + ones[d] + 1)
        mixed.append(acc + rest * kt)
        if d < DEPTH:
            up = parent[d]
            acc, rest = (acc + rest * weight[d] * kt)[up], (rest * (1 - weight[d]))[up]
    return Model(totals, decisions, contexts, nodes, mixed)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def _scan(column: pa.Array) -> Iterator[tuple[int, int, object, np.ndarray]]:
    """(first row, end row, words, codes) by parts of a megabyte."""
    scan = Scanner("spaced", lower=True)
    for row, end, data, bounds in chunks(column, 1 << 20):
        words = scan(data, bounds)
        yield row, end, words, text_codes(_FOLD[data[scan.inside[data]]], words.ends - words.starts, words.per_doc())


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, learnt, codes, size = [], [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        distinct, which = np.unique(np.concatenate(hashes), return_inverse=True)
        yield rows(0, distinct, np.bincount(which, minlength=len(distinct)), np.bincount(which, np.concatenate(learnt), len(distinct)))
        distinct, n = np.unique(np.concatenate(codes), return_counts=True)
        yield rows(1, distinct & (_LEARNT - U64(1)), n, np.where(distinct & _LEARNT, n, 0))

    def rows(kind: int, keys: np.ndarray, n: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(c.astype(np.int64))], names=["kind", "key", "n", "c"])

    for batch in batches:
        learn = np.array(batch.column("learn").to_pylist(), bool)
        for row, end, words, own in _scan(batch.column("text")):
            n_words = words.per_doc()
            n_codes = np.bincount(np.repeat(np.arange(end - row), n_words), words.ends - words.starts + 1, end - row).astype(np.int64) + 1
            hashes.append(words.hashes)
            learnt.append(np.repeat(learn[row:end], n_words))
            codes.append(own | np.repeat(np.where(learn[row:end], _LEARNT, U64(0)), n_codes))
            size += len(own)
            if size > _RUN:
                yield from flush()
                hashes, learnt, codes, size = [], [], [], 0
    if hashes:
        yield from flush()


def _weigh(inner: bool):
    """Of nodes (at, zeros, ones, below: the log of the product of their children's weighted probabilities) the log of their own and the weight of stopping there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, zeros, ones, below = (batch.column(k) for k in range(4))
            own = log_kt(zeros.to_numpy().astype(float), ones.to_numpy().astype(float))
            log_w = np.logaddexp(own, below.to_numpy()) - np.log(2) if inner else own
            stop = np.exp(own - np.log(2) - log_w) if inner else np.ones(len(own))
            yield pa.record_batch([at, zeros, ones, pa.array(log_w), pa.array(stop)], names=["at", "zeros", "ones", "log_w", "stop"])

    return run


def _tree(codes: DataFrame) -> DataFrame:
    """log2 of the probability of every code's byte in its context: (key, log).  ``codes`` has each code once (key) and how often it was learnt (c).

    A node's key is its context and, as the lowest byte, its decision; its parent's has one byte less.
    """
    spark = codes.sparkSession
    totals = np.zeros(256)
    for r in codes.groupBy(F.col("key").bitwiseAND(255).alias("byte")).agg(F.sum("c").alias("c")).collect():  # at most 256 rows
        totals[r.byte] = r.c
    row, node, bit = Decisions(totals).of(np.arange(256))
    paths = F.broadcast(spark.createDataFrame(list(zip(row.tolist(), node.tolist(), bit.tolist())), "byte long, node long, bit int"))
    parts = codes.withColumn("byte", F.col("key").bitwiseAND(255)).join(paths, "byte").select("key", ((F.col("key") - F.col("byte")) + F.col("node")).alias("at"), "bit", "c")

    sums = parts.groupBy("at").agg(F.sum(F.when(F.col("bit") == 0, F.col("c")).otherwise(0)).alias("zeros"), F.sum(F.when(F.col("bit") == 1, F.col("c")).otherwise(0)).alias("ones"))
    kind = "at long, zeros long, ones long, log_w double, stop double"
    levels = [stage(sums.withColumn("below", F.lit(0.0)).mapInArrow(_weigh(False), kind), "nodes")]
    for d in range(DEPTH - 1, -1, -1):
        sums = levels[0].groupBy(_up(d).alias("at")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_w").alias("below"))
        levels.insert(0, stage(sums.mapInArrow(_weigh(True), kind), "nodes"))

    kt = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    mixed = F.when(F.col("zeros") + F.col("ones") > 0, F.col("acc") + F.col("rest") * kt).otherwise(F.col("p"))  # else that of the deepest node seen
    above = F.broadcast(spark.createDataFrame([(k, 0.0, 1.0, 0.5) for k in range(256)], "up long, acc double, rest double, p double"))
    for d in range(DEPTH + 1):
        nodes = levels[d].join(above, _up(max(0, d - 1)) == F.col("up"))
        acc, rest = F.col("acc") + F.col("rest") * F.col("stop") * kt, F.col("rest") * (1 - F.col("stop"))
        above = nodes.select(F.col("at").alias("up"), acc.alias("acc"), rest.alias("rest"), mixed.alias("p"))
    found = parts.select("key", "bit", "at").join(above.select(F.col("up").alias("at"), "p"), "at")
    out = stage(found.groupBy("key").agg(F.sum(F.log2(F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p")))).alias("log")), "logs")
    drop(*levels)
    return out


def _up(d: int) -> Column:
    """The key at depth ``d`` of a node at or below it."""
    return F.col("at").bitwiseAND((1 << (8 * d + 8)) - 1)


def _least(table: DataFrame, column: str, size, most: int) -> int:
    """The smallest power of two such that rows with at least that value in ``column`` add up to at most ``most``."""
    sizes = table.groupBy(F.floor(F.log2(column)).cast("int").alias("power")).agg(size.alias("size")).collect()  # at most 64 rows
    least = 64
    for row in sorted(sizes, key=lambda r: -r.power):
        most -= row["size"]
        if most < 0:
            break
        least = row.power
    return least


def _score_texts(common):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, total, held, held_logs = common.value
        logs = np.log10((counts + 1.0) / total)
        slot = TaskContext.get().partitionId() << 40
        waiting, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            distinct, which = np.unique(np.concatenate([own for *_, own in waiting]), return_inverse=True)
            at = np.minimum(np.searchsorted(held, distinct), max(0, len(held) - 1))
            looked = held[at] == distinct if len(held) else np.zeros(len(distinct), bool)
            bits = np.cumsum(np.concatenate([[0.0], (np.where(looked, held_logs[at], 0.0) if len(held) else np.zeros(len(distinct)))[which]]))
            others = ~looked[which]
            begin = 0
            for first, ids, words, own in waiting:
                end = begin + len(own)
                yield part(first, ids, words, bits[begin:end + 1], own, others[begin:end])
                begin = end

        def part(first: int, ids: pa.Array, words, bits: np.ndarray, own: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
            docs, n_words = len(ids), words.per_doc()
            sums = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[words.first])
            n_codes = sums(words.ends - words.starts + 1) + 1
            bounds = np.concatenate([[0], np.cumsum(n_codes)])
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, words.hashes), len(hashes) - 1)
                frequent = hashes[at] == words.hashes
                base, known = np.where(frequent, logs[at], 0.0), frequent & (counts[at] > 0)
            else:
                frequent = known = np.zeros(len(words.hashes), bool)
                base = np.zeros(len(words.hashes))
            lists = lambda n, keys: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(keys.view(np.int64)))
            rare_codes = lists(np.diff(np.concatenate([[0], np.cumsum(others)])[bounds]), own[others])
            return pa.record_batch(
                [pa.array(np.arange(first, first + docs)), ids, pa.array(n_words), pa.array(n_codes), pa.array(sums(known).astype(np.int64)), pa.array(sums(base).astype(float)), pa.array(np.diff(bits[bounds])), lists(sums(~frequent), words.hashes[~frequent]), rare_codes],
                names=["slot", "doc_id", "n_words", "n_bytes", "known", "base", "bits", "rare", "rare_codes"])

        for batch in batches:
            for row, end, words, own in _scan(batch.column("text")):
                waiting.append((slot + row, batch.column("doc_id").slice(row, end - row), words, own))
                size += len(own)
                if size > _SCORED:
                    yield from flush()
                    waiting, size = [], 0
            slot += batch.num_rows
        if waiting:
            yield from flush()

    return run


def score(docs: DataFrame, learn=None) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``learn`` is a condition on doc_id; the model and the counts c, N and V are learnt from the
    documents that meet it (from all without one).  A null or empty text is its end alone.  Scores
    are log10 probabilities; bits_per_byte is the code length over the bytes of the words and what
    closes them.  Rows repeating an id, or with a null one (not learnt from under a condition), are
    documents of their own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learnt = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    n_learnt = texts.filter(learnt).count()
    counted = texts.select(learnt.alias("learn"), "text").mapInArrow(_count, "kind int, key long, n long, c long")
    counted = stage(counted.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("c").alias("c")), "counts")
    words = counted.filter("kind = 0").select(F.col("key").alias("hash"), "n", "c")
    codes = counted.filter("kind = 1").select("key", "n", "c")
    logs = _tree(codes)

    sums = words.agg(F.sum("c").alias("c"), F.sum((F.col("c") > 0).cast("long")).alias("v")).collect()[0]
    tokens, distinct = (sums.c or 0) + n_learnt, (sums.v or 0) + int(n_learnt > 0)
    total = float(tokens + distinct + 1)
    least = _least(words, "n", F.count("*"), MOST_WORDS)
    frequent = words.filter(F.floor(F.log2("n")) >= least).select("hash", "c").toArrow()  # two numbers a row
    hashes, counts = frequent["hash"].to_numpy().view(U64), frequent["c"].to_numpy()
    least_code = _least(codes, "n", F.count("*"), MOST_GRAMS)
    held = codes.filter(F.floor(F.log2("n")) >= least_code).select("key").join(logs, "key").select("key", "log").toArrow()
    held_keys, held_logs = held["key"].to_numpy().view(U64), held["log"].to_numpy()
    order, held_order = np.argsort(hashes), np.argsort(held_keys)
    common = spark.sparkContext.broadcast((hashes[order], counts[order], total, held_keys[held_order], held_logs[held_order]))
    del frequent, hashes, counts, held, held_keys, held_logs
    parts = stage(texts.mapInArrow(_score_texts(common), "slot long, doc_id long, n_words long, n_bytes long, known long, base double, bits double, rare array<long>, rare_codes array<long>"), "scored")

    # no word or code here is more frequent than 2^least, so none gathers in one task
    rare = parts.select("slot", F.explode("rare").alias("hash")).join(words.filter(F.floor(F.log2("n")) < least).select("hash", "c"), "hash")
    rare = rare.groupBy("slot").agg(F.sum((F.col("c") > 0).cast("long")).alias("rare_known"), F.sum(F.log10((F.col("c") + 1.0) / total)).alias("rare_base"))
    spelt = parts.select("slot", F.explode("rare_codes").alias("key")).join(logs.join(codes.filter(F.floor(F.log2("n")) < least_code).select("key"), "key"), "key")
    spelt = spelt.groupBy("slot").agg(F.sum("log").alias("rare_bits"))
    out = parts.drop("rare", "rare_codes").join(rare, "slot", "left").join(spelt, "slot", "left").fillna(0, ["rare_known", "rare_base", "rare_bits"])
    out = out.withColumn("bits", F.col("bits") + F.col("rare_bits"))
    return out.select(
        "doc_id", (F.col("n_words") + 1).alias("n_tokens"), (F.col("known") + F.col("rare_known") + int(n_learnt > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_base") + float(np.log10((n_learnt + 1.0) / total))).alias("base_score"), (F.col("bits") * float(np.log10(2))).alias("score"), (-F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )


def language_model(docs: DataFrame) -> DataFrame:
    """``score`` learning from documents whose crc32(doc_id) mod 7 is not 2; ``held_out`` marks the others."""
    part = fold(F.col("doc_id"), 7)
    return score(docs, part != 2).select("doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
