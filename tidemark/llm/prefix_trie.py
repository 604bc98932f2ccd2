"""The trie of conversation prefixes, by digests of blocks of turns.

1. Turns are sorted by range over all tasks.  A turn's key is a polynomial hash of the digests of
   its conversation's turns up to it, modulo a prime of 127 bits.  Such hashes join: a task hashes
   its own rows, and what a conversation brings along from earlier tasks is multiplied in
   afterwards, from two rows of each task.  So no conversation has to fit a task.
2. Grafting replaces the first turns of a conversation by those of another one.  As hashes join,
   only a term is exchanged; no turn is hashed again.
3. Conversations are grouped by blocks of ``BLOCK`` turns first: equal blocks (a block's last key
   stands for its whole prefix) fall together before the shuffle.  Where all that reach a block
   go through it alike, its inner turns are read off one representative.  Only inside blocks where
   siblings diverge turn boundaries are grouped.
4. Subtree sums go up and down the tree by levels of depths that 2, 4, 8 ... divide, each round a
   join to an ancestor, so rounds grow with the logarithm of the depth.  Nodes of one conversation
   are left out: their subtree is a path with one leaf and nothing shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scratch import stage

BLOCK = 4
HEADS = 3      # most turns that grafting replaces
SPACING = 20   # conversations c - c % SPACING lend their first turns
PIECE = 1 << 16  # bytes of joined ids that one row holds

PRIME = (1 << 127) - 1
_BASE = int.from_bytes(hashlib.sha256(b"turn").digest()[:15], "big")
_ROOT = bytes(16)
_POWERS = [1]


def power(n: int) -> int:
    """The base to the power ``n``, from a table as far as turns usually go."""
    if n >= 1 << 16:
        return pow(_BASE, n, PRIME)
    while len(_POWERS) <= n:
        _POWERS.append(_POWERS[-1] * _BASE % PRIME)
    return _POWERS[n]


def number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def key_of(x: int) -> bytes:
    return x.to_bytes(16, "big")


def extended(key: int, digest: bytes) -> int:
    """The key after one more turn."""
    return (key * _BASE + number(digest) + 1) % PRIME


_TURN = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("digest", pa.binary()), ("words", pa.int64()), ("first", pa.bool_()), ("edge", pa.bool_())])


def _hash_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted turns their number and key within this task; ``first`` marks its first conversation, ``edge`` the last turn here of its first and last one."""
    part, conv, n, key, first = TaskContext.get().partitionId(), None, 0, 0, True
    held: dict | None = None
    rows: list[dict] = []
    for batch in batches:
        for c, digest, words in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "digest", "words"))):
            if held is not None:
                if c != conv:
                    held["edge"], first = first, False
                rows.append(held)
            if c != conv:
                conv, n, key = c, 0, 0
            n, key = n + 1, extended(key, digest)
            held = {"part": part, "conv_id": c, "n": n, "key": key_of(key), "digest": digest, "words": words, "first": first, "edge": False}
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_TURN)
            rows = []
    if held is not None:
        yield pa.RecordBatch.from_pylist([held | {"edge": True}], schema=_TURN)


def _brought(edges: list) -> dict[int, tuple[int, int, int]]:
    """For each task whose first conversation began earlier: (conversation, its turns before, their key).  Two rows a task."""
    out: dict[int, tuple[int, int, int]] = {}
    last: tuple[int, int, int] | None = None
    for row in sorted(edges, key=lambda r: (r.part, not r.first)):
        n, key = row.n, number(row.key)
        if row.first and last is not None and last[0] == row.conv_id:
            out[row.part] = last
            n, key = last[1] + n, (last[2] * power(n) + key) % PRIME
        last = row.conv_id, n, key
    return out


def _place(brought: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, keys = batch.column("n").to_pylist(), batch.column("key").to_pylist()
            if brought:
                for k, (part, first) in enumerate(zip(batch.column("part").to_pylist(), batch.column("first").to_pylist())):
                    if first and part in brought:
                        _, before, key = brought[part]
                        keys[k] = key_of((key * power(ns[k]) + number(keys[k])) % PRIME)
                        ns[k] += before
            yield pa.record_batch([batch.column("conv_id"), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()), batch.column("digest"), batch.column("words")], names=["conv_id", "n", "key", "digest", "words"])

    return run


def hashed_turns(turns: DataFrame) -> DataFrame:
    """Each turn's number in its conversation (from 1), the key of the prefix that it ends, its digest and its words.

    ``turns`` has conv_id, turn, role and text; other columns are ignored.  Turns are ordered by
    turn, null first, equal ones by a digest of role and text; a null role or text is empty; rows
    without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 30))
    narrow = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    ordered = narrow.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    hashed = stage(ordered.select("conv_id", "digest", "words").mapInArrow(_hash_turns, "part int, conv_id long, n long, key binary, digest binary, words long, first boolean, edge boolean"), "turns")
    brought = _brought(hashed.filter("edge").select("part", "first", "conv_id", "n", "key").collect())
    return hashed.mapInArrow(_place(brought), "conv_id long, n long, key binary, digest binary, words long")


def _graft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth and key of turns after the first turns of their conversation were exchanged."""
    for batch in batches:
        depths, keys, before = [], [], []
        for n, key, digest, cut_n, cut, new_n, new in zip(*(batch.column(c).to_pylist() for c in ("n", "key", "digest", "cut_n", "cut", "new_n", "new"))):
            depths.append(n - cut_n + new_n)
            if cut != new:
                key = key_of((number(key) + (number(new) - number(cut)) * power(n - cut_n)) % PRIME)
            keys.append(key)
            before.append(key_of((number(key) - number(digest) - 1) * _INVERSE % PRIME))
        yield pa.record_batch([batch.column("conv_id"), pa.array(depths, pa.int64()), pa.array(keys, pa.binary()), pa.array(before, pa.binary()), batch.column("words")], names=["conv_id", "depth", "key", "before", "words"])


_INVERSE = pow(_BASE, -1, PRIME)
_REBUILT = "conv_id long, depth long, key binary, before binary, words long"


def grafted(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: their turns (conv_id, depth, key, before: the key of the prefix without it, words) and their ids.

    The first h turns of a conversation c are those of c - c % ``SPACING``, h = crc32(c) % 4.  A
    conversation is a row of the second table even if nothing is left of it.
    """
    hashed = stage(hashed_turns(turns), "hashed")
    heads = hashed.filter(F.col("n") <= HEADS).select("conv_id", F.struct("n", "key", "digest", "words").alias("t"))
    heads = heads.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("heads"))  # at most HEADS turns
    lent = heads.select(F.col("conv_id").alias("lender"), F.col("heads").alias("lent"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS + 1)).cast("int")
    convs = heads.withColumn("h", h).withColumn("lender", F.col("conv_id") - F.col("conv_id") % SPACING).join(lent, "lender", "left")
    none = F.expr("cast(array() as array<struct<n:bigint,key:binary,digest:binary,words:bigint>>)")
    convs = convs.withColumn("lent", F.when(F.col("h") > 0, F.slice(F.coalesce("lent", none), 1, F.col("h"))).otherwise(none))
    key = lambda turns: F.when(F.size(turns) > 0, F.element_at(turns, -1)["key"]).otherwise(F.lit(_ROOT))
    own = F.when(F.col("h") > 0, F.slice("heads", 1, F.col("h"))).otherwise(none)
    convs = convs.withColumn("own", own)
    convs = stage(convs.select("conv_id", "h", "lent", F.size("own").cast("long").alias("cut_n"), key(F.col("own")).alias("cut"), F.size("lent").cast("long").alias("new_n"), key(F.col("lent")).alias("new")), "convs")
    rest = hashed.join(convs.drop("lent"), "conv_id").filter(F.col("n") > F.col("h"))
    taken = convs.select("conv_id", F.explode("lent").alias("t")).select("conv_id", "t.n", "t.key", "t.digest", "t.words", F.lit(0).cast("long").alias("cut_n"), F.lit(_ROOT).alias("cut"), F.lit(0).cast("long").alias("new_n"), F.lit(_ROOT).alias("new"))
    rebuilt = rest.select(*taken.columns).union(taken).mapInArrow(_graft, _REBUILT)
    return rebuilt, convs.select("conv_id")


def nodes(rebuilt: DataFrame) -> DataFrame:
    """The prefixes below the root: depth, key, before (the parent's key), words, n_convs, conv_id (the smallest of the members)."""
    turn = F.struct("depth", "key", "before", "words")
    blocks = rebuilt.groupBy("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))  # at most BLOCK turns
    edges = stage(blocks.groupBy("turns").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "blocks")
    edges = edges.withColumn("start", F.element_at("turns", 1)["before"]).withColumn("level", F.element_at("turns", 1)["depth"])
    siblings = stage(edges.groupBy("level", "start").agg(F.count("*").alias("n")).filter("n > 1").select("level", "start"), "diverging")
    turns = lambda part: part.select(F.explode("turns").alias("t"), "n_convs", "conv_id").select("t.*", "n_convs", "conv_id")
    alike = turns(edges.join(siblings, ["level", "start"], "left_anti"))
    refined = turns(edges.join(siblings, ["level", "start"], "left_semi")).groupBy("depth", "key", "before", "words").agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return alike.select(*refined.columns).union(refined)


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ids sorted by key pieces of their joined decimals, numbered by task and order."""
    slot, at, key, ids, size = TaskContext.get().partitionId() << 32, 0, None, [], 0
    schema = pa.schema([("key", pa.binary()), ("place", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        out = []
        for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or size > PIECE):
                out.append({"key": key, "place": slot + at, "ids": ",".join(ids)})
                at, ids, size = at + 1, [], 0
            key = k
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if ids:
        yield pa.RecordBatch.from_pylist([{"key": key, "place": slot + at, "ids": ",".join(ids)}], schema=schema)


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's pieces, which come in order; one piece is held at a time."""
    key, digest = None, None
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    out.append({"key": key, "ends_sha256": digest.hexdigest()})
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": digest.hexdigest()}], schema=schema)


def ends(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """For each prefix with which conversations end, the digest of their ascending ids: (key, ends_sha256).

    Ids are sorted by range over all tasks, so the many that end alike are joined in several; the
    task that makes the digest reads pieces of ``PIECE`` bytes.
    """
    last = rebuilt.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    last = convs.join(last, "conv_id", "left").select(F.coalesce("key", F.lit(_ROOT)).alias("key"), "conv_id")
    pieces = last.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_join_ids, "key binary, place long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "place").mapInArrow(_digest_ids, "key binary, ends_sha256 string")


def subtrees(shared: DataFrame, deepest: int) -> DataFrame:
    """Sums over subtrees of the nodes (key, up: the parent's key, depth, leaves, saved): (key, leaves, saved).

    ``shared`` holds the root (depth 0) and with a node its parent.  Going up, a node at a depth
    that 2^j divides knows the sums of the 2^j levels from it on and its ancestor 2^j above; going
    down, the whole subtrees of the nodes between follow from those of the coarser levels.
    """
    level = stage(shared.select("key", "up", "depth", "leaves", "saved"), "level")
    odd_levels, j = [], 0
    while (1 << j) <= deepest:
        odd = level.filter(F.col("depth") % (2 << j) != 0)
        even = level.filter(F.col("depth") % (2 << j) == 0)
        below = odd.groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        lifted = even.join(below, "key", "left").join(odd.select(F.col("key").alias("up"), F.col("up").alias("higher")), "up", "left")
        odd_levels.append((odd, even.select("key", "up")))
        level = stage(lifted.select("key", F.col("higher").alias("up"), "depth", (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "level")
        j += 1
    whole = level.select("key", "leaves", "saved")
    for odd, even in reversed(odd_levels):
        below = even.join(whole, "key").groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        inner = odd.join(below, "key", "left").select("key", (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        whole = stage(whole.union(inner), "whole")
    return whole


def trie(turns: DataFrame) -> DataFrame:
    """Every prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text; other columns are ignored, whatever their names.  A
    null role or text is empty; rows without a conv_id are left out; repeated rows are turns of
    their own.  Without any conversation there is no row, else one for the root (depth 0, whose
    parent is null) and one for each distinct sequence of first turns.
    """
    rebuilt, convs = grafted(turns)
    rebuilt = stage(rebuilt, "rebuilt")
    found = stage(nodes(rebuilt), "nodes")
    totals = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).collect()[0]
    if not totals.n:
        return turns.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    spark = turns.sparkSession
    root = spark.createDataFrame([(0, bytearray(_ROOT), None, 0, totals.n, totals.least)], "depth long, key binary, before binary, words long, n_convs long, conv_id long")
    every = root.union(found.select(*root.columns))

    children = found.groupBy(F.col("before").alias("key")).agg(F.count("*").alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("alone"))
    deepest = found.filter("n_convs > 1").agg(F.max("depth")).collect()[0][0] or 0
    shared = every.filter("n_convs > 1 or depth = 0").join(children, "key", "left")
    leaves = F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.col("alone"))
    shared = stage(shared.select("key", F.col("before").alias("up"), "depth", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"), leaves.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "shared")
    sums = subtrees(shared, deepest).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})

    # a node of one conversation: its parent is one of that conversation too, or shared
    lone = found.filter("n_convs = 1").select("key", "before", "depth", "conv_id", "n_convs")
    goes_on = lone.select(F.col("before").alias("key"), F.lit(1).cast("long").alias("on"))
    lone = lone.join(goes_on, "key", "left").select("key", "before", "depth", "conv_id", "n_convs", F.coalesce("on", F.lit(0).cast("long")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    several = every.filter("n_convs > 1 or depth = 0").select("key", "before", "depth", "conv_id", "n_convs").join(shared.select("key", "n_children"), "key").join(sums, "key")
    parents = shared.select(F.col("key").alias("before"), F.col("conv_id").alias("parent"))
    out = several.unionByName(lone).join(parents, "before", "left").join(ends(rebuilt, convs), "key", "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id"))
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
